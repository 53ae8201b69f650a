"""The offline variant of the summary: 39 columns, with its own rules for VWAP, nulls and after-hours trade."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions import expr as x

PREVIEW = (
    "ticker", "company_name", "day_open", "day_high", "day_low", "day_close", "day_volume", "day_return_pct", "latest_price", "latest_bar_time_et",
    "is_after_hours_latest", "intraday_vwap_last", "current_vs_vwap_pct", "pct_regular_minutes_above_vwap", "pct_after_hours_minutes_above_regular_vwap",
    "after_hours_price", "latest_vs_day_close_pct", "after_hours_vs_day_close_pct", "regular_bar_count",
)


def running_v2(bars: DataFrame, scale: int | None = None) -> DataFrame:
    """Adds typical_price, cum_vwap and above_vwap to bars of one date, null outside the regular session.

    Every regular bar counts: one of zero volume has no VWAP and isn't above it; one without a price still adds its volume.
    """
    k = 10**scale if scale is not None else 1
    total = F.col("high") + F.col("low") + F.col("close")
    total = F.floor(total * k + 0.5).cast("long") if scale is not None else total
    regular = F.col("session") == "regular"
    w = Window.partitionBy("symbol", "session").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pv, volume = total * F.col("volume"), F.nullif("volume", F.lit(0))
    vwap = F.sum(F.coalesce(pv, F.lit(0))).over(w).cast("double") / (F.sum(volume).over(w) * (3 * k)).cast("double")
    out = bars.withColumn("cum_vwap", F.when(regular & volume.isNotNull() & pv.isNotNull(), vwap))
    out = out.withColumn("above_vwap", F.when(regular, F.coalesce(F.col("close") > F.col("cum_vwap"), F.lit(False))))
    return out.withColumn("typical_price", F.when(regular, x.typical("high", "low", "close")))


def intraday_v2(bars: DataFrame, scale: int | None = None) -> DataFrame:
    """Thirteen columns of each ticker from the bars (symbol, ts, et, session as of the script) of one Eastern date."""
    r = running_v2(bars, scale)
    at, regular = F.struct("ts", "seq"), F.col("session") == "regular"
    last_regular = lambda c: F.max_by(c, F.when(regular, at))
    late = F.filter(F.collect_list(F.when(F.col("session") == "afterhours", F.coalesce(F.col("close"), F.lit(float("-inf"))))), lambda v: v.isNotNull())  # at most a day's minutes
    out = r.groupBy(F.col("symbol").alias("ticker")).agg(
        F.count("*").alias("intraday_bar_count"), F.count_if(regular).alias("regular_bar_count"), F.max_by(F.struct("close", "volume", "ts", "session"), at).alias("_b"),
        last_regular(F.col("ts")).alias("_rt"), last_regular(F.col("close")).alias("regular_close"), last_regular(F.col("cum_vwap")).alias("intraday_vwap_last"),
        F.count_if("above_vwap").alias("_above"), late.alias("_late"),
    )
    price, vwap = F.col("_b.close"), F.col("intraday_vwap_last")
    above = F.size(F.filter("_late", lambda v: v > vwap))
    return out.select(
        "ticker", "intraday_bar_count", "regular_bar_count", x.et_with_zone("_b.ts").alias("latest_bar_time_et"), price.alias("latest_price"), F.col("_b.volume").alias("latest_volume"),
        (F.col("_b.session") == "afterhours").alias("is_after_hours_latest"), (F.col("_b.session") == "premarket").alias("is_premarket_latest"),
        x.et_with_zone("_rt").alias("regular_close_time_et"), "regular_close", "intraday_vwap_last", x.return_pct(price, vwap).alias("current_vs_vwap_pct"),
        F.when(F.col("regular_bar_count") > 0, x.round_up(F.col("_above") * 100.0 / F.col("regular_bar_count"), 2)).alias("pct_regular_minutes_above_vwap"),
        F.when((F.size("_late") > 0) & vwap.isNotNull(), x.round_up(above * 100.0 / F.size("_late"), 2)).alias("pct_after_hours_minutes_above_regular_vwap"),
    )


def daily_v2(daily: DataFrame, date: str) -> DataFrame:
    """The last daily bar of each ticker (ticker, date, ts, open, high, low, close, adj_close, volume) on a date."""
    got = daily.filter(F.col("date") == F.lit(date).cast("date")).groupBy("ticker").agg(F.max_by(F.struct("open", "high", "low", "close", "adj_close", "volume"), "ts").alias("d"))
    price = lambda c: x.safe_double(f"d.{c}").alias(f"day_{c}")
    out = got.select("ticker", *map(price, ("open", "high", "low", "close", "adj_close")), x.safe_long("d.volume").alias("day_volume"))
    return out.withColumn("day_return_pct", x.return_pct("day_close", "day_open"))


def profile_v2(quotes: DataFrame) -> DataFrame:
    """Nine columns of a ticker's profile (columns that a source lacks are null)."""
    has = lambda c: F.col(c) if c in quotes.columns else F.lit(None).cast("string")
    return quotes.select(
        F.col("symbol").alias("ticker"), x.first_filled(has("longName"), has("shortName")).alias("company_name"), has("quoteType").alias("quote_type"), has("sector").alias("sector"), has("industry").alias("industry"),
        has("exchange").alias("exchange"), has("currency").alias("currency"), x.safe_long("marketCap").alias("market_cap"), has("website").alias("website"), x.short_text(has("longBusinessSummary")).alias("business_summary"),
    )


def fallback_v2(quotes: DataFrame) -> DataFrame:
    """Six price columns of the quote."""
    has = lambda c: x.safe_double(c) if c in quotes.columns else F.lit(None).cast("double")
    names = {"currentPrice": "current_price", "regularMarketPrice": "regular_market_price", "preMarketPrice": "pre_market_price", "postMarketPrice": "post_market_price", "postMarketChangePercent": "post_market_change_pct", "regularMarketChangePercent": "regular_market_change_pct"}
    return quotes.select(F.col("symbol").alias("ticker"), *(has(k).alias(f"yahoo_{v}") for k, v in names.items()))


def summary_v2(tickers: DataFrame, profiles: DataFrame, daily: DataFrame, intraday: DataFrame, fallback: DataFrame) -> DataFrame:
    """The 39 columns of each ticker, sorted by the day's return, nulls last."""
    out = tickers.select(F.col("symbol").alias("ticker"))
    for part in (profiles, daily, intraday, fallback):
        out = out.join(part, "ticker", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = out.select(*(zero(c) if c in ("intraday_bar_count", "regular_bar_count") else F.col(c) for c in out.columns))
    late = F.when(F.col("is_after_hours_latest") & F.col("latest_price").isNotNull(), F.col("latest_price")).otherwise(F.col("yahoo_post_market_price"))
    out = out.withColumn("after_hours_price", late).withColumn("latest_vs_day_close_pct", x.return_pct("latest_price", "day_close")).withColumn("after_hours_vs_day_close_pct", x.return_pct("after_hours_price", "day_close"))
    return out.orderBy(F.col("day_return_pct").desc_nulls_last(), "ticker")


def preview(df: DataFrame) -> DataFrame:
    """The preview's columns, as far as they exist."""
    return df.select(*(c for c in PREVIEW if c in df.columns))


def flatten_columns(df: DataFrame) -> DataFrame:
    """Columns of a two-level header, written ``level0.level1``, by their first level."""
    return df.toDF(*(c.split(".")[0] for c in df.columns))


def csv_lines(df: DataFrame) -> DataFrame:
    """line: the rows of the script's CSV, cells quoted where they must be, nulls empty; other columns are kept."""
    cell = lambda c: F.coalesce(F.when(F.col(c).cast("string").rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col(c).cast("string")), F.lit(""))
    return df.withColumn("line", F.concat_ws(",", *map(cell, df.columns)))


def write_outputs(df: DataFrame, path: str) -> None:
    """The script's files: ``csv`` (with a byte-order mark before the header) and ``json`` (nulls kept), both in order."""
    head = df.sparkSession.createDataFrame([(-1, "﻿" + ",".join(df.columns))], "_at long, line string")
    rows = csv_lines(df).select(F.monotonically_increasing_id().alias("_at"), "line")
    head.unionByName(rows).orderBy("_at").select("line").coalesce(1).write.text(f"{path}/csv")
    df.write.option("ignoreNullFields", "false").json(f"{path}/json")
