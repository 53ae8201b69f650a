"""Presentation: sorting, buckets, display formats, categories, candles and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.schemas import CSV_COLUMNS, SUMMARY_COLUMNS


def sort_items(items: DataFrame, key: str = "vsPreClosePct", descending: bool = True, tie: str = "pos") -> DataFrame:
    """By any summary column, nulls last either way, equals in their first order."""
    if key not in SUMMARY_COLUMNS:
        raise ValueError(f"no column {key}")
    return items.orderBy(F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last(), tie)


def top(items: DataFrame, key: str = "vsPreClosePct", n: int = 5, descending: bool = True, tie: str = "pos", among: DataFrame | None = None) -> DataFrame:
    """The first ``n`` items, and in n_more how many others there are, a scalar in the same plan.

    ``among``: rows as many as the items, such as the universe that they are of, which are counted in their place.
    """
    counted = (items if among is None else among).agg(F.count("*")).scalar()
    return sort_items(items, key, descending, tie).limit(n).withColumn("n_more", F.greatest(counted - n, F.lit(0)).cast("long"))


def join_categories(categories: DataFrame, items: DataFrame) -> DataFrame:
    """Category rows with the item of their symbol, those without left out; of repeated symbols the last item counts."""
    names = [c for c in items.columns if c not in ("pos", "symbol")]
    last = items.groupBy("symbol").agg(F.max_by(F.struct(*names), "pos").alias("_i"))
    return categories.join(last, "symbol").select("cat_pos", "category", "sym_pos", "symbol", *(F.col(f"_i.{c}") for c in names))


def category_stats(joined: DataFrame) -> DataFrame:
    out = joined.groupBy("cat_pos", "category").agg(F.count("*").alias("n_symbols"), F.count("pctRegularMinutesAboveVwap").alias("with_vwap"), F.count_if(F.col("pctRegularMinutesAboveVwap") >= 60).alias("above_60"))
    return out.withColumn("ratio_bucket", x.ratio_bucket("above_60", "with_vwap"))


def format_items(items: DataFrame) -> DataFrame:
    c = F.col
    return items.select(
        "pos", "symbol", x.fixed("dayClose").alias("close_text"), x.fixed("intradayVwapLast", 4).alias("vwap_text"), x.short_volume("dayVolume").alias("volume_text"),
        x.signed_pct("vsPreClosePct").alias("change_text"), x.grouped("dayVolume").alias("volume_grouped"), x.fixed("dayOpen", 4, "N/A").alias("open_text"),
        x.direction("vsPreClosePct").alias("change_bucket"), x.strength("pctRegularMinutesAboveVwap").alias("vwap_bucket"), x.badge(c("latestSession")).alias("session_badge"),
    )


def candles(bars: DataFrame) -> DataFrame:
    """Chart rows in order of time: bars with all four prices, a missing volume as zero."""
    b = bars.dropna(subset=["open", "high", "low", "close"])
    return b.select("symbol", F.unix_seconds("ts").alias("time"), "open", "high", "low", "close", F.coalesce("volume", F.lit(0)).alias("volume"), x.candle("open", "close").alias("direction")).orderBy("symbol", "time")


def _cell(name: str, kind: str):
    v = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.when(F.contains(v, F.lit(",")), F.concat(F.lit('"'), v, F.lit('"'))).otherwise(v) if kind == "string" else v


def csv_rows(items: DataFrame) -> DataFrame:
    """pos and a CSV line of 17 columns: null is empty, only strings with a comma are quoted, quotes inside stay as they are."""
    kinds = dict(items.dtypes)
    return items.select("pos", F.concat_ws(",", *(_cell(c, kinds[c]) for c in CSV_COLUMNS)).alias("line"))


def write_csv(items: DataFrame, path: str) -> None:
    """One header line and the rows in order of pos, as text; meant for what a screen shows."""
    head = items.sparkSession.createDataFrame([(-1, ",".join(CSV_COLUMNS))], "pos int, line string")
    head.unionByName(csv_rows(items).select(F.col("pos").cast("int"), "line")).orderBy("pos").select("line").coalesce(1).write.text(path)
