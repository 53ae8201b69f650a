"""Running session VWAP and what is summed up from it. A window holds one symbol's session: at most its minutes of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions import expr as x

VALID = "high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL AND volume <> 0"


def running(bars: DataFrame, scale: int | None = None, by: tuple[str, ...] = ("symbol", "et_date")) -> DataFrame:
    """Adds valid, cum_volume and vwap to bars (symbol, et_date, ts, seq, ...), over all bars of a symbol and date, or of what ``by`` names.

    Bars that aren't valid add nothing and have no vwap; nor has one where the volume so far isn't positive. With ``scale``
    prices have so many decimals and are summed as integers, which gives the same result in any order.
    """
    k = 10**scale if scale is not None else 1
    total = F.col("high") + F.col("low") + F.col("close")
    total = F.floor(total * k + 0.5).cast("long") if scale is not None else total
    w = Window.partitionBy(*by).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = bars.withColumn("valid", F.expr(VALID))
    out = out.withColumn("cum_volume", F.sum(F.when(F.col("valid"), F.col("volume")).otherwise(F.lit(0))).over(w))
    out = out.withColumn("_sum", F.sum(F.when(F.col("valid"), total * F.col("volume")).otherwise(F.lit(0))).over(w))
    vwap = F.col("_sum").cast("double") / (F.col("cum_volume") * (3 * k)).cast("double")
    return out.withColumn("vwap", F.when(F.col("valid") & (F.col("cum_volume") > 0), vwap)).drop("_sum")


def latest_session(bars: DataFrame) -> DataFrame:
    """Regular bars of each symbol's newest date that has one. The newest dates are an aggregate, a row for each symbol."""
    regular = bars.filter("session = 'regular'")
    newest = regular.groupBy("symbol").agg(F.max("et_date").alias("et_date"))
    return regular.join(newest, ["symbol", "et_date"], "left_semi")


def session_summary(bars: DataFrame, scale: int | None = None) -> DataFrame:
    """vwapDate, regularBarCount, intradayVwapLast and pctRegularMinutesAboveVwap of each symbol, from bars with sessions."""
    r = running(latest_session(bars), scale)
    out = r.groupBy("symbol").agg(
        F.max("et_date").alias("vwapDate"), F.count("*").alias("regularBarCount"),
        F.max_by("vwap", F.when(F.col("vwap").isNotNull(), F.struct("ts", "seq"))).alias("_last"),
        F.count("vwap").alias("_valid"), F.count_if(F.col("close") > F.col("vwap")).alias("_above"),
    )
    return out.select("symbol", "vwapDate", "regularBarCount", x.round_up("_last", 4).alias("intradayVwapLast"), F.when(F.col("_valid") > 0, x.round_up(F.lit(100.0) * F.col("_above") / F.col("_valid"), 2)).alias("pctRegularMinutesAboveVwap"))


def overview(bars: DataFrame, scale: int | None = None) -> DataFrame:
    """What ``session_summary`` and ``latest_bar`` say of each symbol, in one pass over bars with sessions: they are dealt by symbol once.

    A symbol's bars meet in one task, so they should be those of a few days, as ``bars.recent`` gives them.
    """
    newest = F.max(F.when(F.col("session") == "regular", F.col("et_date"))).over(Window.partitionBy("symbol"))
    r = running(bars.withColumn("_newest", newest), scale, ("symbol", "et_date", "session"))
    inside = (F.col("session") == "regular") & (F.col("et_date") == F.col("_newest"))
    at, vwap = F.struct("ts", "seq"), F.when(inside, F.col("vwap"))
    out = r.groupBy("symbol").agg(
        F.count("*").alias("intradayBarCount"), F.max_by(F.struct("close", "et", "session"), at).alias("_b"), F.max("_newest").alias("vwapDate"), F.count_if(inside).alias("regularBarCount"),
        F.max_by("vwap", F.when(vwap.isNotNull(), at)).alias("_last"), F.count(vwap).alias("_valid"), F.count_if(F.col("close") > vwap).alias("_above"),
    )
    return out.select(
        "symbol", "intradayBarCount", F.col("_b.close").alias("latestPrice"), F.col("_b.session").alias("latestSession"), x.et_display("_b.et").alias("latestBarTimeEt"), "vwapDate", "regularBarCount",
        x.round_up("_last", 4).alias("intradayVwapLast"), F.when(F.col("_valid") > 0, x.round_up(F.lit(100.0) * F.col("_above") / F.col("_valid"), 2)).alias("pctRegularMinutesAboveVwap"),
    )


def latest_bar(bars: DataFrame) -> DataFrame:
    """Of each symbol how many bars there are and the last one's price, session and Eastern time; its price may be null."""
    at = F.struct("ts", "seq")
    out = bars.groupBy("symbol").agg(F.count("*").alias("intradayBarCount"), F.max_by(F.struct("close", "et", "session"), at).alias("_b"))
    return out.select("symbol", "intradayBarCount", F.col("_b.close").alias("latestPrice"), F.col("_b.session").alias("latestSession"), x.et_display("_b.et").alias("latestBarTimeEt"))
