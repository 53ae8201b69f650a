"""Bar history of a symbol over a period, at an interval."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.operators import bars as b

PERIODS, INTERVALS = ("1d", "max"), ("1m", "5m", "15m", "1h", "1d")
#: What the presets ask for.
PRESETS = {"minute": (("max", "1m"),), "intraday": (("max", "1m"), ("max", "15m")), "all": (("max", "1d"), ("max", "1m"), ("max", "15m"))}


def since(period: str, interval: str, as_of: Column) -> Column:
    """Start of the range: 24 hours before for 1d, else as far as the interval's data go back."""
    if period not in PERIODS or interval not in INTERVALS:
        raise ValueError(f"period must be one of {PERIODS}, interval one of {INTERVALS}")
    days = 1 if period == "1d" else b.CHUNK_DAYS.get(interval, b.DEFAULT_DAYS)[1]
    return as_of - F.make_interval(days=F.lit(days))


def lookback(period: Column, interval: Column) -> Column:
    """Days that a history of these parameters goes back, null where they can't be taken."""
    days = F.create_map(*(F.lit(v) for i in INTERVALS for v in (i, b.CHUNK_DAYS[i][1])))
    known = interval.isin(*INTERVALS)
    return F.when((period == "1d") & known, F.lit(1)).when((period == "max") & known, F.try_element_at(days, interval))


def history(ticks: DataFrame, symbols: list[str], period: str, interval: str, as_of: Column) -> DataFrame:
    """Bars of the symbols in the range, first of each instant, with period and interval. Unknown symbols have no rows.

    Bars are those that begin in the range, of all their ticks before ``as_of``; the range reaches the scan of the ticks.
    """
    begin = since(period, interval, as_of)
    rows = b.between(ticks.filter(F.col("symbol").isin(*symbols)), b.bucket_start(begin, interval), as_of)
    out = b.dedupe(b.from_ticks(rows, interval).filter(F.col("ts") >= begin))
    return out.select(F.upper("symbol").alias("symbol"), F.lit(period).alias("period"), "interval", "ts", "open", "high", "low", "close", "volume")


def preset(ticks: DataFrame, symbols: list[str], name: str, as_of: Column) -> DataFrame:
    return reduce(DataFrame.unionByName, [history(ticks, symbols, p, i, as_of) for p, i in PRESETS[name]])


def envelope(h: DataFrame, fetched_at: Column) -> DataFrame:
    """A JSON document a symbol, period and interval: rowCount and the bars in order. A history's bars are bounded by its range."""
    bar = F.struct("ts", F.struct(x.iso_utc("ts").alias("date"), "open", "high", "low", "close", "volume").alias("bar"))
    out = h.groupBy("symbol", "period", "interval").agg(F.count("*").alias("rowCount"), F.transform(F.sort_array(F.collect_list(bar)), lambda e: e.bar).alias("data"))
    return out.select("symbol", "period", "interval", F.to_json(F.struct("symbol", "period", "interval", "rowCount", "data", x.iso_utc(fetched_at).alias("fetchedAt"))).alias("body"))


def csv_blocks(h: DataFrame, fetched_at: Column) -> DataFrame:
    """A block of text a symbol, period and interval: a comment line, the header, the rows; blocks are joined by a blank line."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat_ws(",", x.iso_utc("ts"), *map(value, ("open", "high", "low", "close", "volume")))
    out = h.groupBy("symbol", "period", "interval").agg(F.count("*").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("ts", line.alias("line")))), lambda e: e.line).alias("lines"))
    head = F.format_string("# %s | period=%s | interval=%s | rows=%d | fetchedAt=%s", "symbol", "period", "interval", "n", x.iso_utc(fetched_at))
    return out.select("symbol", "period", "interval", F.concat_ws("\n", head, F.lit("date,open,high,low,close,volume"), F.array_join("lines", "\n")).alias("block"))


def csv_text(blocks: DataFrame) -> DataFrame:
    """One text of all blocks (symbol, period, interval, block) in their order, a blank line between them. A client's download: its parts meet in one row."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("symbol", "period", "interval", "block"))), lambda e: e.block)
    return blocks.agg(F.count("*").alias("n_blocks"), F.array_join(parts, "\n\n").alias("text"))


def preview(h: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of each symbol, period and interval, by time, and how many more there are.

    Ranks are cut to ``n`` before they are shuffled, and counts are added up from partial ones, so that no task holds a history.
    """
    key = ["symbol", "period", "interval"]
    counts = h.groupBy(*key).agg(F.count("*").alias("_n"))
    first = h.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy("ts"))).filter(F.col("_k") <= n).drop("_k")
    return first.join(counts, key).withColumn("n_more", F.greatest(F.col("_n") - n, F.lit(0))).drop("_n")
