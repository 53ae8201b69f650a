"""Bars from ticks, sessions, resampling and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions import expr as x

#: Seconds of an interval; days that the vendor gives at once, and how far back it goes.
SECONDS = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600}
CHUNK_DAYS = {"1m": (7, 30), "5m": (60, 60), "15m": (60, 60), "1h": (730, 730), "1d": (36500, 36500)}
DEFAULT_DAYS = (7, 30)


def bucket_start(ts, interval: str) -> Column:
    """Where a bar begins: minutes and hours in UTC; for 1d the UTC instant of Eastern midnight."""
    if interval == "1d":
        return F.to_utc_timestamp(F.date_trunc("DAY", x.eastern(ts)), x.ZONE)
    s = SECONDS[interval]
    seconds = F.unix_seconds(x.c(ts))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(s)))


def bucket_end(ts, interval: str) -> Column:
    """Where the bar ends that an instant is in."""
    if interval == "1d":
        return F.to_utc_timestamp(F.date_trunc("DAY", x.eastern(ts)) + F.expr("INTERVAL 1 DAY"), x.ZONE)
    return F.timestamp_seconds(F.unix_seconds(bucket_start(ts, interval)) + SECONDS[interval])


def tick_range(since, until, interval: str = "1m") -> tuple[Column, Column]:
    """The raw instants, the second exclusive, of all ticks of the bars that begin from ``since`` to before ``until``."""
    return bucket_start(since, interval), bucket_end(x.c(until) - F.expr("INTERVAL 1 MICROSECOND"), interval)


def from_ticks(ticks: DataFrame, interval: str = "1m") -> DataFrame:
    """Bars of ticks (symbol, ts, seq, cents, volume). Partial aggregates meet, so a busy symbol costs a row a bucket and task."""
    at, start = F.struct("ts", "seq"), bucket_start("ts", interval)
    price = lambda c: (c / 100.0)
    out = ticks.groupBy("symbol", start.alias("start")).agg(
        F.min("seq").alias("seq"), F.min_by("cents", at).alias("o"), F.max("cents").alias("h"), F.min("cents").alias("l"), F.max_by("cents", at).alias("c"), F.sum("volume").alias("volume")
    )
    return out.select("symbol", F.lit(interval).alias("interval"), F.col("start").alias("ts"), "seq", *(price(F.col(k)).alias(n) for k, n in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"))), "volume")


def from_vendor(rows: DataFrame, interval: str) -> DataFrame:
    """Bars of a vendor's rows (symbol, date, open, high, low, close, volume and seq, of any types).

    A date is an instant or a text of one; rows without a readable date are left out. Values that are missing or no numbers are null.
    """
    value = lambda n, t: F.col(n).cast("string").try_cast(t).alias(n)
    ts = F.col("date").cast("string").try_cast("timestamp")
    out = rows.select("symbol", F.lit(interval).alias("interval"), ts.alias("ts"), F.col("seq").cast("long").alias("seq"), *(value(n, "double") for n in ("open", "high", "low", "close")), value("volume", "long"))
    return out.filter("ts IS NOT NULL")


def resample(bars: DataFrame, interval: str) -> DataFrame:
    """Coarser bars of finer ones: first open, highest, lowest, last close, summed volume."""
    at = F.struct("ts", "seq")
    out = bars.groupBy("symbol", bucket_start("ts", interval).alias("start")).agg(
        F.min("seq").alias("seq"), F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"), F.sum("volume").alias("volume")
    )
    return out.select("symbol", F.lit(interval).alias("interval"), F.col("start").alias("ts"), "seq", "open", "high", "low", "close", "volume")


def with_session(bars: DataFrame, compat_midnight: bool = False) -> DataFrame:
    """et, et_date, minute and session of each bar."""
    out = bars.withColumn("et", x.eastern("ts")).withColumn("et_date", x.et_date("et")).withColumn("minute", x.et_minute("et"))
    return out.withColumn("session", x.session("minute", compat_midnight))


def dedupe(bars: DataFrame, order: str | list[str] = "seq") -> DataFrame:
    """Of bars of the same symbol and instant the first by ``order``."""
    order = [order] if isinstance(order, str) else order
    w = Window.partitionBy("symbol", "ts").orderBy(*order)
    return bars.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def chunks(start_ms, end_ms, chunk_ms) -> Column:
    """Array of (from, to) that cut a range; neighbours share an instant, an empty range has none."""
    s, e, n = x.c(start_ms), x.c(end_ms), x.c(chunk_ms)
    last = F.ceil((e - s) / n).cast("long") - 1
    return F.when(e > s, F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.struct((s + k * n).alias("from_ms"), F.least(s + (k + 1) * n, e).alias("to_ms")))).otherwise(F.array().cast("array<struct<from_ms: long, to_ms: long>>"))


def recent_since(as_of: Column) -> Column:
    """Where the intraday scan begins: 08:00 UTC three days before."""
    return F.date_trunc("DAY", as_of - F.expr("INTERVAL 3 DAYS")) + F.expr("INTERVAL 8 HOURS")


def recent(bars: DataFrame, as_of: Column) -> DataFrame:
    """The bars of the intraday scan, up to ``as_of``."""
    return bars.filter((F.col("ts") >= recent_since(as_of)) & (F.col("ts") < as_of))


def recent_bars(ticks: DataFrame, as_of: Column) -> DataFrame:
    """Minute bars of the intraday scan from ticks; the range is a filter on raw instants, which the scan of the ticks can use."""
    lo, hi = tick_range(recent_since(as_of), as_of)
    return recent(from_ticks(between(ticks, lo, hi), "1m"), as_of)


def between(ticks: DataFrame, since: Column, until: Column) -> DataFrame:
    """Ticks from ``since`` to before ``until``."""
    return ticks.filter((F.col("ts") >= since) & (F.col("ts") < until))


def day_range(date: str) -> tuple[Column, Column]:
    """The raw instants, the second exclusive, of an Eastern date."""
    day = F.lit(date).cast("timestamp")
    return F.to_utc_timestamp(day, x.ZONE), F.to_utc_timestamp(day + F.expr("INTERVAL 1 DAY"), x.ZONE)
