"""Bars and snapshots from streams of ticks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.operators import bars


def minute_bars(ticks: DataFrame, late: str = "10 minutes", width: str = "1 minute", event_time: bool = False) -> DataFrame:
    """Bars of a stream of ticks (symbol, ts, seq, cents, volume); a bar is given when the watermark has passed it.

    With ``event_time`` they have ``at`` too, the last instant of the bar, which carries the watermark on to what follows.
    """
    at = F.struct("ts", "seq")
    out = ticks.withWatermark("ts", late).groupBy(F.window("ts", width), "symbol").agg(
        F.min("seq").alias("seq"), F.min_by("cents", at).alias("o"), F.max("cents").alias("h"), F.min("cents").alias("l"), F.max_by("cents", at).alias("c"), F.sum("volume").alias("volume")
    )
    more = [F.window_time("window").alias("at")] if event_time else []
    return out.select("symbol", F.col("window.start").alias("ts"), "seq", *((F.col(k) / 100.0).alias(n) for k, n in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"))), "volume", *more)


def distinct_bars(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Bars of a stream, the first of each symbol and instant."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["symbol", "ts"])


def capture_every(stream: DataFrame, capture: Callable[[DataFrame, int], None], checkpoint: str, every: str = "30 minutes", once: bool = False):
    """Start a query that hands what has arrived to ``capture``; runs of one query never overlap. ``once``: all there is, then stop."""
    writer = stream.writeStream.foreachBatch(capture).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def resampled(stream_bars: DataFrame, interval: str) -> DataFrame:
    """A batch of streamed bars at a coarser interval, for use in ``capture_every``."""
    return bars.resample(stream_bars, interval)
