"""Running VWAP of a stream: state by symbol and Eastern date, given up by a timer when the session is over."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickforge.functions import expr as x
from tickforge.operators.vwap import VALID

RUNNING = "symbol string, et_date string, ts timestamp, seq long, close double, valid boolean, cum_volume long, vwap double"
#: The store that keyed state with timers needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RunningVwap(StatefulProcessor):
    """Of a symbol and date: sums of volume and of price times volume so far. Bars of a batch are taken in order of time and seq.

    ``scale``: prices have so many decimals and are summed as integers. A timer at the end of the Eastern date drops the state.
    """

    def __init__(self, scale: int | None = None):
        self.scale = scale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", f"traded {'long' if self.scale is not None else 'double'}, volume long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  names that Spark gives
        bars = pd.concat(list(rows)).sort_values(["ts", "seq"], kind="stable")  # a symbol's minutes of a day at most
        traded, volume = (self.sums.get() if self.sums.exists() else (0, 0))
        unit = 10**self.scale if self.scale is not None else 1
        out = []
        for ts, seq, close, valid, total, v, until in zip(*(bars[c] for c in ("ts", "seq", "close", "valid", "total", "volume", "until")), strict=True):
            vwap = None
            if valid:
                traded, volume = traded + (int(total) if self.scale is not None else float(total)) * int(v), volume + int(v)
                vwap = float(traded) / float(volume * 3 * unit) if volume > 0 else None
            out.append((*key, ts, int(seq), None if pd.isna(close) else float(close), bool(valid), volume, vwap))
        self.sums.update((traded, volume))
        if not len(list(self.handle.listTimers())):
            self.handle.registerTimer(int(until))
        names = [c.split()[0] for c in RUNNING.split(", ")]
        yield pd.DataFrame({n: pd.Series([r[k] for r in out], dtype=object if n in ("close", "vwap") else None) for k, n in enumerate(names)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.sums.clear()
        return iter([])

    def close(self) -> None:
        pass


def running_vwap(bars: DataFrame, scale: int | None = None) -> DataFrame:
    """Regular bars of a stream with valid, cum_volume and vwap, as ``operators.vwap.running`` gives them for a table.

    ``bars``: symbol, ts, seq, high, low, close, volume and ``at``, their event time, with a watermark. Each bar must come once and
    those of a symbol in batches that follow its time, as ``live.minute_bars`` gives them. Append mode; needs the state store PROVIDER.
    """
    unit = 10**scale if scale is not None else 1
    total = F.col("high") + F.col("low") + F.col("close")
    total = F.floor(total * unit + 0.5).cast("long") if scale is not None else total
    day_end = F.to_utc_timestamp(F.date_trunc("DAY", x.eastern("ts")) + F.expr("INTERVAL 1 DAY"), x.ZONE)
    rows = bars.withColumn("et", x.eastern("ts")).filter(x.session(x.et_minute("et")) == "regular")
    rows = rows.select("symbol", x.et_date("et").alias("et_date"), "ts", "seq", "close", F.expr(VALID).alias("valid"), F.coalesce(total, F.lit(0)).alias("total"), F.coalesce("volume", F.lit(0)).alias("volume"), F.unix_millis(day_end).alias("until"), "at")
    return rows.groupBy("symbol", "et_date").transformWithStateInPandas(RunningVwap(scale), RUNNING, "Append", "EventTime")


def run_to_table(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream over all there is and give what it has appended to a table in ``folder``; a second run goes on where the first ended.

    The state store that keyed state needs is set for this query alone.
    """
    spark: SparkSession = stream.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, PROVIDER)
    try:
        q = stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
