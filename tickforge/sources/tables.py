"""Ticks, quotes and profiles from the event table."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.operators import daily


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir, until the session ends. Only a local session may do without."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="tickforge-")
    path = f"{top}/{name}-{uuid.uuid4().hex}"

    def drop():
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001, S110  the session may be gone at exit
            pass

    atexit.register(drop)
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str, sparse: bool = False, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """symbol, ts, seq, cents, volume: events as trades; symbols are the event types, or with ``sparse`` the users.

    ``since`` and ``until`` (exclusive) bound the instants as the table has them, so that they reach its scan.
    """
    return as_ticks(table(spark, sf_dir, "events"), sparse, since, until)


def as_ticks(e: DataFrame, sparse: bool = False, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """The same of events at hand, a stream's too."""
    e = e if since is None else e.filter(F.col("ts") >= since.cast("timestamp_ntz"))
    e = e if until is None else e.filter(F.col("ts") < until.cast("timestamp_ntz"))
    symbol = F.concat(F.lit("U"), F.col("user_id")) if sparse else F.upper("event_type")
    volume = F.get_json_object("props", "$.k").try_cast("long")
    return e.select(symbol.alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.floor(F.col("value") * 100 + 0.5).cast("long").alias("cents"), volume.alias("volume"))


def quotes(t: DataFrame) -> DataFrame:
    """The vendor's view of ticks: last Eastern day's prices and the close before it, a row per symbol."""
    return daily.quotes(daily.newest(daily.days(t)))


def last_tick(t: DataFrame):
    """The newest instant of a tick or bar table, as a timestamp literal."""
    return F.lit(t.agg(F.max("ts")).first()[0]).cast("timestamp")
