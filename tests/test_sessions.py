"""Running VWAP of a stream against the same of a table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickforge.operators import bars as b
from tickforge.operators import vwap
from tickforge.sources import tables
from tickforge.streaming import live, sessions

TICK = "symbol string, ts timestamp, seq long, cents long, volume long"
EVENTS = "/root/testdata/sf0.001"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, sessions.PROVIDER)
    yield
    spark.conf.unset(key)


def run(spark, folder, out, checkpoint, late="10 minutes"):
    """One run over all files that are new; gives the query's batches."""
    stream = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(folder)
    q = sessions.running_vwap(live.minute_bars(stream, late, event_time=True), 2).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    return q.recentProgress


def keyed(df):
    return sorted((r["symbol"], r["et_date"], r["ts"], r["valid"], r["cum_volume"], None if r["vwap"] is None else round(r["vwap"], 9)) for r in df.collect())


def whole(ticks, upto=None):
    """What the batch operator says of the bars that end by ``upto``."""
    minute = b.from_ticks(ticks)
    minute = minute if upto is None else minute.filter(F.col("ts") + F.expr("INTERVAL 1 MINUTE") <= F.lit(upto))
    return keyed(vwap.running(b.with_session(minute).filter("session = 'regular'"), 2))


def write(spark, rows, folder, k):
    spark.createDataFrame(rows, TICK).coalesce(1).write.mode("append").parquet(folder if k is None else f"{folder}/part={k}")


def test_stream_equals_table_over_restarts(spark, rocks, tmp_path):
    ticks = tables.ticks(spark, EVENTS)
    days = [r[0] for r in ticks.select(F.to_date("ts")).distinct().orderBy(F.to_date("ts")).collect()]
    folder, out, at = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    upto = None
    for k in range(0, len(days), 8):  # a run for some days, then another from the checkpoint
        for day in days[k : k + 8]:
            ticks.filter(F.to_date("ts") == F.lit(day)).coalesce(1).write.mode("append").parquet(folder)
        run(spark, folder, out, at)
        upto = ticks.filter(F.to_date("ts") <= F.lit(days[min(k + 7, len(days) - 1)])).agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
        assert keyed(spark.read.schema(sessions.RUNNING).parquet(out)) == whole(ticks, upto)
    assert len(whole(ticks, upto)) > 100


def test_late_ticks_and_state(spark, rocks, tmp_path):
    folder, out, at = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    t0 = dt.datetime(2024, 3, 11, 13, 30)  # the open, after clocks changed
    row = lambda m, s, k, c, v=2, sym="A": (sym, t0 + dt.timedelta(minutes=m, seconds=s), k, c, v)
    write(spark, [row(0, 1, 1, 100), row(1, 1, 2, 110), row(30, 0, 3, 120, 0)], folder, None)
    run(spark, folder, out, at)
    late_in_time, too_late = row(25, 0, 4, 500, 7), row(2, 0, 5, 900, 9)  # the watermark stands 20 minutes after the open
    write(spark, [late_in_time, too_late], folder, None)
    run(spark, folder, out, at)
    write(spark, [row(31, 0, 6, 130), row(60 * 30, 0, 7, 90, 1), row(60 * 72, 0, 8, 1, 1)], folder, None)
    progress = run(spark, folder, out, at)
    ticks = spark.read.schema(TICK).parquet(folder).filter("seq NOT IN (5, 8)")
    assert keyed(spark.read.schema(sessions.RUNNING).parquet(out)) == whole(ticks)
    kept = [o for p in progress for o in p["stateOperators"] if "transformWithState" in o["operatorName"]]
    assert kept and kept[-1]["numRowsTotal"] == 0  # sums and timers of sessions that are over are gone
