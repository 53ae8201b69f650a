"""Streams and the vendor source."""

import datetime as dt

from pyspark.sql import functions as F

from tickforge.sources.vendor import QuoteSource
from tickforge.streaming import live

CALLS: list = []


def ask(symbols):
    """A vendor that fails on many symbols at once, and on one of them always."""
    if len(symbols) > 1 and "BAD" in symbols or symbols == ["BAD"]:
        raise RuntimeError("vendor")
    return [{"symbol": s, "regularMarketPrice": 1.5} if s != "NONE" else {} for s in symbols]


def test_vendor_source_falls_back_to_single_calls(spark):
    spark.dataSource.register(QuoteSource)
    symbols = ",".join([f"S{k}" for k in range(150)] + ["bad", "none", "brk.b"])
    df = spark.read.format("vendor_quotes").option("symbols", symbols).option("client", "tests.test_live:ask").load()
    got = {r["symbol"] for r in df.collect()}
    assert df.rdd.getNumPartitions() == 2 and len(got) == 151 and "BRK-B" in got and "BAD" not in got


def ticks(spark, folder):
    t0 = dt.datetime(2024, 1, 10, 15, 0)
    rows = [("A", t0 + dt.timedelta(seconds=20 * k), k, 100 + k, 2) for k in range(120)]
    spark.createDataFrame(rows, "symbol string, ts timestamp, seq long, cents long, volume long").coalesce(1).write.parquet(folder)
    return spark.readStream.schema("symbol string, ts timestamp, seq long, cents long, volume long").parquet(folder)


def test_minute_bars_of_a_stream(spark, tmp_path):
    q = live.minute_bars(ticks(spark, str(tmp_path / "t")), "1 minute").writeStream.format("memory").queryName("live_bars").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("live_bars").orderBy("ts").collect()
    assert len(got) >= 38 and (got[0]["open"], got[0]["close"], got[0]["volume"]) == (1.0, 1.02, 6)


def test_capture_runs_once_over_what_there_is(spark, tmp_path):
    seen = []
    stream = live.distinct_bars(ticks(spark, str(tmp_path / "t")))
    live.capture_every(stream, lambda df, k: seen.append(df.agg(F.count("*")).first()[0]), str(tmp_path / "c"), once=True).awaitTermination(120)
    assert sum(seen) == 120
