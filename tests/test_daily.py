"""Days that are kept and added to, against the whole computation; one pass over bars for a batch."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tickforge.operators import bars as b
from tickforge.operators import daily, vwap
from tickforge.plans.queries import QUERIES
from tickforge.sources import tables

FOLDER = "/root/testdata/sf0.001"
TICK = "symbol string, ts timestamp, seq long, cents long, volume long"


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("sparse", [False, True])
def test_kept_days_give_the_same_quotes(spark, tmp_path, sparse):
    t = tables.ticks(spark, FOLDER, sparse)
    table = daily.DailyTable(spark, str(tmp_path / "d"))
    for day in ("2024-01-05", "2024-01-06", "2024-01-20"):
        assert table.advance(t, day) and not table.advance(t, day) and not table.advance(t, "2024-01-01")
        now = F.lit(dt.datetime(2024, 1, 25, 17, 30, tzinfo=dt.UTC)).cast("timestamp")
        assert rows_of(table.quotes(t, now)) == rows_of(tables.quotes(t.filter(F.col("ts") < now)))
    early = F.lit(dt.datetime(2024, 1, 6, 4, 59, tzinfo=dt.UTC)).cast("timestamp")  # still the fifth in New York
    assert rows_of(table.quotes(t, early)) == rows_of(tables.quotes(t.filter(F.col("ts") < early)))
    assert table.versions() == ["2024-01-05", "2024-01-06", "2024-01-20"] and table.trim(2) == 1 and table.versions() == ["2024-01-06", "2024-01-20"]
    assert all(r["n"] <= 2 for r in table.state()[0].groupBy("symbol").agg(F.count("*").alias("n")).collect())


def test_only_later_ticks_are_read(spark, tmp_path):
    t = spark.createDataFrame([("A", dt.datetime(2024, 1, d, 15, tzinfo=dt.UTC), d, 100 + d, 1) for d in range(2, 20)], TICK)
    t.write.partitionBy("seq").parquet(str(tmp_path / "t"))
    ticks = spark.read.schema(TICK).parquet(str(tmp_path / "t"))
    table = daily.DailyTable(spark, str(tmp_path / "d"))
    table.advance(ticks, "2024-01-15")
    q = table.quotes(ticks, F.lit(dt.datetime(2024, 1, 18, tzinfo=dt.UTC)).cast("timestamp"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert all("GreaterThanOrEqual(ts,2024-01-15" in f and "LessThan(ts,2024-01-18" in f for f in re.findall(r"PushedFilters: \[([^\]]*ts[^\]]*)\]", plan))
    r = q.first()
    assert (r["regularMarketPrice"], r["previousClose"], r["fiftyTwoWeekHigh"], r["fiftyTwoWeekLow"]) == (1.17, 1.16, 1.17, 1.02)


def test_one_pass_says_what_two_did(spark):
    minute = b.with_session(b.from_ticks(tables.ticks(spark, FOLDER, sparse=True)))
    one = vwap.overview(minute, 2)
    two = vwap.latest_bar(minute).join(vwap.session_summary(minute, 2), "symbol", "left").fillna(0, ["regularBarCount"])
    assert rows_of(one.select(two.columns)) == rows_of(two)


def test_a_batch_reads_its_range_once(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES["batch_summary"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet [^\n]*PushedFilters: \[([^\]]*)\]", plan)
    assert sum("GreaterThanOrEqual(ts," in s for s in scans) == 1
