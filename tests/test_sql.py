"""The engine's calls in SQL against the calls themselves."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tickforge import sql
from tickforge.operators import bars as b
from tickforge.operators import history as h
from tickforge.operators import summary, vwap
from tickforge.sources import tables

FOLDER = "/root/testdata/sf0.001"
def now():
    return F.lit(dt.datetime(2024, 1, 30, 21, 17, tzinfo=dt.UTC)).cast("timestamp")


AT = "TIMESTAMP '2024-01-30 21:17:00Z'"


@pytest.fixture(scope="module")
def ticks(spark):
    t = tables.ticks(spark, FOLDER)
    sql.register(spark, t, tables.quotes(t))
    return t


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize(("period", "bar"), [("1d", "15m"), ("max", "1h"), ("max", "1d"), ("1d", "1m")])
def test_history(spark, ticks, period, bar):
    got = spark.sql(f"SELECT * FROM history('VIEW', '{period}', '{bar}', {AT})")
    want = h.history(ticks, ["VIEW"], period, bar, now())
    assert got.columns == want.columns and rows_of(got) == rows_of(want) and got.count() > 0


def test_history_of_many_and_of_none(spark, ticks):
    got = spark.sql(f"SELECT n.s, x.* FROM VALUES ('VIEW'), ('ERROR'), ('NOPE') AS n(s), LATERAL history(n.s, '1d', '1h', {AT}) AS x")
    assert rows_of(got.drop("s")) == rows_of(h.history(ticks, ["VIEW", "ERROR"], "1d", "1h", now()))
    assert spark.sql(f"SELECT * FROM history('NOPE', 'max', '1d', {AT})").collect() == []
    for period, bar in (("5d", "1h"), ("max", "2m")):
        assert spark.sql(f"SELECT * FROM history('VIEW', '{period}', '{bar}', {AT})").collect() == []


def test_history_prunes(spark, ticks):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = spark.sql(f"SELECT * FROM history('VIEW', '1d', '15m', {AT})")._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"FileScan parquet [^\n]*PushedFilters: \[([^\]]*)\]", plan)
    assert len(pushed) == 1 and "Python" not in plan


def test_info(spark, ticks):
    assert rows_of(spark.sql("SELECT * FROM stock_info('VIEW')")) == rows_of(summary.stock_info(tables.quotes(ticks), "VIEW"))
    assert spark.sql("SELECT * FROM stock_info('view')").collect() == []


def test_vwap_of_any_table(spark, ticks):
    regular = b.with_session(b.from_ticks(ticks)).filter("session = 'regular'").withColumn("note", F.concat("symbol", F.lit("!")))
    regular.createOrReplaceTempView("some_bars")
    got = spark.sql("SELECT * FROM session_vwap(TABLE(some_bars))")
    want = vwap.running(regular)
    assert got.columns == want.columns  # other columns are handed on
    key = lambda df: sorted((r["symbol"], r["ts"], r["note"], r["valid"], r["cum_volume"], None if r["vwap"] is None else round(r["vwap"], 9)) for r in df.collect())
    assert key(got) == key(want)
    with pytest.raises(Exception, match="no column close"):
        spark.sql("SELECT * FROM session_vwap(TABLE(SELECT symbol, et_date, ts, high, low, volume FROM some_bars))").collect()
    with pytest.raises(Exception, match="a column vwap already"):
        spark.sql("SELECT * FROM session_vwap(TABLE(SELECT *, 1 AS vwap FROM some_bars))").collect()
