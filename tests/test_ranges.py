"""Ranges of raw instants: what reaches the scans, and what bars begin and end a range."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.api import Engine
from tickforge.functions import expr as x
from tickforge.operators import bars as b
from tickforge.operators import history as h
from tickforge.operators import present, snapshots, summary
from tickforge.plans.queries import QUERIES
from tickforge.sources import tables
from tickforge.sources.vendor import BarSource

FOLDER = "/root/testdata/sf0.001"
TICK = "symbol string, ts timestamp, seq long, cents long, volume long"
UTC = dt.timezone.utc


def scans(df):
    """The pushed filters of each scan of events."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [m for m in re.findall(r"FileScan parquet [^\n]*PushedFilters: \[([^\]]*)\]", plan)]


@pytest.mark.parametrize("name", ["history_period_1d", "history_period_max", "vwap_running_v2", "after_hours_v2", "daily_ohlcv_v2", "batch_summary", "batch_summary_missing", "summary_v2"])
def test_both_bounds_reach_the_scan(spark, name):
    found = scans(QUERIES[name](spark, FOLDER))
    assert any("GreaterThanOrEqual(ts," in f and "LessThan(ts," in f for f in found), found


def test_engine_pushes_its_ranges(spark, tmp_path):
    rows = [("A", dt.datetime(2024, 1, d, 15, m, tzinfo=UTC), 100 * d + m, 100 + m, 1) for d in range(2, 20) for m in range(3)]
    spark.createDataFrame(rows, TICK).write.parquet(str(tmp_path / "t"))
    quotes = spark.createDataFrame([("A", *([None] * 15))], schemas.QUOTE)
    e = Engine(spark.read.parquet(str(tmp_path / "t")), quotes)
    now = dt.datetime(2024, 1, 12, 15, 1, 30, tzinfo=UTC)
    for df in (e.batch_summary(["A"], now), e.history("A", "1d", "1h", now), e.ticker_summary_v2("2024-01-12", "A")):
        assert any("GreaterThanOrEqual(ts," in f and "LessThan(ts," in f for f in scans(df))
    r = e.batch_summary(["A"], now).first()
    assert (r["intradayBarCount"], r["latestPrice"], r["vwapDate"]) == (11, 1.01, "2024-01-12")  # 9, 10 and 11 January, and two minutes
    assert e.ticker_summary_v2("2024-01-12", "A").first()["intraday_bar_count"] == 3


def test_first_bar_of_a_history_is_whole(spark):
    """At half past twelve a day's hours begin at one, and the hour of noon before, cut by the range, isn't one of them."""
    at = lambda d, hh, mm: dt.datetime(2024, 1, d, hh, mm, tzinfo=UTC)
    ticks = spark.createDataFrame([("A", at(9, 12, 10), 1, 100, 5), ("A", at(9, 12, 40), 2, 200, 6), ("A", at(9, 13, 5), 3, 300, 7), ("A", at(10, 12, 20), 4, 400, 8), ("A", at(10, 12, 40), 5, 500, 9)], TICK)
    got = h.history(ticks, ["A"], "1d", "1h", F.lit(at(10, 12, 30)).cast("timestamp")).select(x.iso_utc("ts").alias("t"), "open", "close", "volume").orderBy("t").collect()
    assert [tuple(r) for r in got] == [("2024-01-09T13:00:00.000Z", 3.0, 3.0, 7), ("2024-01-10T12:00:00.000Z", 4.0, 4.0, 8)]
    got = h.history(ticks, ["A"], "1d", "1h", F.lit(at(10, 12, 0)).cast("timestamp")).agg(F.min("open"), F.sum("volume")).first()
    assert tuple(got) == (1.0, 18)  # a range that begins with a bar has all of it
    got = h.history(ticks, ["A"], "1d", "1d", F.lit(at(10, 12, 30)).cast("timestamp")).collect()
    assert [r["volume"] for r in got] == [8]


def ask_bars(symbol, interval, begin, end):
    """A vendor without data before its second chunk, whose third fails; neighbours share an instant."""
    week = 7 * 86_400_000
    k = begin // week
    if k == 2:
        raise RuntimeError("vendor")
    if k == 0:
        return []
    at = lambda ms: dt.datetime.fromtimestamp(ms / 1000, UTC)
    return [{"date": at(begin), "open": 1.0, "close": float(k), "volume": None}, {"date": at(end).isoformat(), "close": float(k) + 0.5, "volume": 3}, {"close": 9.0}]


def test_vendor_bars_skip_chunks_that_fail(spark):
    spark.dataSource.register(BarSource)
    week = 7 * 86_400_000
    df = spark.read.format("vendor_bars").options(symbols="a, brk.b", client="tests.test_ranges:ask_bars", interval="1m", start_ms=0, end_ms=4 * week + 1000, pause_ms=0).load()
    assert df.rdd.getNumPartitions() == 2
    got = b.dedupe(b.from_vendor(df, "1m")).select("symbol", x.iso_utc("ts").alias("t"), "open", "close", "volume").orderBy("symbol", "t").collect()
    mine = [tuple(r)[1:] for r in got if r["symbol"] == "A"]
    assert mine == [("1970-01-08T00:00:00.000Z", 1.0, 1.0, None), ("1970-01-15T00:00:00.000Z", None, 1.5, 3), ("1970-01-22T00:00:00.000Z", 1.0, 3.0, None), ("1970-01-29T00:00:00.000Z", None, 3.5, 3), ("1970-01-29T00:00:01.000Z", None, 4.5, 3)]
    assert {r["symbol"] for r in got} == {"A", "BRK.B"}


def test_vendor_rows_of_any_types(spark):
    rows = [("A", "2024-01-02T15:00:00Z", "1.5", None, "x", "2", "7"), ("A", None, "1", "1", "1", "1", "1"), ("A", "undefined", "1", "1", "1", "1", "1")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "symbol string, date string, open string, high string, low string, close string, volume string, seq long")
    r = b.from_vendor(df, "5m").collect()
    assert len(r) == 1 and (r[0]["open"], r[0]["high"], r[0]["low"], r[0]["close"], r[0]["volume"], r[0]["interval"]) == (1.5, None, None, 2.0, 7, "5m")


def test_trigger_and_timer(spark, tmp_path):
    t = tables.ticks(spark, FOLDER)
    e = Engine(t, tables.quotes(t), str(tmp_path / "s"), {"all-stocks": "Ticker\nVIEW", "all-etfs": "Ticker\nERROR"})
    now = dt.datetime(2024, 1, 30, 23, 0, tzinfo=UTC)
    with pytest.raises(ValueError, match="type"):
        e.trigger("all")
    e.trigger("all-stocks", now).join(120)
    assert e.list_snapshots().count() == 1
    seen = []
    e.capture_all = lambda: seen.append(1) or (_ for _ in ()).throw(RuntimeError("vendor")) if len(seen) == 1 else seen.append(1)
    end = e.start_timer(0.01, 0.05)
    for _ in range(200):
        if len(seen) >= 4:
            break
        import time

        time.sleep(0.05)
    end()
    assert len(seen) >= 4  # a capture that fails doesn't end the timer
    with pytest.raises(ValueError, match="store"):
        Engine(t, tables.quotes(t)).start_timer()


def test_relational_store(spark, tmp_path):
    """The store's table in a database that comes with Spark, results as JSON text."""
    items = summary.batch_summary(spark.createDataFrame([(0, "A"), (1, "X")], "pos int, symbol string"), spark.createDataFrame([("A", *([None] * 15))], schemas.QUOTE), spark.createDataFrame([], schemas.BAR), F.lit("2024-01-10 20:00:00").cast("timestamp"))
    built = snapshots.build(items, "all-stocks", 3, F.lit("2024-01-10 20:00:00").cast("timestamp"))
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    flat = built.withColumn("results", F.to_json("results")).select("id", "type", "trade_date", "fetched_at", "symbol_count", "results")
    flat.write.format("jdbc").options(url=url, dbtable="market_snapshots", createTableColumnTypes="type VARCHAR(32), trade_date VARCHAR(10)", driver="org.apache.derby.jdbc.EmbeddedDriver").save()
    s = snapshots.store_jdbc(spark, url, driver="org.apache.derby.jdbc.EmbeddedDriver")
    r = snapshots.latest(s, "all-stocks").first()
    assert (r["id"], r["symbol_count"], [i["symbol"] for i in r["results"]], r["results"][1]["fetchError"]) == (3, 2, ["A", "X"], "No quote data")
    assert snapshots.by_id(s, 4).isEmpty()


def test_top_counts_the_rest(spark):
    df = spark.createDataFrame([(k, *([None] * 22)) for k in range(7)], f"pos int, {schemas.SUMMARY}").withColumn("vsPreClosePct", F.col("pos").cast("double"))
    assert [(r["pos"], r["n_more"]) for r in present.top(df, n=3).collect()] == [(6, 4), (5, 4), (4, 4)]
    assert [r["n_more"] for r in present.top(df, n=9).collect()] == [0] * 7
