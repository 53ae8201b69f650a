"""The vendor's sources: turns of all tasks together, pushed filters, streams that are stopped and go on."""

import datetime as dt
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickforge.operators import bars as b
from tickforge.sources import vendor

MINUTE = 60_000
T0 = 28_000_000 * MINUTE  # a whole minute


def ask_times(symbol, interval, begin, end):
    """A bar whose date is when it was asked for."""
    return [{"date": dt.datetime.fromtimestamp(time.time(), dt.UTC), "open": 1.0}]


def ask_ranges(symbol, interval, begin, end):
    """A bar each minute of the range, and one too many on either side; open and close tell what was asked for."""
    at = lambda ms: dt.datetime.fromtimestamp(ms / 1000, dt.UTC)
    return [{"date": at(ms), "open": float(begin), "close": float(end), "volume": 5} for ms in range(begin - MINUTE, end + 2 * MINUTE, MINUTE)]


def ask_sick(symbol, interval, begin, end):
    if symbol == "C":
        raise RuntimeError("vendor")
    return ask_ranges(symbol, interval, begin, end)


def ask_quotes_singly(symbols):
    if len(symbols) > 1:
        raise RuntimeError("vendor")
    return [{"symbol": symbols[0], "regularMarketPrice": time.time()}]


def test_turns_never_meet():
    """Lanes that begin at any time, some again, with calls of several costs."""
    rng = random.Random(5)
    for lanes, length in ((1, 0.5), (4, 0.12), (7, 0.5)):
        taken = []
        for lane in [*range(lanes), 0]:
            if lane == 0 and len(taken) > 3:
                taken = [t for t in taken if t[2] != 0]  # the task is run again
            now = [1.7e9 + rng.random() * 3]

            def sleep(s, now=now):
                now[0] += s

            turns = vendor.Turns(lane, lanes, length, lambda now=now: now[0], sleep)
            for _ in range(40):
                cost = rng.choice([length, length * 0.4])
                at = turns.take(cost)
                assert abs(now[0] - at) < 1e-6
                taken.append((at, cost, lane))
                now[0] += rng.random() * length * 3  # the call itself
        taken.sort()
        assert all(after[0] - before[0] >= before[1] - 1e-5 for before, after in zip(taken, taken[1:], strict=False))


def test_rate_holds_over_tasks(spark):
    pause = 0.15
    df = vendor.vendor_bars(spark, [f"S{k}" for k in range(24)], "tests.test_vendor:ask_times", 0, 1000, pause_ms=int(pause * 1000), lanes=4)
    assert df.rdd.getNumPartitions() == 4
    at = sorted(r["ts"].timestamp() for r in df.collect())
    gaps = [z - a for a, z in zip(at, at[1:], strict=False)]
    assert len(at) == 24 and min(gaps) > pause * 0.6  # a worker may wake a little late
    assert max(Counter(int((t - at[0]) / (pause * 4)) for t in at).values()) <= 5 and at[-1] - at[0] >= 23 * pause * 0.95


def test_single_quotes_keep_their_pause(spark):
    vendor.register(spark)
    df = spark.read.format("vendor_quotes").options(symbols=",".join(f"S{k}" for k in range(8)), client="tests.test_vendor:ask_quotes_singly", pause_ms=100, chunk_pause_ms=250).load()
    at = sorted(r["regularMarketPrice"] for r in df.collect())
    assert len(at) == 8 and min(z - a for a, z in zip(at, at[1:], strict=False)) > 0.07


def test_readers_share_turns():
    calls = [["a"], ["b"], ["c"]]
    lanes = [(x.lane, x.lanes) for k in range(2) for x in vendor._lanes(calls, {"lanes": "2", "reader": str(k), "readers": "2"})]
    assert lanes == [(0, 4), (1, 4), (2, 4), (3, 4)]


def instant(ms):
    return F.lit(dt.datetime.fromtimestamp(ms / 1000, dt.UTC))


def test_filters_reach_the_vendor(spark):
    df = vendor.vendor_bars(spark, ["a", "b", "brk.b"], "tests.test_vendor:ask_ranges", T0, T0 + 600 * MINUTE, "1m,5m", pause_ms=0)
    some = df.filter((F.col("symbol") == "BRK.B") & (F.col("interval") == "5m") & (F.col("ts") >= instant(T0 + 30 * MINUTE)) & (F.col("ts") < instant(T0 + 40 * MINUTE)))
    rows = some.collect()
    assert {(r["symbol"], r["interval"], r["open"], r["close"]) for r in rows} == {("BRK.B", "5m", T0 + 30.0 * MINUTE, T0 + 40.0 * MINUTE)}
    assert sorted(r["ts"].timestamp() * 1000 for r in rows) == [T0 + k * MINUTE for k in range(30, 40)]  # more than was asked for is left out
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "ts" in plan.split("Filter")[1] and "BRK.B" not in plan.split("Filter ")[1].split("\n")[0]  # time is looked at again, the symbol isn't
    both = df.filter(F.col("symbol").isin("A", "B") & (F.col("ts") == instant(T0 + 7 * MINUTE))).collect()
    assert Counter((r["symbol"], r["interval"]) for r in both) == {(s, i): 1 for s in "AB" for i in ("1m", "5m")}
    assert df.filter("symbol = 'NOPE'").collect() == [] and df.filter("symbol = 'A' OR interval = '5m'").count() == 4 * 603
    assert df.count() == 6 * 603  # nothing that was pushed before is left
    plain = df.filter(F.col("symbol") == "A").select("symbol", F.col("ts").alias("t"))
    assert plain.count() == 2 * 603


def test_quote_filters(spark):
    vendor.register(spark)
    df = spark.read.format("vendor_quotes").options(symbols="a,b,brk.b", client="tests.test_live:ask", pause_ms=0, chunk_pause_ms=0, push="true").load()
    assert [r["symbol"] for r in df.filter("symbol = 'BRK-B'").collect()] == ["BRK-B"] and df.filter("symbol IN ('A', 'X')").count() == 1


def stream(spark, now, folder, client="ask_ranges", **options):
    """Bars up to ``now``, appended to a table; what ends the query is raised."""
    s = vendor.vendor_bar_stream(spark, ["a", "B", "c"], f"tests.test_vendor:{client}", T0, pause_ms=0, now_ms=now, **options)
    q = s.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/log").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def bars_of(spark, folder):
    return Counter((r["symbol"], int(r["ts"].timestamp() * 1000)) for r in spark.read.schema(vendor.VENDOR_BAR).parquet(f"{folder}/rows").collect())


def want(upto):
    return Counter((s, ms) for s in "ABC" for ms in range(T0, upto, MINUTE))


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    f = str(tmp_path)
    stream(spark, T0 + 5 * MINUTE, f)
    assert bars_of(spark, f) == want(T0 + 4 * MINUTE)  # the last one is settling
    stream(spark, T0 + 5 * MINUTE, f)
    assert bars_of(spark, f) == want(T0 + 4 * MINUTE)
    with pytest.raises(Exception, match="vendor"):  # a symbol's call fails in the midst of a batch
        stream(spark, T0 + 30 * MINUTE, f, "ask_sick")
    assert bars_of(spark, f) == want(T0 + 4 * MINUTE)
    stream(spark, T0 + 40 * MINUTE, f)  # the batch that failed is read again, with its own offsets
    assert bars_of(spark, f) == want(T0 + 39 * MINUTE)
    stream(spark, T0 + 11 * 1440 * MINUTE, f, settle_ms=0)  # more than a call may ask for
    assert bars_of(spark, f) == want(T0 + 11 * 1440 * MINUTE)


def test_stream_may_skip_failures(spark, tmp_path):
    stream(spark, T0 + 9 * MINUTE, str(tmp_path), "ask_sick", failures="skip")
    assert bars_of(spark, str(tmp_path)) == Counter({k: n for k, n in want(T0 + 8 * MINUTE).items() if k[0] != "C"})


def test_offsets_never_go_back(monkeypatch):
    r = vendor._BarStream({"symbols": "a", "client": "x:y", "start_ms": "0", "settle_ms": "0"})
    monkeypatch.setattr(vendor.time, "time", lambda: 1000.0)
    assert r.initialOffset() == {"ms": 0} and r.latestOffset() == {"ms": 960_000}
    monkeypatch.setattr(vendor.time, "time", lambda: 500.0)
    assert r.latestOffset() == {"ms": 960_000}
    r.commit({"ms": 1_200_000})
    assert r.latestOffset() == {"ms": 1_200_000} and r.partitions({"ms": 5}, {"ms": 5}) == []


def test_vendor_bars_become_bars(spark):
    df = vendor.vendor_bars(spark, ["a"], "tests.test_vendor:ask_ranges", T0, T0 + 10 * 1440 * MINUTE, pause_ms=0)
    got = b.dedupe(b.from_vendor(df, "1m"))
    assert got.count() == 10 * 1440 + 3 and df.count() > got.count()  # chunks share instants
