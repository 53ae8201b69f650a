"""Edge rows of sessions, VWAP, summaries and history."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.functions import expr as x
from tickforge.operators import bars as b
from tickforge.operators import history as h
from tickforge.operators import present, script, snapshots, summary, vwap
from tickforge.sources import lists

NY = ZoneInfo("America/New_York")


def et(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=NY).astimezone(dt.UTC)


def bar(time, o=1.0, hi=1.0, lo=1.0, cl=1.0, v=10, symbol="A", seq=None):
    return (symbol, "1m", et(time), seq if seq is not None else int(et(time).timestamp()), o, hi, lo, cl, v)


def bars(spark, *rows):
    return b.with_session(spark.createDataFrame(list(rows), schemas.BAR))


def number(spark, column, *values):
    names = ["a", "b"][: len(values)]
    return spark.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in names)).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("time", "session", "compat", "script_session"), [
    ("09:29:59", "premarket", "premarket", "premarket"), ("09:30:00", "regular", "regular", "regular"), ("16:00:00", "regular", "regular", "regular"),
    ("16:00:59", "regular", "regular", "afterhours"), ("16:01:00", "afterhours", "afterhours", "afterhours"), ("00:05:00", "premarket", "afterhours", "premarket"),
])
def test_session_edges(spark, time, session, compat, script_session):
    df = spark.createDataFrame([bar(f"2024-01-10T{time}")], schemas.BAR)
    assert b.with_session(df).first()["session"] == session
    assert b.with_session(df, True).first()["session"] == compat
    assert b.with_session(df).select(x.session_v2("et").alias("s")).first()["s"] == script_session


def test_daylight_saving(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 11, 3, 5, 30, tzinfo=dt.UTC),), (dt.datetime(2024, 11, 3, 6, 30, tzinfo=dt.UTC),), (dt.datetime(2024, 3, 10, 7, 0, tzinfo=dt.UTC),)], "ts timestamp")
    got = [r[0] for r in df.orderBy("ts").select(x.et_with_zone("ts")).collect()]
    assert got == ["2024-03-10 03:00:00 EDT", "2024-11-03 01:30:00 EDT", "2024-11-03 01:30:00 EST"]


def test_rounding_and_returns(spark):
    assert number(spark, x.round_up("a", 2), -0.025) == -0.02 and number(spark, x.round_up("a", 2), 0.025) == 0.03
    assert number(spark, x.return_pct("a", "b"), 11.0, 10.0) == 10.0
    for a, z in ((0.0, 1.0), (1.0, 0.0), (float("nan"), 1.0), (None, 1.0)):
        assert number(spark, x.return_pct("a", "b"), a, z) is None
    assert number(spark, x.latest_change_pct("a", "b"), 0.0, 5.0) == -100.0 and number(spark, x.latest_change_pct("a", "b"), 5.0, 0.0) is None


def test_formats(spark):
    shown = [number(spark, x.short_volume("a"), v) for v in (None, 999.0, 1250.0, 2.5e6, 3e9, -5000.0)]
    assert shown == ["—", "999.0", "1.3K", "2.50M", "3.00B", "-5000.0"]
    assert [number(spark, x.signed_pct("a"), v) for v in (None, 0.0, -1.5)] == ["—", "+0.00%", "-1.50%"]
    assert [number(spark, x.strength("a"), v) for v in (None, 60.0, 40.0, 39.9)] == ["muted", "green", "yellow", "red"]
    assert number(spark, x.safe_double(F.lit("n/a")), 1.0) is None and number(spark, x.safe_long(F.lit("12.9")), 1.0) == 12


def test_vwap_skips_what_is_not_valid(spark):
    df = bars(spark, bar("2024-01-10T10:00", cl=None), bar("2024-01-10T10:01", v=None), bar("2024-01-10T10:02", v=0), bar("2024-01-10T10:03", o=None, hi=4.0, lo=2.0, cl=3.0))
    r = vwap.session_summary(df).first()
    assert (r["regularBarCount"], r["intradayVwapLast"], r["pctRegularMinutesAboveVwap"]) == (4, 3.0, 0.0)


def test_negative_volume_counts_but_gives_no_vwap_while_the_sum_is_not_positive(spark):
    df = bars(spark, bar("2024-01-10T10:00", v=-10), bar("2024-01-10T10:01", v=10), bar("2024-01-10T10:02", hi=3.0, lo=3.0, cl=3.0, v=10))
    assert [r["vwap"] for r in vwap.running(df).orderBy("ts").collect()] == [None, None, 3.0]


def test_newest_regular_date_and_latest_bar(spark):
    df = bars(spark, bar("2024-01-09T10:00", cl=2.0, hi=2.0, lo=2.0), bar("2024-01-10T08:00", cl=None))
    assert vwap.session_summary(df).first()["vwapDate"] == "2024-01-09"
    r = vwap.latest_bar(df).first()
    assert (r["latestPrice"], r["latestSession"], r["latestBarTimeEt"], r["intradayBarCount"]) == (None, "premarket", "01/10/2024, 08:00:00 ET", 2)


def quote(spark, symbol="A", **kw):
    base = {"symbol": symbol, "shortName": "a", "regularMarketOpen": 10.0, "regularMarketDayHigh": 12.0, "regularMarketDayLow": 9.0, "regularMarketPrice": 11.0, "previousClose": 10.0, "regularMarketVolume": 5}
    return spark.createDataFrame([tuple((base | kw).get(c) for c in schemas.names(schemas.QUOTE))], schemas.QUOTE)


def asked(spark, *symbols):
    return spark.createDataFrame(list(enumerate(symbols)), "pos int, symbol string")


def test_summary_of_missing_things(spark):
    as_of = F.lit(et("2024-01-10T20:00")).cast("timestamp")
    empty = spark.createDataFrame([], schemas.BAR)
    got = summary.batch_summary(asked(spark, " brk.b", "X", "brk.b"), quote(spark, "BRK-B"), empty, as_of).orderBy("pos").collect()
    assert [r["symbol"] for r in got] == ["BRK.B", "X", "BRK.B"]
    assert got[0]["intradayVwapLast"] == 10.6667 and got[0]["regularBarCount"] == 0 and got[0]["pctRegularMinutesAboveVwap"] is None and got[0]["fetchError"] is None
    assert got[0]["intradayReturnPct"] == 10.0 and got[0]["prevClose"] == 10.0
    assert got[1]["fetchError"] == "No quote data" and all(got[1][c] is None for c in schemas.SUMMARY_COLUMNS if c not in ("symbol", "fetchError"))
    df = summary.batch_summary(asked(spark, "A"), quote(spark), empty, as_of)
    assert df.drop("pos").columns == schemas.SUMMARY_COLUMNS
    assert summary.batch_summary(asked(spark, "A"), quote(spark, regularMarketOpen=0.0), empty, as_of).first()["intradayReturnPct"] is None


def test_all_zero_volume_day_falls_back_to_the_quote(spark):
    as_of = F.lit(et("2024-01-10T20:00")).cast("timestamp")
    df = spark.createDataFrame([bar("2024-01-10T10:00", v=0), bar("2024-01-10T16:00", v=0, cl=0.0)], schemas.BAR)
    r = summary.batch_summary(asked(spark, "A"), quote(spark), df, as_of).first()
    assert (r["vwapDate"], r["regularBarCount"], r["intradayVwapLast"], r["pctRegularMinutesAboveVwap"], r["latestChgPct"]) == ("2024-01-10", 2, 10.6667, None, -100.0)


def test_dedupe_and_chunks(spark):
    df = spark.createDataFrame([bar("2024-01-10T10:00", cl=1.0, seq=2), bar("2024-01-10T10:00", cl=9.0, seq=1)], schemas.BAR)
    assert [r["close"] for r in b.dedupe(df).collect()] == [9.0] == [r["close"] for r in b.dedupe(b.dedupe(df)).collect()]
    cut = lambda s, e: [tuple(c) for c in spark.range(1).select(b.chunks(F.lit(s), F.lit(e), F.lit(10)).alias("c")).first()["c"]]
    assert cut(0, 25) == [(0, 10), (10, 20), (20, 25)] and cut(5, 5) == [] and cut(9, 5) == []


def test_validation(spark):
    with pytest.raises(ValueError, match="period"):
        h.since("5d", "1m", F.current_timestamp())
    with pytest.raises(ValueError, match="type"):
        snapshots.check_type("all")
    with pytest.raises(ValueError, match="symbols"):
        lists.request(lists.texts(spark, '{"symbols": ["A", " "]}'))
    with pytest.raises(ValueError, match="tickers"):
        lists.ticker_arguments("", "# none\n", spark)
    with pytest.raises(ValueError, match="symbol"):
        summary.stock_info(quote(spark), " ")
    assert snapshots.parse_id(" 12abc") == 12
    with pytest.raises(ValueError, match="number"):
        snapshots.parse_id("x1")


def test_lists(spark):
    text = "intro\r\nTicker,Name\r\naapl,x\r\n\"AAPL\",x\r\nBRK-B,x\r\n\r\nAAPL"
    assert [r["symbol"] for r in lists.universe(lists.texts(spark, text)).orderBy("pos").collect()] == ["AAPL", "AAPL"]
    assert lists.universe(lists.texts(spark, "AAPL,x\nMSFT")).count() == 0
    got = lists.categories(lists.texts(spark, """{"X": ['brk.b', AMD, amd, "TWELVELETTRS"], " Y ": ["A"], "X": ["B"], "Z": []}""")).orderBy("cat_pos", "sym_pos").collect()
    assert [(r["category"], r["symbol"]) for r in got] == [("X", "B"), ("Y", "A")]
    one = lists.categories(lists.texts(spark, """{"X": ['brk.b', AMD, amd, "TWELVELETTRS"]}""")).orderBy("sym_pos").collect()
    assert [r["symbol"] for r in one] == ["BRK.B", "AMD", "TWELVELETT", "RS"]


def test_sort_puts_nulls_last_both_ways(spark):
    rows = [(k, *([None] * 22)) for k in range(2)]
    df = spark.createDataFrame(rows, f"pos int, {schemas.SUMMARY}").withColumn("symbol", F.col("pos").cast("string"))
    df = df.unionByName(df.withColumn("pos", F.col("pos") + 2).withColumn("vsPreClosePct", F.col("pos").cast("double")))
    assert [r["pos"] for r in present.sort_items(df).collect()] == [3, 2, 0, 1]
    assert [r["pos"] for r in present.sort_items(df, descending=False).collect()] == [2, 3, 0, 1]
    with pytest.raises(ValueError, match="column"):
        present.sort_items(df, "nope")


def test_snapshot_store(spark, tmp_path):
    as_of = F.lit(et("2024-01-10T20:00")).cast("timestamp")
    items = summary.batch_summary(asked(spark, "A", "X", "A"), quote(spark), spark.createDataFrame([], schemas.BAR), as_of)
    path = str(tmp_path / "store")
    for k, kind in enumerate(("all-stocks", "all-etfs", "all-stocks")):
        snapshots.capture(items, kind, k, F.lit(et(f"2024-01-1{k}T12:00")).cast("timestamp"), path)
    s = snapshots.store(spark, path)
    r = snapshots.latest(s, "all-stocks").first()
    assert (r["id"], r["symbol_count"], r["trade_date"], [i["symbol"] for i in r["results"]]) == (2, 3, "2024-01-12", ["A", "X", "A"])
    assert [x_["id"] for x_ in snapshots.listing(s).collect()] == [2, 1, 0] and "results" not in snapshots.listing(s).columns
    assert [x_["id"] for x_ in snapshots.listing(s, "all-etfs").collect()] == [1] and snapshots.listing_of_type(s, "all-stocks", 1).count() == 1
    assert snapshots.by_id(s, 7).isEmpty() and snapshots.items(snapshots.by_id(s, 1)).columns == ["id", "pos", *schemas.SUMMARY_COLUMNS]


def test_csv_quotes_only_strings_with_commas(spark, tmp_path):
    as_of = F.lit(et("2024-01-10T20:00")).cast("timestamp")
    items = summary.batch_summary(asked(spark, "A"), quote(spark, shortName='Say "A", Inc.'), spark.createDataFrame([], schemas.BAR), as_of)
    assert present.csv_rows(items).first()["line"].startswith('A,"Say "A", Inc.",10.0,10.0,12.0,9.0,11.0,5,10.0,10.0,,')
    present.write_csv(items, str(tmp_path / "csv"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "csv")).collect()][0] == ",".join(schemas.CSV_COLUMNS)


def test_script_rules(spark):
    rows = [bar("2024-01-10T10:00", hi=2.0, lo=2.0, cl=2.0), bar("2024-01-10T10:01", v=0, cl=9.0), bar("2024-01-10T10:02", hi=None, cl=5.0), bar("2024-01-10T16:01", cl=7.0, v=3)]
    df = bars(spark, *rows).withColumn("session", x.session_v2("et"))
    r = script.intraday_v2(df).first()
    assert (r["regular_bar_count"], r["intraday_vwap_last"], r["pct_regular_minutes_above_vwap"], r["is_after_hours_latest"]) == (3, None, 0.0, True)
    assert r["pct_after_hours_minutes_above_regular_vwap"] is None and r["latest_bar_time_et"] == "2024-01-10 16:01:00 EST"
    r = script.intraday_v2(df.filter("high IS NOT NULL AND volume > 0")).first()
    assert (r["intraday_vwap_last"], r["pct_after_hours_minutes_above_regular_vwap"], r["current_vs_vwap_pct"]) == (2.0, 100.0, 250.0)


def test_error_text(spark):
    df = spark.createDataFrame([("﻿ {\"title\": \"t\", \"detail\": \" d \"}",), ("{\"error\": \"e\", \"title\": \"t\"}",), ("{bad",), (None,)], "body string")
    got = [r[0] for r in df.select(x.error_text(F.lit(404), F.lit("Not Found"), "body")).collect()]
    assert got[0] == "HTTP 404 Not Found: t — d" and got[1] == "HTTP 404 Not Found: e" and got[3] == "HTTP 404 Not Found"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(570, 960), st.integers(100, 900), st.integers(0, 50)), min_size=1, max_size=12, unique_by=lambda r: r[0]), st.randoms())
def test_vwap_properties(spark, rows, rnd):
    made = [bar(f"2024-01-10T{m // 60:02}:{m % 60:02}", p / 100, p / 100, p / 100, p / 100, v) for m, p, v in rows]
    shuffled = made[:]
    rnd.shuffle(shuffled)
    first, second = (vwap.session_summary(bars(spark, *m), 2).first() for m in (made, shuffled))
    assert first == second
    valid = [p / 100 for _, p, v in rows if v]
    if valid:
        assert min(valid) - 1e-4 <= first["intradayVwapLast"] <= max(valid) + 1e-4 and 0 <= first["pctRegularMinutesAboveVwap"] <= 100
