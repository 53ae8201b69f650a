"""The engine's calls over the smallest tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickforge.api import Engine, NotFound, SingleFlight
from tickforge.functions import expr as x
from tickforge.operators import script
from tickforge.schemas import SUMMARY_COLUMNS
from tickforge.sources import tables

FOLDER = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 30, 23, 0, tzinfo=dt.UTC)


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    t = tables.ticks(spark, FOLDER)
    return Engine(t, tables.quotes(t), str(tmp_path_factory.mktemp("s") / "store"), {"all-stocks": "Ticker\nVIEW\nCLICK\nZZZ", "all-etfs": "Ticker,x\nERROR\nVIEW"})


def test_history_and_info(engine):
    rows = engine.history("VIEW", "max", "1h", NOW).collect()
    assert rows and [r["ts"] for r in rows] == sorted(r["ts"] for r in rows)
    assert json.loads(engine.history_json("VIEW", "max", "1h", NOW))["rowCount"] == len(rows)
    assert json.loads(engine.history_json("nope", "1d", "1m", NOW)) == {"symbol": "NOPE", "period": "1d", "interval": "1m", "rowCount": 0, "data": [], "fetchedAt": "2024-01-30T23:00:00.000Z"}
    assert engine.info("VIEW").first()["symbol"] == "VIEW" and engine.info("view").isEmpty() and engine.health() == {"status": "ok"}


def test_batch(engine):
    got = engine.batch_summary(["view", "NOPE"], NOW).orderBy("pos").collect()
    assert got[0]["tradeDate"] == "2024-01-30" and got[0]["fetchError"] is None and got[1]["fetchError"] == "No quote data"
    for bad in ([], ["A", " "], [None]):
        with pytest.raises(ValueError, match="symbols"):
            engine.batch_summary(bad, NOW)


def test_snapshots(engine):
    assert engine.capture_all(NOW) == [True, True] and engine.capture("all-combined", NOW + dt.timedelta(minutes=30))
    r = engine.latest_snapshot("all-combined").first()
    assert (r["id"], r["symbol_count"], [i["symbol"] for i in r["results"]]) == (3, 5, ["VIEW", "CLICK", "ZZZ", "ERROR", "VIEW"])
    assert [r["id"] for r in engine.list_snapshots().collect()] == [3, 2, 1] and engine.get_snapshot("2x").first()["type"] == "all-etfs"
    with pytest.raises(NotFound):
        engine.get_snapshot(9)


def test_single_flight():
    guard, inner = SingleFlight(), []
    assert guard.run(lambda: inner.append(guard.run(lambda: None))) and inner == [False] and guard.run(lambda: None)


def test_script(engine, spark, tmp_path):
    df = engine.ticker_summary_v2("2024-01-18", "view, nope", "# x\nclick")
    assert len(df.columns) == 39 and {r["ticker"] for r in df.collect()} == {"VIEW", "NOPE", "CLICK"}
    assert len(script.preview(df).columns) == 19
    script.write_outputs(df, str(tmp_path))
    lines = next((tmp_path / "csv").glob("*.txt")).read_text(encoding="utf-8").splitlines()  # Spark's reader drops the mark
    assert len(lines) == 4 and lines[0].startswith("﻿ticker,") and spark.read.json(str(tmp_path / "json")).count() == 3
    assert script.flatten_columns(spark.range(1).select(F.lit(1).alias("Open.AMD"))).columns == ["Open"]


def test_client_helpers(spark):
    df = spark.createDataFrame([("a b&c", "{}"), (None, "﻿"), ("é", "{x"), ("", "plain")], "v string, body string")
    got = df.select(x.query_parameter("q", "v"), x.body_kind("body")).collect()
    assert [tuple(r) for r in got] == [("q=a+b%26c", "json"), ("q=null", "empty"), ("q=%C3%A9", "text"), ("q=", "text")]
    assert "fetchError" in SUMMARY_COLUMNS
