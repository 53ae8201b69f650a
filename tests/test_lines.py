"""Numbered lines of text files in many splits, and what is read from them."""

import random

import pytest
from pyspark.sql import functions as F

from tickforge.operators import history as h
from tickforge.sources import lines, lists


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "16", "spark.sql.files.minPartitionNum": "40"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def text(seed=1, n=900):
    rng = random.Random(seed)
    names = ["aapl", " MSFT ", "BRK.B", '"Q"', "X-Y", "", "é", "T1", "Ticker,again", "#c"]
    out = ["before,x", "Tick", " Ticker,no"] + [rng.choice(names) + rng.choice(["", ",", ",Name \"a, b\"", ",a,b"]) for _ in range(40)]
    out = [o for o in out if not o.startswith("Ticker")] + ["Ticker,Name"] + [rng.choice(names) + rng.choice(["", ",", ",more", "\r"]) for _ in range(n)]
    return out


def test_lines_keep_their_order(spark, small_splits, tmp_path):
    all_lines = text()
    for k in range(3):
        (tmp_path / f"part-{k}").write_text("\n".join(all_lines[k * 300 : (k + 1) * 300]) + "\n", encoding="utf-8", newline="")
    (tmp_path / "part-3").write_text("\n".join(all_lines[900:]), encoding="utf-8", newline="")
    df = lines.numbered(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    got = sorted(map(tuple, df.collect()))
    assert got == [(k, line.removesuffix("\r")) for k, line in enumerate(all_lines)]


def test_universe_of_many_splits_is_that_of_one_text(spark, small_splits, tmp_path):
    f = tmp_path / "tickers.csv"
    f.write_text("\n".join(text(2)), encoding="utf-8", newline="")
    many = lines.universe(lines.numbered(spark, str(f)))
    one = lists.universe(lists.text_files(spark, str(f)))
    want = sorted((r["pos"], r["symbol"]) for r in one.collect())
    assert sorted(map(tuple, many.collect())) == want and len(want) > 200
    f.write_text("aapl,x\nmsft,y\n")
    assert lines.universe(lines.numbered(spark, str(f))).collect() == []
    f.write_text("")
    assert lines.numbered(spark, str(f)).collect() == []


def test_tickers_of_many_splits(spark, small_splits, tmp_path):
    f = tmp_path / "t.txt"
    f.write_text("\n".join(line.replace('"', "") for line in text(3)))
    got = sorted((r["at"].part, r["at"].line_no, r["at"].k, r["symbol"]) for r in lines.tickers(lines.numbered(spark, str(f)), "zzz, aapl").collect())
    want = sorted((r["at"].part, r["at"].line_no, r["at"].k, r["symbol"]) for r in lists.ticker_arguments("zzz, aapl", f.read_text(), spark).collect())
    assert got == want


def test_requests_of_any_kind(spark):
    bodies = ['{"symbols": ["a", "b"], "date": null}', '{"symbols": []}', "{}", "no", None, '{"symbols": [" "]}', '{"symbols": ["x", null]}', '{"symbols": "x"}']
    got = lists.requests(spark.createDataFrame(list(enumerate(bodies)), "id int, text string")).orderBy("id", "pos").collect()
    assert [tuple(r) for r in got] == [(0, 0, "a", None), (0, 1, "b", None)] + [(k, None, None, lists.BAD_REQUEST) for k in range(1, 8)]


def test_categories_of_many_texts(spark):
    rows = [(3, '"A": [x, "one"]'), (7, "'B': ['b1'], 'A ': ['late', TWO]"), (9, '"C": []'), (10, None)]
    got = lists.categories(spark.createDataFrame(rows, "id int, text string")).orderBy("cat_pos", "sym_pos").collect()
    assert [tuple(r) for r in got] == [(3 << 32, "A", 0, "LATE"), (3 << 32, "A", 1, "TWO"), (7 << 32, "B", 0, "B1")]


def test_parameters(spark):
    df = spark.createDataFrame([("1d", "1h"), ("max", "1h"), ("max", "9m"), ("5d", "1m"), (None, "1m"), ("max", None)], "p string, i string")
    assert [r[0] for r in df.select(h.lookback(F.col("p"), F.col("i"))).collect()] == [1, 730, None, None, None, None]
