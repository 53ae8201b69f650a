"""The snapshots' store: appends at once and again, reading one of many, items of any fields."""

import datetime as dt
import json
import multiprocessing
import threading

import pytest
from pyspark.sql import functions as F

from tickforge.operators import ledger
from tickforge.schemas import SUMMARY

T0 = dt.datetime(2024, 1, 10, 20, 0, tzinfo=dt.UTC)


def at(minutes=0):
    return F.lit(T0 + dt.timedelta(minutes=minutes)).cast("timestamp")


def items(spark, *symbols, **more):
    df = spark.createDataFrame([(k, s, *([None] * 21)) for k, s in enumerate(symbols)], f"pos int, {SUMMARY}").withColumn("dayClose", F.col("pos") + 0.5)
    return df.withColumns({k: F.lit(v) for k, v in more.items()}).repartition(3)


def publish(job):
    folder, k = job
    return [n for n in range(60) if ledger.publish_local(folder, f"{n:020d}.json", f"{k} " * 1000)]


def test_a_number_is_taken_once_by_all_processes(tmp_path):
    with multiprocessing.get_context("spawn").Pool(4) as pool:
        taken = pool.map(publish, [(str(tmp_path), k) for k in range(4)])
    assert sorted(n for t in taken for n in t) == list(range(60)) and len(list(tmp_path.iterdir())) == 60
    for k, t in enumerate(taken):
        assert all((tmp_path / f"{n:020d}.json").read_text() == f"{k} " * 1000 for n in t)


@pytest.mark.parametrize("rename", [False, True])
def test_appends_at_once_and_again(spark, tmp_path, rename):
    """Writers that know nothing of each other, two of which append the same batch."""
    ids, lock = [], threading.Lock()

    def write(k):
        s = ledger.SnapshotStore(spark, str(tmp_path / "s"))
        s.local = s.local and not rename
        if rename:  # a local rename may replace what came meanwhile: one at a time
            lock.acquire()
        try:
            ids.append((k % 3, s.append(items(spark, "A", "B", "A"), "all-stocks", at(k), f"batch{k % 3}")))
        finally:
            if rename:
                lock.release()

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(200)
    s = ledger.SnapshotStore(spark, str(tmp_path / "s"))
    assert len(ids) == 6 and len(set(ids)) == 3 and sorted(i for _, i in set(ids)) == [1, 2, 3]
    assert sorted(r["id"] for r in s.log().collect()) == [1, 2, 3] and s.items().count() == 9
    assert s.append(items(spark, "Z"), "all-stocks", at(99), "batch1") in (1, 2, 3) and s.items().count() == 9
    assert s.append(items(spark, "Z"), "all-etfs", at(99), "batch1") == 4  # batches are told apart by type


def test_what_fails_leaves_nothing(spark, tmp_path):
    s = ledger.SnapshotStore(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)no such thing"):
        s.append(items(spark, "A").withColumn("dayClose", F.raise_error(F.lit("no such thing"))), "all-etfs", at())
    assert s.log().count() == 0 and s.items().count() == 0 and s.latest("all-etfs").isEmpty() and s.by_id(1).isEmpty()
    (tmp_path / "items" / "part-0123").mkdir(parents=True)  # what a process that died has left
    assert s.append(items(spark, "A"), "all-etfs", at()) == 1 and s.items().count() == 1
    assert s.sweep() == 0 and s.sweep(0) == 1 and s.items().count() == 1
    with pytest.raises(ValueError, match="type"):
        s.append(items(spark, "A"), "stocks", at())


def opened(df):
    return {f.rsplit("/", 2)[1] for f in df.inputFiles()}


def test_one_of_many_opens_its_own_files(spark, tmp_path):
    s = ledger.SnapshotStore(spark, str(tmp_path))
    for k in range(6):
        assert s.append(items(spark, f"S{k}", "X"), ("all-stocks", "all-etfs")[k % 2], at([0, 10, 30, 5, 20, 10][k])) == k + 1
    part = {r["id"]: r["part"].split("/")[1] for r in s.log().collect()}
    assert opened(s.by_id(4)) == {part[4]} and [tuple(r) for r in ledger.summaries(s.by_id(4)).select("id", "pos", "symbol", "dayClose").orderBy("pos").collect()] == [(4, 0, "S3", 0.5), (4, 1, "X", 1.5)]
    assert opened(s.latest("all-stocks")) == {part[3]} and opened(s.latest("all-etfs")) == {part[6]}  # as new as 2, but later
    assert len(s.entry(5).inputFiles()) == 1 and s.by_id(7).isEmpty() and s.by_id(-1).isEmpty()
    want = [(3, 30), (5, 20), (6, 10), (2, 10), (4, 5), (1, 0)]
    for first in (True, False):
        assert [(r["id"], r["fetched_at"]) for r in s.listing().collect()] == [(i, (T0 + dt.timedelta(minutes=m)).replace(tzinfo=None)) for i, m in want]
        assert [r["id"] for r in s.listing("all-etfs", 2).collect()] == [6, 2]
        assert s.compact(6) is first
    assert s.append(items(spark, "N"), "all-stocks", at(60)) == 7
    assert [r["id"] for r in s.listing().collect()][0] == 7 and s.log().count() == 7 and opened(s.latest("all-stocks")) not in ({part[3]}, set())
    assert s.append(items(spark, "N"), "all-stocks", at(60), s.log().filter("id = 2").first()["batch"]) == 8


def test_items_of_any_fields(spark, tmp_path):
    s = ledger.SnapshotStore(spark, str(tmp_path))
    s.append(items(spark, "A", 'B"\n', beta=1.25, tags="x"), "all-stocks", at())
    s.append(items(spark, "C").drop("dayOpen").withColumn("dayClose", F.lit("n/a")), "all-stocks", at(1))
    one = json.loads(ledger.document(s.entry(1), s.by_id(1)).first()["body"])
    assert [(i["symbol"], i["beta"], i["tags"], i["dayClose"]) for i in one["results"]] == [("A", 1.25, "x", 0.5), ('B"\n', 1.25, "x", 1.5)]
    assert (one["id"], one["type"], one["tradeDate"], one["fetchedAt"], one["symbolCount"]) == (1, "all-stocks", "2024-01-10", "2024-01-10T20:00:00.000Z", 2)
    two = ledger.row(s.entry(2), s.by_id(2)).first()
    assert two["symbol_count"] == 1 and (two["results"][0]["symbol"], two["results"][0]["dayClose"], two["results"][0]["dayOpen"]) == ("C", None, None)
    assert "beta: D" in ledger.fields(s.items()).first()["fields"] and s.items().select(F.try_variant_get("item", "$.beta", "double").alias("b")).filter("b = 1.25").count() == 2
    assert ledger.row(s.entry(9), s.by_id(9)).isEmpty() and s.append(items(spark), "all-etfs", at()) == 3
    assert ledger.row(s.entry(3), s.by_id(3)).first()["results"] == [] and json.loads(ledger.document(s.entry(3), s.by_id(3)).first()["body"])["results"] == []
