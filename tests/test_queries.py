"""Every market-bar query against its SQL on the smallest tables."""

import pytest

from tests.compare import connect, same
from tickforge.plans.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    same(QUERIES[name](spark, FOLDER), con, ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["sort_nulls_last_desc", "sort_nulls_last_asc"])
def test_sorts_give_all_items(spark, name):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, folder).collect()
    sign = -1 if name.endswith("desc") else 1
    assert len(rows) == QUERIES["batch_summary_missing"](spark, folder).count() == 150
    assert rows == sorted(rows, key=lambda r: (r["vsPreClosePct"] is None, sign * (r["vsPreClosePct"] or 0), r["pos"]))


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and df.columns == ["symbol", "vwapDate", "regularBarCount", "intradayVwapLast", "pctRegularMinutesAboveVwap"]
    assert set(ORACLE_SQL) <= set(e.oracle_sql()) and set(QUERIES) <= set(e.queries())
