"""Near-duplicate vectors against all pairs."""

import math
import random

import duckdb
import numpy as np
import pytest

from tests.compare import same
from tickforge.llm import oracles, vectors

KIND = "vec_id long, embedding array<{}>, _v string, _m long, label int"


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], KIND.format(kind)).repartition(5)


def world(seed, dim=24):
    rng = np.random.default_rng(seed)
    rows = [(int(k), list(map(float, v))) for k, v in enumerate(rng.standard_normal((150, dim)))]
    at = 1000
    for size, spread in ((120, 0.02), (60, 0.06), (40, 0.2), (12, 0.05), (5, 0.01)):  # groups, tight and wide
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append((at, list(map(float, (centre + spread * rng.standard_normal(dim)) * 10.0 ** rng.integers(-3, 3)))))
            at += int(rng.integers(1, 4))
    for k in range(30):  # pairs close to the threshold, on either side
        a = rng.standard_normal(dim)
        b = rng.standard_normal(dim)
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = 0.95 + (k - 15) * 0.0007
        rows += [(3000 + 2 * k, a.tolist()), (3001 + 2 * k, (c * a + math.sqrt(1 - c * c) * b).tolist())]
    rows += [(5000 + k, rows[3][1]) for k in range(70)]  # copies
    rows += [(None, rows[4][1]), (None, rows[3][1]), (7, rows[4][1]), (5000, rows[3][1])]
    rows += [(6000, None), (6001, []), (6002, [0.0] * dim), (6003, [None, *[1.0] * (dim - 1)]), (6004, [math.nan] * dim), (6005, [math.inf, *[1.0] * (dim - 1)]), (6006, [1.0]), (6007, [2.0]), (6008, [-1.0]), (6009, [1e200] * dim), (6010, [1e-200] * dim), (6010, None)]
    random.Random(seed).shuffle(rows)
    return rows


def brute(rows, least=0.95):
    good = [v is not None and len(v) > 0 and None not in v and all(map(math.isfinite, v)) and any(v) for _, v in rows]
    unit = [np.array(v) / max(map(abs, v)) / np.linalg.norm(np.array(v) / max(map(abs, v))) if g else None for g, (_, v) in zip(good, rows, strict=True)]
    near = [[j for j, y in enumerate(unit) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= least] for i, x in enumerate(unit)]
    out, key = [], lambda i: (rows[i][0] is not None, rows[i][0] or 0)
    for i, (name, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        first = rows[min(seen, key=key)][0]
        out.append((name, len(near[i]), first, name == first))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, monkeypatch, small):
    if small:  # many short keys and blocks
        monkeypatch.setattr(vectors, "MEET", 4)
        monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = world(3)
    got = vectors.near_vectors(frame(spark, rows))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows)))


def test_sql_agrees(spark, tmp_path):
    rows = [(i, v) for i, v in world(4) if v is None or len(v) == 0 or None in v or not (0 < max(map(abs, v)) < 1e-100 or 1e100 < max(map(abs, v)) < math.inf)]
    frame(spark, rows, "float").select("vec_id", "embedding").coalesce(1).write.parquet(f"{tmp_path}/e")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    same(vectors.near_vectors(spark.read.parquet(f"{tmp_path}/e")), con, oracles.OP12)


def test_empty_table(spark):
    assert vectors.near_vectors(frame(spark, [])).collect() == []
    assert [tuple(r) for r in vectors.near_vectors(frame(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("dim", [3, 64, 300])
def test_estimates_are_unbiased_and_bounded(dim):
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((400, dim))
    x[200:] = x[:200] + 0.4 * rng.standard_normal((200, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, factors = vectors.encode(x)
    got, dev = vectors.estimates(codes, factors, x)
    off = ~np.eye(400, dtype=bool)
    error = ((got - x @ x.T) / dev[:, None])[off]
    assert abs(error.mean()) < 0.1 and 0.3 < error.std() < 1.2 and np.abs(error).max() < vectors.DEVIATIONS


def test_plan_holds_its_chance():
    for n in (1, 300, 50_000, 10**9):
        k, tables = vectors.plan(n, 0.95)
        same_side = 1 - math.acos(0.95) / math.pi
        assert (1 - same_side**k) ** tables <= vectors.MISS < (1 - same_side**k) ** (tables - 1) and n / 2**k <= max(vectors.MEET, n / 2)
