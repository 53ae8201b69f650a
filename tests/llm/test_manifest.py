"""The Merkle manifest against hash trees built in plain Python."""

import hashlib
import random
import zlib

import pytest

from tests.llm.helpers import awkward, table
from tickforge.llm import manifest, registry

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout=3):
    """The root, and of each node what stands left and right of its path."""
    proofs, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(k, min(k + fanout, len(nodes))) for k in range(0, len(nodes), fanout)]
        for run in runs:
            for j in run:
                for i in under[j]:
                    proofs[i].append(("".join(nodes[x] for x in run if x < j), "".join(nodes[x] for x in run if x > j)))
        nodes, under = [H(*(nodes[j] for j in run)) for run in runs], [[i for j in run for i in under[j]] for run in runs]
    return nodes[0], proofs


def brute(rows, fanout=3):
    """(id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    trees = [tree([leaf(r) for r in g], fanout) for g in groups]
    root, over = tree([t[0] for t in trees], fanout) if trees else (None, [])
    return [(r[0], leaf(r), t[0], root, p + o) for g, t, o in zip(groups, trees, over, strict=True) for r, p in zip(g, t[1], strict=True)]


def as_read(df):
    return sorted(str((r[0], r[1], r[2], r[3], [tuple(x) for x in r[4]])) for r in df.collect())


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_against_plain_trees(spark, fanout):
    rng = random.Random(fanout)
    rows = [(rng.randrange(400) if rng.random() < 0.95 else None, rng.choice([None, "", "a", "é", "z", "\U0001f600", "￿", "hot", "hot", "hot"]), rng.choice(["en", None]), rng.randrange(9), rng.choice(["x\ny", "", None, "z" * 50_000, "9:x"])) for _ in range(300)]
    rows += rows[:20]  # repeated rows
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert as_read(manifest.manifest(df, FIELDS, fanout=fanout)) == sorted(map(str, brute(rows, fanout)))


def test_awkward_rows(spark):
    rows = [(i, "s", "en", len(t or ""), t) for i, t in awkward()]
    assert as_read(manifest.manifest(table(spark, awkward()), FIELDS)) == sorted(map(str, brute(rows)))
    assert manifest.manifest(table(spark, []), FIELDS).collect() == []
    one = manifest.manifest(table(spark, [(1, "x")]), FIELDS).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof"] == []


def test_tampering_shows(spark, tmp_path):
    rows = [(i, f"s{i % 4 if i and i % 3 else 0}", "en", 3, t) for i, t in [*awkward(), *((k, f"a\nb {k}") for k in range(20, 60))]]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.op13_merkle_manifest(spark, str(tmp_path)).collect()
    want = []
    for (i, h, sub, root, proof), r in zip(brute(rows), sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or 0, leaf(r))), strict=True):
        changed = r[4].replace("\n", "") if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4]
        folded = leaf((*r[:4], changed))
        for left, right in proof:
            folded = H(left, folded, right)
        assert (folded == root) == (changed == r[4])
        want.append((i, h, sub, root, H(*(a + b for a, b in proof)), folded, folded == root))
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want)) and {r["verified"] for r in got} == {True, False}
