"""Ranked search against plain sums over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import awkward, table
from tickforge.llm import ranked
from tickforge.llm.common import FOLD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(1 for _, c in counted if c), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for name, text in items:
        scores = []
        for i, c in counted:
            s = 0
            for t in set(terms(text)):
                if c[t]:
                    m = 100 - 50 + (50 * c.total() * n_docs) // length
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(name, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return out


def world(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdeé") + rng.choice(["x", "1", "ß", ""])
    docs = awkward() + [(rng.randrange(500) if rng.random() < 0.97 else None, rng.choice([" ", ", ", "_"]).join(word() for _ in range(rng.randint(0, 25)))) for _ in range(300)]
    docs += [(i, "A1 bß same copy") for i in rng.sample(range(600, 900), 120)]  # ties
    items = [(k, " ".join(word() for _ in range(rng.randint(0, 9)))) for k in range(25)] + [(3, "same COPY same"), (None, "copy a1"), (90, None), (91, "-- \x7f"), (92, "nowhere"), (93, docs[4][1])]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # all terms joined, items in blocks, few entries at once
        for name, v in (("TERMS", 3), ("PAIRS", 30), ("ENTRIES", 50)):
            monkeypatch.setattr(ranked, name, v)
    docs, items = world(7)
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, _q string, _terms int").repartition(3)
    for k in (7, 50):
        got = ranked.search(table(spark, docs), asked, k)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(docs, items, k)))


def test_ids_of_other_types_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q1", "X?"), ("q2", "w")], "item_id string, text string")
    got = [tuple(r)[:3] for r in ranked.search(docs, items).orderBy("rank").collect()]
    assert got == [("q1", 1, None), ("q1", 2, "a"), ("q1", 3, "b")]
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("doc_id = 'z'"), items.filter("item_id = 'z'"))):
        assert ranked.search(d, i).collect() == []


def test_terms_of_long_texts(monkeypatch):
    text = "Été ÉTÉ a-b A_B x\x00y 9９ " * 500
    want = Counter(t.encode() for t in terms(text))
    assert ranked.term_counts(text) == want and ranked.term_counts(None) == ranked.term_counts(" .,") == Counter()
    for chunk in (1, 7, 100):
        monkeypatch.setattr(ranked, "CHUNK", chunk)
        assert ranked.term_counts(text) == want


def test_sorted_sums():
    rng = np.random.default_rng(1)
    for n_docs, n_items in ((1, 1), (3, 70_000), (70_000, 5), (100_000, 100_000)):
        items, docs, impacts = rng.integers(0, n_items, 5000), rng.integers(0, min(n_docs, 40), 5000), rng.integers(0, 9, 5000)
        q, d, s = ranked.accumulate(items, docs, impacts, n_docs, n_items)
        want = Counter()
        for a, b, c in zip(items.tolist(), docs.tolist(), impacts.tolist(), strict=True):
            want[a, b] += c
        assert list(zip(q.tolist(), d.tolist(), strict=True)) == sorted(want) and s.tolist() == [want[x] for x in sorted(want)]
