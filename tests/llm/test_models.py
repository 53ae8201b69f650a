"""Packing, decontamination, toxicity, repeats, near-duplicates, the language model and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import awkward, prose, table
from tickforge.llm import decontamination as dc
from tickforge.llm import graph, lm, near, packing, registry, repeats, tokens, toxicity
from tickforge.llm.common import FOLD, FOLD_BYTES, WORD, WORD_BYTES, Scratch, slices
from tickforge.llm.graph import components
from tickforge.llm.hashing import Key, blocks, shingle_sets, spans, windows, word_hashes

FOLDER = "/root/testdata/sf0.001"
PATH = registry.tokenizer_path()


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_encoder_equals_tokenizer(spark):
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(PATH), tokens.encoder(PATH)
    for text in [x or "" for _, x in documents(spark)[:60] + awkward()] + ["it's WE'VE 3.14 <|endoftext|>x", "İΣΑΣ ÅÅ a b　c", "don't! the?! ÀÉ., a\x85b"]:
        assert np.frombuffer(e.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_cache_of_words_may_overflow(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    a, b = tokens.encoder(PATH), tokens.encoder(PATH)
    text = "the quick brown Fox jumps, over the lazy dog. The end!"
    assert a.encode(text + " " + text) == b.encode(text) + b.encode(text)


@pytest.mark.parametrize("seed", [0, 1])
def test_plan_places_everything_well(seed):
    rng = np.random.default_rng(seed)
    n = np.clip(rng.lognormal(5 + seed, 1.2, 4000).astype(int), 1, 4096)
    p = packing.plan(dict(zip(*(x.tolist() for x in np.unique(n, return_counts=True)), strict=True)))
    placed = Counter()
    for m, inside in p:
        assert sum(k * a for k, a in inside) <= 4096
        for k, a in inside:
            placed[k] += a * m
    assert placed == Counter(n.tolist()) and sum(m for m, _ in p) <= math.ceil(n.sum() / 4096) * 1.01 + 1
    assert packing.plan({}) == [] and packing.plan({4096: 3, 1: 2}) and packing.plan({7: 3}, capacity=10)


def test_linear_program_is_solved_to_its_gap():
    rng = np.random.default_rng(20)
    for capacity, n in ((10, rng.integers(1, 11, 500)), (100, rng.integers(20, 70, 3000)), (4096, np.clip(rng.lognormal(6, 1.2, 4000).astype(int), 1, 4096))):
        sizes, demand = packing.length_groups(np.bincount(n, minlength=capacity + 1), 40)
        assert demand.sum() == len(n) and (np.diff(sizes) > 0).all() and sizes[-1] == n.max()
        got = packing.solve(sizes, demand, capacity)
        use = np.array(list(got.uses.values()))
        configs = np.array(list(got.uses))
        assert (configs @ sizes <= capacity).all() and (use @ configs >= demand * (1 - 1e-9)).all()  # feasible
        assert math.isclose(use.sum(), got.value) and got.bound <= got.value <= got.bound * (1 + packing.GAP) + 1e-9
        assert got.bound >= demand @ sizes / capacity * (1 - 1e-9)  # at least the bound of the volume
    assert packing.solve(*packing.length_groups(np.zeros(5, int)), 4).uses == {}


def test_prices_are_exact():
    rng = np.random.default_rng(21)
    for _ in range(30):
        sizes = np.unique(rng.integers(2, 30, 5))
        value = rng.random(len(sizes))
        a = packing.price(value, sizes, 40)
        best = [0.0] * 41
        for c in range(1, 41):
            best[c] = max([best[c - 1], *(best[c - s] + v for s, v in zip(sizes.tolist(), value, strict=True) if s <= c)])
        assert a @ sizes <= 40 and math.isclose(a @ value, best[40])


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_plan_needs_no_more_than_best_fit(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    lengths = {r["length"]: r["count"] for r in packing.cut(docs, PATH).groupBy("length").count().collect()}
    rooms: list[int] = []
    for n in sorted((n for n, k in lengths.items() for _ in range(k)), reverse=True):  # best fit, item by item
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 4096) - n)
    assert sum(m for m, _ in packing.plan(lengths)) <= len(rooms)


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SALT", 3)
    docs = table(spark, awkward() + [(1000 + i, t) for i, t in documents(spark)[:80]])
    got = packing.pack_documents(docs, PATH, with_ids=True).collect()
    by_row = Counter()
    for r in got:
        by_row[r["doc_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["start"] == 4096 * r["piece"] and len(r["ids"]) == r["length"]
    assert by_row[1] == by_row[2] == 1
    filled: dict = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    whole = packing.sequences(packing.pack_documents(table(spark, [(1, "a b"), (2, None)]), PATH, with_ids=True)).collect()
    assert len(whole) == 1 and len(whole[0]["ids"]) == 4 and whole[0]["ids"].count(1) == 2
    assert packing.pack_documents(table(spark, []), PATH).count() == 0


def test_decontamination(spark):
    rng = random.Random(2)
    item = "A farmer has 12 apples and Mary gives him 30 kg more so how many apples has the farmer now in 2 days"
    other = item.replace("12", "45").replace("30", "7").replace("Mary", "John")
    mixed = "A farmer has 12 apples and 12 pears with 12 plums in 12 baskets near 12 trees of 12 kinds and 12 sheds"
    broken = "A farmer has 1 apples and 2 pears with 3 plums in 4 baskets near 5 trees of 6 kinds and 7 sheds"
    text = prose(rng, 60)
    docs = [*awkward(), (20, f"{text} {item} {text}"), (21, f"{text}\n{other}\n{text}"), (22, text), (23, broken), (24, " ".join(item.split()[:8]) + " " + text)]
    bench = spark.createDataFrame([(1, item, "x"), (2, mixed, "y"), (3, None, "z"), (4, "too short", "w"), (1, item, "x")], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r for r in dc.find_leaks(table(spark, docs), bench).collect()}
    assert set(got) == {(20, 1), (21, 1)} and got[20, 1]["n_changed"] == 0 and got[21, 1]["n_changed"] == 3
    assert {r["doc_id"] for r in dc.find_leaks(table(spark, docs), bench, items=1).collect()} == {20, 21}
    left = dc.drop_leaking(table(spark, docs), bench)
    assert left.count() == len(docs) - 2 and left.columns == table(spark, []).columns
    assert dc.find_leaks(table(spark, []), bench).count() == 0 and dc.find_leaks(table(spark, docs), bench.limit(0)).count() == 0


def test_items_with_ids_of_other_types(spark):
    text = "Every winter the old harbour freezes over and nine boats wait until the ice breaks in early spring."
    bench = spark.createDataFrame([("q1", text), ("", text + " Then they leave."), (None, "the quick brown fox jumps over a very lazy dog today")], "item_id string, text string")
    docs = table(spark, [(1, "So. " + text + " Then they leave. Yes."), (2, "something else"), (3, "Look: the quick brown fox jumps over a very lazy dog today.")])
    assert sorted((r["doc_id"], r["item_id"] or "", r["n_changed"]) for r in dc.find_leaks(docs, bench).collect()) == [(1, "", 0), (1, "q1", 0), (3, "", 0)]


def test_names_that_begin_sentences(spark):
    rng = random.Random(15)
    item = "Tom has 12 apples. Tom buys 5 more. How many apples does Tom have?"
    swapped = item.replace("Tom", "Bob").replace("12", "31").replace("5", "8")
    uneven = "Bob has 12 apples. Jim buys 5 more. How many apples does Ann have?"  # three names for one
    numbers = "Anna 1 2 3 4 5 6 7 8 9 Berta. Carl. Dora. Emil. Fritz. Gustav. Hans. Ida. Jan. Karl. 10 11 12 13 14 15 16"
    text = prose(rng, 40)
    docs = [(1, f"{text} {swapped} {text}"), (2, f"{text} {uneven} {text}"), (3, text), (4, f"{text} {item.lower()}"), (5, f"{text} {numbers}"), (6, f"{text} {numbers.replace('Dora', 'Nora')}"), (7, "Yes. " * 5000)]
    bench = spark.createDataFrame([(1, item), (2, numbers), (3, "One 1 2 3 4 Two. 5 6 7 8 Three. 9")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_found"], r["n_changed"]) for r in dc.find_leaks(table(spark, docs), bench).collect()}
    assert got[1, 1] == (7, 7, 3) and got[2, 1] == (7, 4, 1) and not [k for k in got if k[0] in (3, 7)]
    assert {k for k in got if k[1] == 2} == {(5, 2), (6, 2)} and got[5, 2][2] == 0 and got[6, 2][2] == 1
    h, both, *_ = dc._Tokens().hashes("Yes. No. I am Tom. Ok then")
    p, g = (np.concatenate(x) for x in zip(*dc.readings(h, both, 4), strict=True))
    assert Counter(p.tolist()) == {0: 4, 1: 2, 2: 2, 3: 2} and len(set(g.tolist())) == len(g)


def test_decoys_and_one_to_one(spark):
    rng = random.Random(40)
    item = "Mary buys 3 kg of rice at 2 dollars per kg. Mary pays with 20 dollars. How much change does Mary get?"
    other = item.replace("Mary", "O'Neill").replace("3 kg", "7 lb").replace("2 dollars", "4 euros").replace("20 dollars", "50 euros")
    decoy = "Anna buys 9 kg of rice at 8 dollars per kg."
    text = prose(rng, 40)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = [(1, f"{text} {other}"), (2, f"{decoy} {other}"), (3, f"{other} {decoy}"), (4, item), (5, f"{text} McKenna {other.replace(chr(39), '')}"), (6, text), (7, other.replace("O'Neill pays", "McKenna pays").replace("does O'Neill", "does USA"))]
    got = {r["doc_id"]: (r["n_windows"], r["n_found"], r["n_changed"]) for r in dc.find_leaks(table(spark, docs), bench).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 7} and got[4] == (15, 15, 0) and got[7][1] < 15  # 7 has three names for one
    assert got[1] == got[2] == got[3] == got[5] == (15, 15, 6)
    ok, slots = dc._agreed([(0, [(("<number>", "1"), "5"), (("<number>", "2"), "5")]), (1, [(("<number>", "1"), "5")])], {})
    assert ok == {1} and slots == {("<number>", "1"): "5"}  # one value isn't two


def test_items_of_few_words(spark):
    bench = spark.createDataFrame([(1, "Define photosynthesis briefly."), (2, "Why?"), (3, ""), (4, " \n"), (5, None)], "item_id long, text string")
    docs = [(1, "It grows. Define photosynthesis briefly. And so on"), (2, "They define photosynthesis briefly here."), (3, "a\nDefine photosynthesis briefly\nb"), (4, "Define photosynthesis slowly."), (5, "why not?"), (6, "Why?"), (7, "Why")]
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(table(spark, docs), bench).collect()}
    assert got == {(1, 1), (3, 1), (6, 2), (7, 2)}


def test_reparameterised_questions_are_found(spark):
    """Templates with names, numbers and units, other values in each copy, within long documents; clean documents of the same words stay."""
    rng = random.Random(41)
    vocabulary = [w.strip(".").lower() for w in prose(rng, 400).split()]
    names, units = ["Tom", "Mary", "McKenna", "O'Brien", "Anne-Marie", "NATO", "Li"], ["kg", "miles", "hours", "dollars", "cm"]

    def made(shape, values):
        return " ".join(values.get(x, x) for x in shape)

    def values():
        some = rng.sample(names, 3)
        return {f"N{k}": some[k] for k in range(3)} | {f"V{k}": str(v) for k, v in enumerate(rng.sample(range(2, 999), 4))} | {f"U{k}": u for k, u in enumerate(rng.sample(units, 2))}

    shapes = []
    for _ in range(40):
        shape: list[str] = []
        for k in range(rng.randint(2, 4)):
            body = [rng.choice(vocabulary) for _ in range(rng.randint(5, 9))]
            body[rng.randrange(len(body))] = f"V{rng.randrange(4)}"
            at = rng.randrange(1, len(body))
            body[at:at] = [f"V{rng.randrange(4)}", f"U{rng.randrange(2)}"]
            shape += [rng.choice([f"N{rng.randrange(3)}", rng.choice(vocabulary).capitalize()]), *body[:-1], body[-1] + "."]
        shapes.append(shape)
    bench = spark.createDataFrame([(k, made(s, values())) for k, s in enumerate(shapes)], "item_id long, text string")
    docs = [(k, f"{prose(rng, 80)} {made(s, values())} {prose(rng, 80)}") for k, s in enumerate(shapes)]
    docs += [(100 + k, " ".join(rng.choice(vocabulary) for _ in range(200))) for k in range(60)]
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(table(spark, docs), bench).collect()}
    assert got <= {(k, k) for k in range(40)} and len(got) >= 0.9 * 40


def test_windows_against_brute_force():
    """All places where a window of an item stands, from templates of every reading."""
    rng = random.Random(42)
    words = ["red", "sky", "Tom", "Ann", "12", "7.", "kg", "runs", "Sees.", "and", "Oslo.", "min"]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(4, 14)))) for k in range(60)]
    index, tokens = dc.Benchmark(items), dc._Tokens()

    def ways(text):
        """Sets of hashes' stand-ins that each token may be."""
        out, was = [], 8
        for w in WORD.findall(text):
            low, flags = dc._kind(w)
            one = {dc.NUMBER} if flags & 1 else {dc.UNIT} if flags & 2 and was & 1 else {dc.NAME, low} if flags & 4 and was & 8 else {dc.NAME} if flags & 4 else {low}
            out.append((one, one | ({low} if not flags & 1 else set()) | ({dc.NAME} if flags & 4 and not flags & 1 else set())))
            was = flags
        return out

    for _ in range(40):
        text = " ".join(rng.choice(words) for _ in range(60))
        doc, found = ways(text), index.hits(*tokens.hashes("Tom runs", text, "", "kg and"))[1]
        for key, (item, theirs, n) in index.templates.items():
            if n != dc.WINDOW:
                continue
            mine = ways(dict(items)[item])
            literal = [x[0] == x[1] for x in theirs]
            want = {(i, q) for q in range(len(theirs) - n + 1) if sum(literal[q : q + n]) >= dc.LITERALS for i in range(len(doc) - n + 1) if all((doc[i + k][k == 0] & mine[q + k][0]) for k in range(n))}
            assert found.get(key, set()) == want


def test_short_items_after_any_words(spark):
    items = ["What is the capital of France", "in which year did it end", "Min and max are what here", "which of these is it"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    before = ["", "Question 12\n", "so 12 ", "the Question ", "and then ", "It ended. "]
    docs = [(10 * k + j, f"{b}{x} and so on") for k, x in enumerate(items) for j, b in enumerate(before)]
    docs += [(90, "What is the capital city of France"), (91, "12 which year did it end"), (92, "Question 12")]
    got = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in dc.find_leaks(table(spark, docs), bench).collect()}
    assert got == {(10 * k + j, k): 0 for k in range(len(items)) for j in range(len(before))}


def test_decontamination_finds_all_whole_items(spark):
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in registry.QUERIES["op3_decontamination"](spark, FOLDER).collect()}
    assert {(d, i) for d, t in documents(spark) for i, x in bench.items() if x in t} <= found
    for d, i in found:  # nothing without a shared run of eight words
        w, t = bench[i].lower().split(), " ".join(dict(documents(spark))[d].lower().split())
        assert any(" ".join(w[k : k + 6]) in t for k in range(max(1, len(w) - 5)))


def test_block_max_is_exact():
    rng = np.random.default_rng(3)
    x = np.where(rng.random((300, 40)) < 0.2, rng.random((300, 40)), 0)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    ix = toxicity.Index(b"", np.ones(40), list(range(300)), np.zeros(300), np.ones(300))
    e, f = np.nonzero(x)
    ix.build(f, e, x[e, f])
    for _ in range(40):
        f = np.sort(rng.choice(40, 6, replace=False))
        w = rng.random(6)
        s = x[:, f] @ w
        want = [i for i in np.lexsort((np.arange(300), -s)) if s[i] > 0][:25]
        got, cosine = ix.nearest(f, w, 25)
        assert np.allclose(cosine, s[want]) and np.allclose(s[got], s[want])


def test_toxicity_against_brute_force(spark):
    """Every score and all evidence of the query, from dense vectors of all words of the examples."""
    docs, bits = documents(spark), {}
    for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect():
        bits[r["doc_id"]] = max(r["toxic"], bits.get(r["doc_id"], 0))
    assert len({i for i, _ in docs}) == len(docs)
    bags = {i: Counter(x for x in map(toxicity.fold, WORD.findall(t or "")) if x) for i, t in docs}
    known = [i for i in bits if zlib.crc32(str(i).encode()) % 5]
    ids = [i for i in known if i in bags]
    names = sorted({w for i in ids for w in bags[i]})
    at = {w: k for k, w in enumerate(names)}
    df = np.array([sum(w in b for b in bags.values()) for w in names])
    y = np.array([bits[i] for i in ids], float)
    has = np.array([[w in bags[i] for w in names] for i in ids])
    n, a, b = len(ids), has[y == 1].sum(0), has[y == 0].sum(0)
    n1, n0 = y.sum(), (1 - y).sum()
    g = np.zeros(len(names))
    for seen, size in ((a, n1), (b, n0)):
        for x, of in ((seen, a + b), (size - seen, n - a - b)):
            g += 2 * np.array([p * math.log(p * n / (o * size)) if p else 0.0 for p, o in zip(x.tolist(), of.tolist(), strict=True)])
    weight = (np.log((1 + len(docs)) / (1 + df)) + 1) * (np.maximum(g, 0) + toxicity.FLOOR)

    def vector(bag):
        v = np.zeros(len(names))
        for w, c in bag.items():
            if w in at:
                v[at[w]] = (1 + math.log(c)) * weight[at[w]]
        return v / (np.linalg.norm(v) or 1)

    x, share = np.stack([vector(bags[i]) for i in ids]), np.where(y == 1, sum(bits[i] for i in known) / n1, sum(1 - bits[i] for i in known) / n0) * n / len(known)
    base = sum(bits[i] for i in known) / len(known)

    def judged(v, skip=None):
        s = x @ v
        if skip is not None:
            s[skip] = 0
        near = [k for k in np.argsort(-s, kind="stable") if s[k] > 1e-15][: toxicity.NEIGHBOURS]
        c = s[near] ** 2 * share[near]
        return ((c * y[near]).sum() + 0.05 * base) / (c.sum() + 0.05), s[near[:3]]

    votes = np.array([judged(x[k], k)[0] for k in range(n)])
    # least squares under order, by the largest mean over starts of the smallest over ends
    level = np.unique(votes.round(9))
    w, z = (np.array([(share * q)[votes.round(9) == v].sum() for v in level]) for q in (1, y))
    fitted = np.array([max(min(z[i : j + 1].sum() / w[i : j + 1].sum() for j in range(k, len(level))) for i in range(k + 1)) for k in range(len(level))])
    for r in registry.QUERIES["op5_toxicity"](spark, FOLDER).collect():
        vote, cosines = judged(vector(bags[r["doc_id"]]))
        assert np.allclose([e["cosine"] for e in r["evidence"]], cosines) and (r["evidence"] or not set(bags[r["doc_id"]]) & set(names))
        assert math.isclose(r["score"], np.interp(vote, level, fitted), abs_tol=1e-6) and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_toxicity_of_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in registry.QUERIES["op5_toxicity"](spark, folder).filter("held_out").collect() if labels.get(r["doc_id"]) is not None]
    hit, said, true = sum(p and y for _, p, y in got), sum(p for _, p, _ in got), sum(y for *_, y in got)
    assert hit / said >= 0.95 and hit / true >= 0.85
    pos, neg = [s for s, _, y in got if y], [s for s, _, y in got if not y]
    assert sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg) >= 0.97


def test_toxicity(spark):
    rng = random.Random(4)
    rows = [(k, prose(rng, 60) + (" You grumbok zaffer!" if k % 4 == 0 else "")) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0), 1, "x") for k in range(400)] + [(None, 1, 1, "x"), (5, None, 1, "x"), (9999, 1, 1, "x")], "doc_id long, toxic int, quality int, text string")
    docs = table(spark, rows + awkward())
    ix = toxicity.fit(docs, labels, per_class=150)
    assert len(ix.ids) <= 300 and all(zlib.crc32(str(i).encode()) % 5 for i in ix.ids)
    got = toxicity.score(table(spark, rows), ix).collect()
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) and 0 <= r["score"] <= 1 for r in got) and got[0]["evidence"] is not None
    odd = toxicity.score(table(spark, awkward()), ix).collect()
    assert len(odd) == len(awkward()) and all(0 <= r["score"] <= 1 for r in odd)
    left = toxicity.reject_toxic(table(spark, rows), ix)
    assert {r["doc_id"] for r in left.collect()} == {k for k in range(400) if k % 4} and left.columns == docs.columns
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, none).filter("predicted = 0").count() == docs.count() and toxicity.score(docs.limit(0), none).count() == 0


def brute_repeats(rows, n, first):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen: dict = {}
    for d, (_, x) in sorted(enumerate(data), key=lambda r: r[1][0]):
        for p in range(len(x) - n + 1):
            seen.setdefault(x[p : p + n], []).append((d, p))
    out = []
    for d, (i, x) in enumerate(data):
        gone = bytearray(len(x))
        for p in range(len(x) - n + 1):
            s = seen[x[p : p + n]]
            if len(s) > 1 and not (first and s[0] == (d, p)):
                gone[p : p + n] = b"\1" * n
        out.append((i, bytes(c for c, g in zip(x, gone, strict=True) if not g), sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))))
    return out


@pytest.mark.parametrize(("first", "group"), [(False, 6000), (True, 6000), (False, 1), (True, 1)])
def test_repeats_against_brute_force(spark, first, group):
    rng = random.Random(7)
    parts = [prose(rng, rng.randint(5, 25)) for _ in range(12)] + ["ab" * 40, "z" * 130]
    rows = [(k, "".join(rng.choice(parts)[rng.randint(0, 9) :] for _ in range(rng.randint(0, 5)))) for k in range(80)] + [(90, "é" * 100), (91, "aé" * 90), (92, ""), (93, None)]
    got = repeats.remove_repeats(table(spark, rows), 50, 12, first, group=group).collect()
    assert sorted((r["doc_id"], bytes(r["kept"]), r["n_spans"]) for r in got) == sorted(brute_repeats(rows, 50, first))
    assert all(r["n_removed"] + len(r["kept"]) == r["n_bytes"] for r in got)


def test_repeats_awkward(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 4096)  # long texts in parts
    got = repeats.remove_repeats(table(spark, awkward())).collect()
    want = brute_repeats([(-1 if i is None else i, t) for i, t in awkward()], 200, False)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], bytes(r["kept"]), r["n_spans"]) for r in got) == sorted(want)
    assert repeats.remove_repeats(table(spark, [])).count() == 0


def test_anchors_of_long_texts_are_given_once():
    rng = np.random.default_rng(13)
    text = bytes(rng.integers(97, 123, 5 * repeats.CHUNK // 2, dtype=np.uint8))
    parts = list(repeats.text_anchors([b"short", text]))
    i, a, h, c, most, least = (np.concatenate(x) for x in zip(*parts, strict=True))
    assert len(parts) == 3 and set(i.tolist()) == {1} and len(np.unique(a)) == len(a)
    whole = repeats.anchors(np.frombuffer(text, np.uint8), np.array([[0, len(text)]]), np.array([[0, len(text) - repeats.LENGTH + 1]]), repeats.LENGTH, repeats.GRAM)
    assert all((x == y).all() for x, y in zip((a, h, c, most, least), whole[1:], strict=True))
    assert (a[1:] - most[1:] == a[:-1] - least[:-1] + 1).all()  # each string has one anchor


@pytest.mark.parametrize("kind", [0, 1, 2, 3])
def test_previous_factors_are_those_of_smaller_places(kind):
    rng = np.random.default_rng(16 + kind)
    n = 400
    lcp = rng.integers(0, 9, n)
    lcp[rng.random(n) < 0.03] = -1
    lcp[0] = -1
    place = (rng.permutation(n), np.arange(n), np.arange(n)[::-1].copy(), np.abs(np.arange(n) - n // 2) * 2 + (np.arange(n) > n // 2))[kind]
    want = np.zeros(n, int)
    for i in range(n):
        for way in (-1, 1):
            least, k = 99, i
            while 0 <= k + way < n and lcp[max(k, k + way)] >= 0:
                least, k = min(least, lcp[max(k, k + way)]), k + way
                if place[k] < place[i]:
                    want[i] = max(want[i], least)
    assert repeats.previous_factors(place, lcp).tolist() == want.tolist()


def test_long_text_without_repeats_stays_whole(spark):
    rng = np.random.default_rng(14)
    text = bytes(rng.integers(97, 123, 9 * repeats.CHUNK // 4, dtype=np.uint8)).decode()
    again = text[repeats.CHUNK - 300 : repeats.CHUNK + 300]  # a true repeat across a border is still found
    assert [(r["n_removed"], r["n_spans"]) for r in repeats.remove_repeats(table(spark, [(1, text)])).collect()] == [(0, 0)]
    got = {r["doc_id"]: (r["n_removed"], r["spans"]) for r in repeats.remove_repeats(table(spark, [(1, text), (2, again)])).collect()}
    assert got == {1: (600, [repeats.CHUNK - 300, repeats.CHUNK + 300]), 2: (600, [0, 600])}


def brute_near(rows, num):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD)) for _, t in rows]
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset() for w in words]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= num * len(a | sets[j]):
                parent[root(i)] = root(j)
    ids = [(i is not None, i or 0) for i, _ in rows]
    return [min(ids[j] for j in range(len(rows)) if root(j) == root(i)) for i in range(len(rows))], [len(s) for s in sets]


#: Two texts that a polynomial of one known factor modulo 2^64 takes for the same, and two for any odd factor.
LIKE = ("mllomlllnlllnmnlmllnnmmmnm", "mnnlmnonmnnnmmlnnoommmmmln")
MORSE = tuple("".join("ab"[(k.bit_count() + way) % 2] for k in range(1024)) for way in (0, 1))


def test_no_hash_is_taken_for_bytes(spark):
    pad = lambda k, n: "".join(random.Random(k).choice("pqrstuvw") for _ in range(n))
    for a, b in (LIKE, MORSE):
        assert len(a) == len(b) and a != b
        got = near.near_duplicates(table(spark, [(1, a), (2, b)]), 85).collect()
        assert [(r["doc_id"], r["component_id"], r["kept"]) for r in sorted(got)] == [(1, 1, True), (2, 2, True)]
    a, b = LIKE
    rows = [(1, pad(1, 140) + a + pad(2, 134)), (2, pad(1, 140) + b + pad(2, 134)), (3, MORSE[0]), (4, MORSE[1])]
    got = repeats.remove_repeats(table(spark, rows)).collect()
    assert sorted((r["doc_id"], bytes(r["kept"]), r["n_spans"]) for r in got) == sorted(brute_repeats(rows, 200, False))
    assert {r["doc_id"]: r["n_removed"] for r in got if r["doc_id"] < 3} == {1: 0, 2: 0}


def test_keyed_hashes():
    rng = random.Random(33)
    words = list({"".join(rng.choice("ab\x00é") for _ in range(rng.randint(1, 40))) for _ in range(5000)}) + ["x" * n for n in (511, 512, 513, 3000)] + ["a", "a\x00", "a\x00\x00"]
    words = list(dict.fromkeys(words))
    one, two = Key(b"1" * 16), Key(b"2" * 16)
    h, ptr = word_hashes([" ".join(words), *words], one)
    assert len(set(h.tolist())) == len(words) and (h[: len(words)] == h[len(words) :]).all() and ptr.tolist() == [0, *range(len(words), 2 * len(words) + 1)]
    assert not set(h.tolist()) & set(word_hashes(words, two)[0].tolist())
    data = bytes(rng.choice(b"ab") for _ in range(3000))
    g = blocks(np.frombuffer(data, np.uint8), one)
    for n in (8, 12, 40):
        of: dict = {}
        for i, x in enumerate(windows(g, n, one).tolist()):
            assert of.setdefault(data[i : i + n], x) == x
        assert len(set(of.values())) == len(of)
    start = np.array([rng.randrange(2000) for _ in range(4000)])
    end = start + np.array([rng.randint(8, 30) for _ in range(4000)])
    of = {}
    for i, j, x in zip(start.tolist(), end.tolist(), spans(g, start, end, one).tolist(), strict=True):
        assert of.setdefault(data[i:j], x) == x
    assert len(set(of.values())) == len(of)


def test_slices_are_bounded():
    import pyarrow as pa

    column = pa.array(["x" * n if n >= 0 else None for n in [5, 0, -1, 3, 900, 2, 2, 2, 2, 400, 400, 300]])
    got = list(slices(column, 3, 1000))
    assert [column.slice(a, z - a).to_pylist() for a, z in got] and got[0] == (0, 3) and [z for _, z in got[:-1]] == [a for a, _ in got[1:]] and got[-1][1] == len(column)
    assert all(z - a <= 3 and (z - a == 1 or sum(len(t or "") for t in column.slice(a, z - a).to_pylist()) <= 1000) for a, z in got)
    assert list(slices(column[:0])) == [] and list(slices(pa.chunked_array([column]).combine_chunks(), 100, 1)) == [(0, 1), *list(slices(column, 100, 1))[1:]]


@pytest.mark.parametrize(("block", "size"), [(1024, 16 << 20), (16, 16 << 20), (1024, 20_000)])
def test_near_against_brute_force(spark, monkeypatch, block, size):
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "BYTES", size)
    monkeypatch.setattr(near, "HUBS", 3)
    rng = random.Random(8)
    base = prose(rng, 150).split(" ")
    rows = list(awkward())
    for k in range(90):  # a family that drifts: links chain
        if k % 3 == 0:
            base[rng.randrange(len(base))] = f"w{k}"
        w = base[:]
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"e{rng.random()}"
        rows.append((100 + k, " ".join(w)))
    rows += [(300 + k, prose(rng, 40)) for k in range(20)] + [(400, "one two"), (401, "one TWO"), (402, "one two three four five"), (403, "one")]
    got = near.near_duplicates(table(spark, rows), 85).collect()
    want, sizes = brute_near(rows, 85)
    key = lambda i: (i is not None, i or 0)
    assert sorted((key(r["doc_id"]), r["n_shingles"], key(r["component_id"])) for r in got) == sorted((key(i), n, c) for (i, _), n, c in zip(rows, sizes, want, strict=True))
    left = near.drop_near_duplicates(table(spark, rows), 85)
    assert {key(r["doc_id"]) for r in left.collect()} == {c for c in want} and left.columns == table(spark, []).columns
    assert near.near_duplicates(table(spark, [])).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(9)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = np.sort(pool[:2400]), np.sort(pool[600:3000])
    assert (np.maximum(near.registers(a), near.registers(b)) == near.registers(np.unique(np.concatenate([a, b])))).all()
    got = near.estimate(near.registers(b)[None], np.array([len(b)]), near.registers(a), len(a))[0]
    assert abs(got - 1800 / 3000) < 0.2


@pytest.mark.parametrize("held", [graph.LINKS, 7])
def test_components(spark, monkeypatch, held):
    monkeypatch.setattr(graph, "LINKS", held)
    rng = random.Random(10)
    links = [(k, k + 1) for k in range(0, 40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(500, k) for k in range(300, 400)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"), "c").collect()}
    label = {x: x for p in links for x in p}
    for _ in range(100):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if any(k in p and p[0] != p[1] for p in links)}


def test_likelihood_is_the_forward_recursion():
    rng = np.random.default_rng(11)
    m = lm.first_model(rng.dirichlet(np.ones(30)), 4)

    def plain(x):
        a, log = m.start * m.emit[x[0]], 0.0
        for s in x[1:]:
            log, a = log + math.log10(a.sum()), (a / a.sum()) @ m.move * m.emit[s]
        return log + math.log10(a.sum())

    xs = [rng.integers(0, 30, n) for n in (1, 2, 255, 511, 512, 513, 1024, 2600)]
    assert np.allclose(lm.likelihood(xs, m), [plain(x) for x in xs])


def test_expected_counts_are_those_of_whole_texts(monkeypatch):
    """Cut into stretches or not: the same starts, moves, emissions and likelihood, and those of plain recursions."""
    rng = np.random.default_rng(22)
    m = lm.first_model(rng.dirichlet(np.ones(12)), 3)
    texts = [rng.integers(0, 12, n) for n in (1, 2, 6, 7, 8, 14, 15, 40, 3)]

    def plain(x):
        a, b = [m.start * m.emit[x[0]]], [np.ones(3)]
        for s in x[1:]:
            a.append(a[-1] @ m.move * m.emit[s])
        for s in x[:0:-1]:
            b.insert(0, m.move @ (m.emit[s] * b[0]))
        p = a[-1].sum()
        moves = sum((m.move * np.outer(a[t], m.emit[x[t + 1]] * b[t + 1]) / p for t in range(len(x) - 1)), np.zeros((3, 3)))
        emits = np.zeros((12, 3))
        for t, s in enumerate(x):
            emits[s] += a[t] * b[t] / p
        return a[0] * b[0] / p, moves, emits, math.log10(p)

    want = [sum(v) for v in zip(*map(plain, texts), strict=True)]
    for stretch in (512, 7, 2):
        monkeypatch.setattr(lm, "STRETCH", stretch)
        counts = np.zeros(3), np.zeros((3, 3)), np.zeros((12, 3))
        log = lm.expect_texts(texts, m, counts)
        assert all(np.allclose(c, w) for c, w in zip((*counts, log), want, strict=True))
        assert np.allclose(lm.likelihood(texts, m), [plain(x)[3] for x in texts])


def test_training_raises_likelihood():
    rng = np.random.default_rng(12)
    parts = [np.concatenate([rng.integers(0, 10, 20), rng.integers(10, 20, 20)]) for _ in range(60)]
    m = lm.first_model(np.full(20, 1 / 20), 2)
    was = -np.inf
    for _ in range(6):
        counts = np.zeros(2), np.zeros((2, 2)), np.zeros((20, 2))
        now = lm.expect(parts, m, counts)
        assert now >= was - 1e-9 and math.isclose(counts[2].sum(), 60 * 40) and math.isclose(counts[1].sum(), 60 * 39)
        was, m = now, lm.Model(counts[0] / counts[0].sum(), counts[1] / counts[1].sum(1, keepdims=True), counts[2] / counts[2].sum(0))


@pytest.mark.parametrize("sizes", [(1 << 17, 1 << 15), (40, 12)])
def test_scores(spark, monkeypatch, sizes):
    monkeypatch.setattr(lm, "FREQUENT", sizes[0])
    monkeypatch.setattr(lm, "SYMBOLS", sizes[1])
    rows = awkward() + documents(spark)[:60]
    docs = table(spark, rows)
    got = lm.score(docs, rounds=2).collect()
    words = lambda t: WORD_BYTES.findall((t or "").encode().translate(FOLD_BYTES)) + [b"\n"]
    c = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(words(t)), sum(c[w] > 0 for w in words(t)), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)), 6)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n} and all(r["score"] < 0 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in got)
    assert lm.score(docs.limit(0), rounds=1).count() == 0


@pytest.mark.parametrize("sizes", [(1 << 17, 1 << 15), (40, 12)])
def test_score_against_plain_training(spark, monkeypatch, sizes):
    """The whole query's score, from a Baum-Welch and a forward recursion that read token by token."""
    monkeypatch.setattr(lm, "FREQUENT", sizes[0])
    monkeypatch.setattr(lm, "SYMBOLS", sizes[1])
    monkeypatch.setattr(lm, "STRETCH", 100)
    rows = documents(spark)[:40]
    words = {i: WORD_BYTES.findall((t or "").encode().translate(FOLD_BYTES)) + [b"\n"] for i, t in rows}
    train = [i for i in words if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for i in train for w in words[i])
    total, v = sum(c.values()), len(c)
    vocab = lm.vocabulary(lm.count_words(table(spark, [r for r in rows if r[0] in train])))
    symbols = min(sizes[1], len(vocab.c))
    mass = np.full(lm.CLASSES, 0.5)
    for w, n in c.items():
        if vocab.rank.get(w, symbols) >= symbols:
            mass[lm.word_class(w)] += n + 0.5
    code = lambda w: vocab.rank[w] if vocab.rank.get(w, symbols) < symbols else symbols + lm.word_class(w)
    inside = lambda w: 0.0 if code(w) < symbols else math.log10((c[w] + 0.5) / mass[lm.word_class(w)])
    unigram = np.concatenate([[c[w] + 0.5 for w in sorted(vocab.rank, key=vocab.rank.get)[:symbols]], mass])
    unigram /= unigram.sum()
    m, k = lm.first_model(unigram), lm.STATES

    def forward(x):
        a, scale = [], []
        for t, s in enumerate(x):
            y = (m.start if t == 0 else a[-1] @ m.move) * m.emit[s]
            scale.append(y.sum())
            a.append(y / y.sum())
        return a, scale

    for _ in range(2):
        starts, moves, emits = np.full(k, 0.1), np.full((k, k), 0.1), 0.5 * unigram[:, None] * np.ones(k) + 1e-12
        for i in train:
            x = [code(w) for w in words[i]]
            a, scale = forward(x)
            b = np.ones(k)
            for t in range(len(x) - 1, -1, -1):
                emits[x[t]] += a[t] * b
                if t:
                    back = m.emit[x[t]] * b / scale[t]
                    moves += m.move * np.outer(a[t - 1], back)
                    b = m.move @ back
            starts += a[0] * b
        m = lm.Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    want = {i: sum(map(math.log10, forward([code(w) for w in ws])[1])) + sum(map(inside, ws)) for i, ws in words.items()}
    got = {r["doc_id"]: r for r in lm.score(table(spark, rows), rounds=2).collect()}
    assert all(math.isclose(got[i]["score"], want[i], rel_tol=1e-7) for i in want) and {r["train_tokens"] for r in got.values()} == {total}
    assert all(math.isclose(got[i]["base_score"], sum(math.log10((c[w] + 0.5) / (total + 0.5 * (v + 1))) for w in ws), rel_tol=1e-9) for i, ws in words.items())


def test_the_model_is_a_distribution(spark, monkeypatch):
    """Over all words, one unknown word for each class, and the end: probabilities of the first token add up to one."""
    monkeypatch.setattr(lm, "SYMBOLS", 5)
    counts = lm.count_words(table(spark, [(k, "a b c d e f g h " * (k + 1)) for k in range(3)]))
    v = lm.vocabulary(counts)
    classes = [lm.word_class(w) for w in v.rank]
    inside = sum((v.c[k] + 0.5) / v.mass[classes[k]] for k in range(5, len(v.c))) + sum(0.5 / m for m in v.mass)
    assert math.isclose(inside, lm.CLASSES)


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(p.STAGES):
        was, docs = docs, stage(spark, docs, FOLDER)
        docs = Scratch(spark, "test").table(docs, name)
        kept[name] = docs.count()
        assert k == len(p.STAGES) - 1 or docs.columns == columns
        if name == "toxicity":
            ix = toxicity.fit(was, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in toxicity.score(was, ix).filter("score < 0.5").collect()}
        if name == "line_dedup":
            assert docs.count() == was.count() and docs.filter("n_chars <> length(text)").count() == 0
        if name == "near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in was.collect()]
            want, _ = brute_near(rows, 80)
            assert {r["doc_id"] for r in docs.collect()} == {i for (i, _), c in zip(rows, want, strict=True) if c[1] == i}
        if name == "decontamination":
            bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
            assert {r["doc_id"] for r in was.collect()} - {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in dc.find_leaks(was, bench).collect()}
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {r["doc_id"] for r in was.select("doc_id").collect()}


def test_pipeline_stages_take_anything(spark, tmp_path):
    """Nulls, repeated rows, clashing names, a table without n_chars, and empty tables; rows that have no reason to go stay."""
    import corpus_pipeline as p

    spark.createDataFrame([*((k, 0, 0) for k in (6, 8, 9, 10, 11, 12)), (7, 1, 1), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "What is asked here of those who know " + prose(random.Random(50), 12)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = "doc_id long, text string, n_removed string, n_lines string, _id string, _k string, score string, length string, sequence_id string, _t string"
    rows = [(i, t, *"abcdefgh") for i, t in awkward()]
    for name, data in (("some", rows), ("none", [])):
        docs = spark.createDataFrame(data, extra)
        for k, (stage, f) in enumerate(p.STAGES):
            was, docs = docs, f(spark, docs, str(tmp_path))
            docs = Scratch(spark, "test").table(docs, f"{name}-{stage}")
            if k < len(p.STAGES) - 1:
                assert docs.columns == was.columns and docs.filter("n_removed <> 'a' OR _t <> 'h'").count() == 0
            if k == 1:
                assert docs.count() == was.count()
        assert (docs.count() > 0) == (name == "some")


def test_scratches_are_closed(spark):
    from tickforge.llm.common import scratches_closed

    with scratches_closed():
        inner = Scratch(spark, "inner")
        assert inner.table(spark.range(3), "t").count() == 3
    assert not __import__("os").path.exists(inner.root.replace("file://", "", 1))
