"""Language-model scoring with a hidden Markov model over words, trained by Baum-Welch.

Word counts come from all training rows. The most frequent words are symbols of their own; the others share symbols, by
a hash of their ending, and keep their own probability within the class, so that the model is a distribution over all
texts. Expected counts of each round are summed over partitions, until a round gains little. Both the counts and the
likelihoods are those of whole texts, by scaled recursions: long texts are cut into stretches, whose transfer matrices are
multiplied to tell what stands before and after each.

Sent to all tasks are FREQUENT words and the model, whose size is fixed; counts of rarer words are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import repeat
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import FOLD_BYTES, Scratch, bucket_col, values

#: Words whose counts are sent along, words that are symbols, classes of the others, states, and tokens of a stretch.
FREQUENT, SYMBOLS, CLASSES, STATES, STRETCH = 1 << 17, 1 << 15, 64, 6, 2048
#: Tokens after which recursions are scaled; no probability of a token is so small that as many of them underflow.
SCALED = 8
#: Rounds of training at most, and the gain of a round (by the log likelihood) under which no other follows.
ROUNDS, GAIN = 8, 0.001
END = b"\n"  # ends every text; no word holds it
_HELD, _CELLS = 400_000, 1 << 19  # words that a task adds up, tokens that are read at once


def words(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z folded, and the end."""
    out = (text or b"").translate(FOLD_BYTES).split()  # at the white space that parts words
    out.append(END)
    return out


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word and c of all texts, each with its end. Tasks add up what they have read before it is shuffled."""

    def count(batches):
        def out(c):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "c"])

        c: Counter = Counter()
        for b in batches:
            for t in values(b.column(0)):
                c.update(words(t))
                if len(c) > _HELD:
                    yield out(c)
                    c = Counter()
        yield out(c)

    return docs.select(F.col(text_col).cast("binary")).mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Counts of frequent words by rank, totals, and what a rare word's class weighs."""

    rank: dict[bytes, int]
    c: np.ndarray
    classes: np.ndarray
    n: int
    v: int
    mass: np.ndarray

    @property
    def size(self) -> int:
        return min(SYMBOLS, len(self.c)) + CLASSES


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From a table of counts; at most FREQUENT words and CLASSES sums come to the driver."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # the lowest count, on a grid of 16 steps to a doubling, from which on there are no more than FREQUENT words
    step, room, least = F.floor(16 * F.log2("c")).alias("k"), FREQUENT - 1, 1 << 12
    for k, n in sorted(((r["k"], r["count"]) for r in counts.groupBy(step).count().collect()), reverse=True):
        room -= n
        if room < 0:
            break
        least = k
    got = counts.filter((F.floor(16 * F.log2("c")) >= least) | (F.col("word") == F.lit(END))).toArrow()
    top = sorted(zip(got["word"].to_pylist(), got["c"].to_pylist(), strict=True), key=lambda r: (r[0] != END, -r[1], r[0]))  # the end is a symbol in any case
    names, c = [w for w, _ in top], np.array([n for _, n in top], np.float64)
    ending = F.expr("substring(word, greatest(length(word) - 2, 1), 3)")
    mass = np.full(CLASSES, 0.5)  # for words never seen
    for r in counts.groupBy((F.crc32(ending) % CLASSES).alias("k")).agg((F.sum("c") + 0.5 * F.count("*")).alias("w")).collect():
        mass[r["k"]] += r["w"]
    classes = np.array([word_class(w) for w in names], np.int64)
    s = min(SYMBOLS, len(names))
    np.subtract.at(mass, classes[:s], c[:s] + 0.5)
    return Vocabulary({w: k for k, w in enumerate(names)}, c, classes, total["n"], total["v"], mass)


def encode(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows in symbols: _row, doc_id, held_out, n_tokens, _known, _base and _within (log10 sums of frequent words), _symbols and _rare."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def rows(batches):
        v = sent.value
        s, get = min(SYMBOLS, len(v.c)), v.rank.get
        base = np.log10((v.c + 0.5) / (v.n + 0.5 * (v.v + 1)))
        weight, within = np.log10(v.mass), np.log10(v.c + 0.5) - np.log10(v.mass)[v.classes] if len(v.c) else v.c
        for b in batches:
            out = []
            for t in values(b.column(1)):
                w = words(t)
                k = np.fromiter(map(get, w, repeat(-1)), np.int64, len(w))
                symbols = k.copy()
                often, seldom = np.flatnonzero(k >= s), np.flatnonzero(k < 0)
                rare = [w[i] for i in seldom.tolist()]
                classes = np.array([word_class(x) for x in rare], np.int64)
                if len(often):
                    symbols[often] = s + v.classes[k[often]]
                symbols[seldom] = s + classes
                seen = k[k >= 0]
                out.append((len(w), len(seen), float(base[seen].sum()), float(within[k[often]].sum() - weight[classes].sum()), symbols.astype("<u2").tobytes(), rare))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()))
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True))], names=["doc_id", "held_out", "n_tokens", "_known", "_base", "_within", "_symbols", "_rare"])

    kind = dict(docs.dtypes)[id_col]
    got = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("_t"), (bucket_col(F.col(id_col)) == 1).alias("held_out"))
    out = got.mapInArrow(rows, f"doc_id {kind}, held_out boolean, n_tokens long, _known long, _base double, _within double, _symbols binary, _rare array<binary>")
    return out.withColumn("_row", F.monotonically_increasing_id())


@dataclass
class Model:
    start: np.ndarray  # K
    move: np.ndarray  # K, K
    emit: np.ndarray  # symbols, K


def first_model(unigram: np.ndarray, states: int = STATES, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    emit = unigram[:, None] * np.exp(rng.normal(0, 0.5, (len(unigram), states)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols by place and sequence, longest sequences first, and how many sequences are that long."""
    n = np.array([len(p) for p in parts])
    out = np.zeros((n.max(), len(parts)), np.int64)
    for i, p in enumerate(parts):
        out[: len(p), i] = p
    return out, (n[None, :] > np.arange(n.max())[:, None]).sum(1)


def expect(parts: list[np.ndarray], m: Model, counts: tuple[np.ndarray, np.ndarray, np.ndarray], before: np.ndarray | None = None, after: np.ndarray | None = None) -> float:
    """Adds the expected starts, moves and emissions of the sequences to ``counts``; gives their log10 likelihood.

    ``before`` and ``after`` are for sequences that are stretches of longer ones: the forward message of what stands before
    (a row of zeros where the sequence begins a text) and the backward message of what stands after, up to a factor.
    """
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    x, live = _padded([parts[i] for i in order])
    steps, b, k = x.shape[0], x.shape[1], len(m.start)
    before = np.zeros((b, k)) if before is None else before[order]
    beta = np.ones((b, k)) if after is None else after[order].copy()
    inner = before.sum(1) > 0
    alpha, scale, one = np.zeros((steps, b, k)), np.ones((-(-steps // SCALED), b)), np.ones(k)
    e = m.emit[x]
    for t in range(steps):
        n = live[t]
        a = np.multiply(np.where(inner[:, None], before @ m.move, m.start) if t == 0 else alpha[t - 1, :n] @ m.move, e[t, :n], out=alpha[t, :n])
        if t % SCALED == 0:
            c = scale[t // SCALED, :n] = a @ one
            a /= c[:, None]
    last = alpha[np.array([len(parts[i]) for i in order]) - 1, np.arange(b)]
    beta /= (last * beta).sum(1)[:, None]
    starts, moves, emits = counts
    gamma = np.zeros((steps, b, k))
    for t in range(steps - 1, -1, -1):
        n = live[t]
        np.multiply(alpha[t, :n], beta[:n], out=gamma[t, :n])
        back = e[t, :n] * beta[:n]
        if t % SCALED == 0:
            back /= scale[t // SCALED, :n, None]
        moves += m.move * ((alpha[t - 1, :n] if t else before).T @ back)
        if t:
            beta[:n] = back @ m.move.T
    starts += gamma[0][~inner].sum(0)
    s, g = x.ravel(), gamma.reshape(-1, k)  # nothing is expected in the padding
    for i in range(k):
        emits[:, i] += np.bincount(s, weights=g[:, i], minlength=len(emits))
    return float(np.log10(scale).sum() + np.log10(last.sum(1)).sum())


def _groups(items: list, size):
    """The items, longest first, in groups of at most _CELLS tokens with their padding."""
    items = sorted(items, key=lambda i: -size(i))
    at = 0
    while at < len(items):
        end = at + max(1, _CELLS // max(1, size(items[at])))
        yield items[at:end]
        at = end


def _stretches(s: np.ndarray) -> list[np.ndarray]:
    return [s[i : i + STRETCH] for i in range(0, len(s), STRETCH)]


def transfers(parts: list[tuple[int, int, np.ndarray]], m: Model) -> dict[tuple[int, int], tuple[np.ndarray, float]]:
    """By text and number of each stretch (text, number, symbols): the matrix from what stands before to its last state, and the log10 of its scale.

    The first stretch of a text begins in its first state, others with a move.
    """
    out, k = {}, len(m.start)
    one = np.ones(k * k)
    for group in _groups(parts, lambda p: k * len(p[2])):
        x, live = _padded([p[2] for p in group])
        a, log = np.broadcast_to(np.eye(k), (len(group), k, k)).copy(), np.zeros(len(group))
        first = np.array([p[1] == 0 for p in group])
        for t in range(x.shape[0]):
            n = live[t]
            y = (a[:n].reshape(-1, k) @ m.move).reshape(n, k, k)
            if t == 0 and first.any():
                y = np.where(first[:n, None, None], a[:n], y)
            np.multiply(y, m.emit[x[t, :n]][:, None, :], out=a[:n])
            if t % SCALED == 0:
                c = a[:n].reshape(n, -1) @ one
                a[:n] /= c[:, None, None]
                log[:n] += np.log10(c)
        for i, (j, q, _) in enumerate(group):
            out[j, q] = a[i], log[i]
    return out


def expect_texts(texts: list[np.ndarray], m: Model, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
    """Adds the expected counts of whole texts, whatever their lengths; gives their log10 likelihood."""
    total, parts = 0.0, [(j, q, s) for j, t in enumerate(texts) if len(t) > STRETCH for q, s in enumerate(_stretches(t))]
    for group in _groups([t for t in texts if len(t) <= STRETCH], len):
        total += expect(group, m, counts)
    matrix = transfers(parts, m)
    said: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for j, n in Counter(j for j, _, _ in parts).items():
        forward, messages = np.zeros(len(m.start)), []
        for q in range(n):
            messages.append(forward)
            forward = (m.start if q == 0 else forward) @ matrix[j, q][0]
            forward /= forward.sum()
        after = np.ones(len(m.start))
        for q in range(n - 1, -1, -1):
            said[j, q] = messages[q], after
            after = matrix[j, q][0] @ after
            after /= after.sum()
    for group in _groups(parts, lambda p: len(p[2])):
        ends = [said[j, q] for j, q, _ in group]
        total += expect([s for *_, s in group], m, counts, np.array([x for x, _ in ends]), np.array([y for _, y in ends]))
    return total


def _rounds(train: DataFrame, m: Model) -> DataFrame:
    """_what (-1: the log10 likelihood, -2: starts, -3 - k: moves from k, else a symbol), _x (expected counts by state), added over partitions."""
    sent = train.sparkSession.sparkContext.broadcast(m)

    def add(batches):
        m = sent.value
        k = len(m.start)
        counts = np.zeros(k), np.zeros((k, k)), np.zeros_like(m.emit)
        held, size, log = [], 0, 0.0
        for b in batches:
            for raw in b.column(0).to_pylist():
                held.append(np.frombuffer(raw, "<u2"))
                size += len(held[-1])
                if size >= 4 * _CELLS:
                    log, held, size = log + expect_texts(held, m, counts), [], 0
        log += expect_texts(held, m, counts)
        some = np.flatnonzero(counts[2].sum(1) > 0)
        what = np.concatenate([[-1, -2], -3 - np.arange(k), some])
        x = np.concatenate([np.full((1, k), log), counts[0][None], counts[1], counts[2][some]])
        yield pa.RecordBatch.from_arrays([pa.array(what, pa.int64()), *(pa.array(x[:, i]) for i in range(k))], names=["_what", *(f"_x{i}" for i in range(k))])

    k = len(m.start)
    rows = train.select("_symbols").mapInArrow(add, "_what long, " + ", ".join(f"_x{i} double" for i in range(k)))
    return rows.groupBy("_what").agg(*(F.sum(f"_x{i}").alias(f"_x{i}") for i in range(k)))


def train(encoded: DataFrame, unigram: np.ndarray, rounds: int = ROUNDS, states: int = STATES, gain: float = GAIN) -> Model:
    """Baum-Welch over the rows that aren't held out, until a round raises their log likelihood by less than ``gain`` of it.

    Each round brings at most a row for each symbol to the driver.
    """
    m = first_model(unigram, states)
    rows, was = encoded.filter("NOT held_out"), -np.inf
    for _ in range(rounds):
        starts, moves, emits = np.full(states, 0.1), np.full((states, states), 0.1), 0.5 * unigram[:, None] * np.ones(states) + 1e-12
        got = _rounds(rows, m).toArrow()
        what, x = got["_what"].to_numpy(), np.stack([got[f"_x{i}"].to_numpy() for i in range(states)], 1)
        starts += x[what == -2].sum(0)
        np.add.at(moves, -what[what < -2] - 3, x[what < -2])
        np.add.at(emits, what[what >= 0], x[what >= 0])
        m = Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
        now = float(x[what == -1].sum() / states)
        if not now < 0 or now - was < -gain * now:
            break
        was = now
    return m


def likelihood(texts: list[np.ndarray], m: Model) -> np.ndarray:
    """log10 probability of each sequence of symbols, by the forward recursion over all of it."""
    out = np.zeros(len(texts))
    for group in _groups([j for j, t in enumerate(texts) if len(t) <= STRETCH], lambda j: len(texts[j])):
        x, live = _padded([texts[j] for j in group])
        a, log = np.broadcast_to(m.start, (len(group), len(m.start))).copy(), np.zeros(len(group))
        for t in range(x.shape[0]):
            n = live[t]
            np.multiply(a[:n] @ m.move if t else a[:n], m.emit[x[t, :n]], out=a[:n])
            if t % SCALED == 0:
                c = a[:n].sum(1)
                a[:n] /= c[:, None]
                log[:n] += np.log10(c)
        out[group] = log + np.log10(a.sum(1))
    long = [j for j, t in enumerate(texts) if len(t) > STRETCH]
    matrix = transfers([(j, q, s) for j in long for q, s in enumerate(_stretches(texts[j]))], m)
    for j in long:
        v = m.start
        for q in range(-(-len(texts[j]) // STRETCH)):
            a, more = matrix[j, q]
            v = v @ a
            c = v.sum()
            v, out[j] = v / c, out[j] + more + np.log10(c)
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, states: int = STATES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per row of ``docs``.

    Learns from rows whose crc32(doc_id) mod 5 isn't 1. base_score is the smoothed unigram's log10 probability, score the
    hidden Markov model's, of the words and the end. Null and empty texts have the end alone; very long ones are read whole.
    Null ids and repeated rows pass through. Without training rows all words are unknown to both. Other columns, whatever
    their names, are ignored. Empty table: no rows.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    counts = scratch.table(count_words(docs.filter(bucket_col(F.col(id_col)) != 1), text_col), "counts")
    vocab = vocabulary(counts)
    encoded = scratch.table(encode(docs, vocab, id_col, text_col), "symbols")
    s = min(SYMBOLS, len(vocab.c))
    unigram = np.concatenate([vocab.c[:s] + 0.5, vocab.mass])
    model = train(encoded, unigram / unigram.sum(), rounds, states)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        for b in batches:
            got = likelihood([np.frombuffer(x, "<u2").astype(np.int64) for x in b.column("_symbols").to_pylist()], sent.value)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(got)], names=[*names, "_log"])

    names = ["_row", "doc_id", "held_out", "n_tokens", "_known", "_base", "_within"]
    kinds = dict(encoded.dtypes)
    judged = encoded.select(*names, "_symbols").mapInArrow(judge, ", ".join(f"{c} {kinds[c]}" for c in names) + ", _log double")
    rare = encoded.select("_row", F.explode("_rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("_row").agg(F.sum(F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)).alias("_sum"), F.count("c").alias("_seen"), F.count("*").alias("_words"))
    out, none = judged.join(rare, "_row", "left"), F.lit(0.0)
    more, total = F.coalesce("_sum", none), float(np.log10(vocab.n + 0.5 * (vocab.v + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("_known") + F.coalesce("_seen", F.lit(0))).alias("n_known"), F.lit(int(vocab.n)).cast("long").alias("train_tokens"),
        (F.col("_base") + more - total * F.coalesce("_words", F.lit(0))).alias("base_score"), (F.col("_log") + F.col("_within") + more).alias("score"),
    )
