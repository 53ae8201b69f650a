"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, with weighted votes.

A bounded sample of labelled rows gives the examples, with all their words. A word weighs by its inverse document
frequency over all documents and by how much it tells about the label in the sample; none is left out. The index is
bounded by the sample and is sent to all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import FOLD, FOLD_BYTES, WORD, bucket_col, tidied, values

#: Bounds of the sample: labelled rows of each class that are used as examples, chosen by a hash of their ids.
PER_CLASS = 2000
#: Neighbours that vote, examples of a block of the index, blocks that are read at first, and words that a task remembers.
NEIGHBOURS, BLOCK, AT_ONCE, CACHE = 25, 256, 2, 150_000
#: What a word that tells nothing about the label weighs besides its inverse document frequency.
FLOOR = 0.01
MARKS = ".,!?;:|#$%&*\"'()[]{}<>«»…-"


def fold(word: str) -> str:
    """A word in lower case without marks around it; empty if it is nothing but marks."""
    return word.translate(FOLD).strip(MARKS)


class _Words(dict):
    """Numbers of words (UTF-8, A-Z folded) in a vocabulary (its words by line), -1 for others; what was looked up is remembered, up to a bound."""

    def __init__(self, vocabulary: bytes):
        self.vocabulary = {w: k for k, w in enumerate(vocabulary.split(b"\n"))} if vocabulary else {}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        k = self[word] = self.vocabulary.get(word.decode().strip(MARKS).encode(), -1)
        return k

    def counts(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of a text's words, ascending, and how often each occurs."""
        found = (text or b"").translate(FOLD_BYTES).split()  # at the white space that parts words
        k = np.fromiter(map(self.__getitem__, found), np.int32, len(found))
        k.sort()
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
        n, k = np.diff(first, append=len(k)), k[first]
        return (k[1:], n[1:]) if len(k) and k[0] < 0 else (k, n)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each range in turn."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


@dataclass
class Index:
    """Examples with their labels, and the postings of each word: by example, in segments of one block each, with their largest weight."""

    vocabulary: bytes  # the words, by line
    weight: np.ndarray  # of words
    ids: list
    toxic: np.ndarray
    share: np.ndarray  # of an example's class among labelled rows, by example
    base: float = 0.0  # share of toxic among labelled rows
    steps: np.ndarray | None = None  # calibration: votes ...
    scores: np.ndarray | None = None  # ... and what they stand for

    def build(self, words: np.ndarray, examples: np.ndarray, w: np.ndarray) -> None:
        """Postings from words, examples and weights (normalised by example) of all entries."""
        order = np.lexsort((examples, words))
        words, self.example, self.w = words[order], examples[order].astype(np.int32), w[order]
        block = self.example // BLOCK
        start = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (block[1:] != block[:-1])])) if len(words) else np.empty(0, np.int64)
        self.start, self.size, self.block = start.astype(np.int32), np.diff(start, append=len(words)).astype(np.int32), block[start]
        self.most = np.maximum.reduceat(self.w, start) if len(start) else self.w
        self.first = np.searchsorted(words[start], np.arange(len(self.weight) + 1)).astype(np.int32)  # a word's first segment

    def vector(self, k: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (1 + np.log(n)) * self.weight[k]
        return w / np.sqrt((w * w).sum()) if len(w) else w

    def nearest(self, f: np.ndarray, w: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Exactly the k examples of highest positive cosine, of equal ones the first. Blocks whose bound is too low are not read."""
        count = self.first[f + 1] - self.first[f]
        segment, q = _ranges(self.first[f], count), np.repeat(w, count)
        block = self.block[segment]
        bound = np.bincount(block, self.most[segment] * q, -(-len(self.ids) // BLOCK))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, scores = np.empty(0, np.int64), np.empty(0)
        at, more = 0, AT_ONCE
        while at < len(order) and not (len(found) >= k and bound[order[at]] < scores[-1] - 1e-12):
            some = np.zeros(len(bound), bool)
            some[order[at : at + more]] = True
            at, more = at + more, 4 * more
            read = np.flatnonzero(some[block])
            size = self.size[segment[read]]
            post = _ranges(self.start[segment[read]], size)
            s = np.bincount(self.example[post], self.w[post] * np.repeat(q[read], size), len(self.ids))
            i = np.flatnonzero(s > 0)
            i = i[i != skip]
            found, scores = np.concatenate([found, i]), np.concatenate([scores, s[i]])
            top = np.lexsort((found, -scores))[:k]
            found, scores = found[top], scores[top]
        return found, scores

    def vote(self, near: np.ndarray, cosine: np.ndarray, prior: float = 0.05) -> float:
        """Share of the votes for toxic, each weighted by its squared cosine and its class's share of the labelled rows."""
        v = cosine**2 * self.share[near]
        return float(((v * self.toxic[near]).sum() + prior * self.base) / (v.sum() + prior))

    def score(self, k: np.ndarray, n: np.ndarray) -> tuple[float, list[tuple]]:
        near, cosine = self.nearest(k, self.vector(k, n), NEIGHBOURS)
        return float(np.interp(self.vote(near, cosine), self.steps, self.scores)), [(self.ids[i], float(c)) for i, c in zip(near[:3].tolist(), cosine[:3], strict=True)]


def _monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours: where steps begin and end, and their values."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x[order], y[order], w[order], strict=True):
        if pools and pools[-1][1] == xi:
            pools[-1][2] += yi * wi
            pools[-1][3] += wi
        else:
            pools.append([xi, xi, yi * wi, wi])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            b = pools.pop()
            pools[-1] = [pools[-1][0], b[1], pools[-1][2] + b[2], pools[-1][3] + b[3]]
    at = np.array([v for p in pools for v in p[:2]])
    return at, np.repeat([p[2] / p[3] for p in pools], 2)


def telling(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """G statistic of words that occur in a of n1 toxic and b of n0 other examples."""
    part = lambda x, of, n: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) * (n1 + n0) / (np.maximum(of, 1e-9) * max(n, 1e-9))), 0)
    of, absent = a + b, n1 + n0 - a - b
    return np.maximum(2 * (part(a, of, n1) + part(b, of, n0) + part(n1 - a, absent, n1) + part(n0 - b, absent, n0)), 0)


def _frequencies(docs: DataFrame, text_col: str, vocabulary: bytes, size: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each word occurs, and how many documents there are; tasks add up what they read."""

    def count(batches):
        words, df, n = _Words(sent.value), np.zeros(size + 1, np.int64), 0
        for b in batches:
            n += b.num_rows
            for t in values(b.column(0)):
                df[words.counts(t)[0]] += 1
        df[-1] = n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["k", "n"])

    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    got = docs.select(F.col(text_col).cast("binary")).mapInArrow(tidied(count), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()  # a row for each word of the sample
    sent.unpersist()
    df = np.zeros(size + 1)
    df[got["k"].to_numpy()] = got["n"].to_numpy()
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Learn from labelled rows (doc_id, toxic) whose crc32(doc_id) mod 5 isn't 0, at most ``per_class`` of each class.

    The driver gets the words of these rows and in how many of all documents each occurs. Null labels and null ids are left
    out; of repeated labels the highest counts; of rows of one id that of the smallest text hash is the example. Other columns
    are ignored. Without labels of both classes, or without documents, all scores are equal.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (bucket_col(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    sample = {r["doc_id"]: r["toxic"] for p in picked for r in p.collect()}  # at most 2 * per_class rows
    kind = labels.schema["doc_id"].dataType
    small = spark.createDataFrame(list(sample.items()), T.StructType([T.StructField("_id", kind), T.StructField("_toxic", T.IntegerType())]))
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(F.broadcast(small), F.col("_doc") == F.col("_id"))
    rows = rows.groupBy("_id").agg(F.min_by(F.struct("_toxic", "_text"), F.xxhash64("_text")).alias("_x")).select("_id", "_x.*")

    def words(batches):
        for b in batches:
            out = []
            for i, y, t in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                n: dict[str, int] = {}
                for w in map(fold, WORD.findall(t or "")):
                    if w:
                        n[w] = n.get(w, 0) + 1
                out.append((i, y, list(n), list(n.values())))
            cols = list(zip(*out, strict=True)) or [()] * 4
            kinds = (b.column(0).type, pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["id", "toxic", "words", "n"])

    got = rows.mapInArrow(words, f"id {kind.simpleString()}, toxic int, words array<string>, n array<int>").toArrow().combine_chunks()  # at most 2 * per_class rows
    ids, toxic = got["id"].to_pylist(), got["toxic"].to_numpy().astype(float)
    column = lambda c: got[c].combine_chunks() if len(ids) else pa.array([], got.schema.field(c).type)
    sizes_of = np.diff(column("words").offsets.to_numpy()) if ids else np.empty(0, np.int64)
    coded, n = column("words").flatten().dictionary_encode(), column("n").flatten().to_numpy()
    word, names = coded.indices.to_numpy().astype(np.int32), len(coded.dictionary)
    vocabulary = b"\n".join(coded.dictionary.cast(pa.binary()).to_pylist())
    del got, coded
    df, total = _frequencies(docs, text_col, vocabulary, names)
    n1, n0 = int(toxic.sum()), int((1 - toxic).sum())
    a, b = (np.bincount(word, np.repeat(x, sizes_of), names) for x in (toxic, 1 - toxic))
    weight = (np.log((1 + total) / (1 + df)) + 1) * (telling(a, b, n1, n0) + FLOOR)
    # examples that share their heaviest word lie together, so that blocks have tight bounds
    ends = np.cumsum(sizes_of)
    parts = [slice(e - s, e) for s, e in zip(sizes_of.tolist(), ends.tolist(), strict=True)]
    heaviest = [int(word[p][np.argmax(weight[word[p]])]) if p.stop > p.start else -1 for p in parts]
    order = sorted(range(len(ids)), key=lambda i: (-toxic[i], heaviest[i], ids[i]))
    share = np.array([sizes.get(1 if toxic[i] else 0, 1) / (n1 if toxic[i] else n0) for i in order]) * len(ids) / (sum(sizes.values()) or 1)
    index = Index(vocabulary, weight, [ids[i] for i in order], toxic[order] if ids else toxic, share, sizes.get(1, 0) / (sum(sizes.values()) or 1))
    w = np.empty(len(word))
    for p in parts:
        w[p] = index.vector(word[p], n[p])
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids))
    index.build(word, np.repeat(place, sizes_of), w)
    vectors = ((word[parts[i]], w[parts[i]]) for i in order)
    votes = [index.vote(*index.nearest(f, v, NEIGHBOURS, skip=i)) for i, (f, v) in enumerate(vectors)]  # each example judged by the others
    index.steps, index.scores = _monotone(np.array(votes), index.toxic, index.share) if ids else (np.array([0.0, 1.0]), np.full(2, index.base))
    return index


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on) and evidence (nearest examples: doc_id, cosine), a row per row.

    Null and empty texts, and those without a word of any example, have no neighbours: they get what the share of toxic rows
    stands for. Null ids and repeated rows pass through. Whole texts are read. Other columns are ignored; no rows, no scores.
    """
    sent = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample
    near = pa.int64() if all(isinstance(i, int) for i in index.ids) else pa.string()

    def judge(batches):
        i = sent.value
        words = _Words(i.vocabulary)
        for b in batches:
            got = [i.score(*words.counts(t)) for t in values(b.column(1))]
            s = [x for x, _ in got]
            evidence = pa.array([[{"doc_id": d, "cosine": c} for d, c in e] for _, e in got], pa.list_(pa.struct([("doc_id", near), ("cosine", pa.float64())])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32()), evidence], names=["doc_id", "score", "predicted", "evidence"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(tidied(judge), f"doc_id {kind}, score double, predicted int, evidence array<struct<doc_id: {'long' if near == pa.int64() else 'string'}, cosine: double>>")


def reject_toxic(docs: DataFrame, index: Index, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, with all their columns; texts don't leave their task."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def keep(batches):
        i = sent.value
        words = _Words(i.vocabulary)
        for b in batches:
            yield b.filter(pa.array([i.score(*words.counts(t))[0] < threshold for t in values(b.column(text_col).cast(pa.binary()))], pa.bool_()))

    return docs.mapInArrow(tidied(keep), T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
