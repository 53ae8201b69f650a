"""Near-duplicate documents: SetSketch registers, banding, a joint likelihood estimate, then exact verification.

Registers hold exponentially spaced, truncated minima of hashed shingles; sketches merge by their maxima. Documents
with the same set of shingles are one class. Classes that share a band form clusters, by links to the first of a band and
never by pairs. A cluster's classes are then compared in blocks of bounded size: large clusters first with a few hubs,
after which only what isn't yet connected is compared with the rest. A link counts only after the full sets confirm it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, slices, tidied
from tickforge.llm.graph import components
from tickforge.llm.hashing import PLAIN, Key, mix, shingle_sets

WORDS = 5
#: Registers, rows of a band, base and rate of the exponential spacing, and the largest register.
REGISTERS, ROWS, BASE, RATE, TOP = 96, 4, 1.001, 20.0, 65534
#: Classes in a block and bytes of their sets, hubs of a large cluster, and how many deviations below the threshold an estimate may lie, and a mere count of equal registers.
BLOCK, BYTES, HUBS, SLACK, EASY = 1024, 16 << 20, 32, 6.0, 8.0
_FACTORS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch of a set of 64-bit hashes; of two sets' union it is the larger register at each place."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 512):
        np.minimum(least, (s[a : a + 512, None] * _FACTORS[None, :]).min(0), out=least)
    x = -np.log1p(-((least >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP).astype("<u2") if len(s) else np.zeros(REGISTERS, "<u2")


def estimate(regs: np.ndarray, n: np.ndarray, hub: np.ndarray, n_hub: int, grid: int = 101) -> np.ndarray:
    """Jaccard similarity of one sketch with many, by the joint likelihood of larger, smaller and equal registers."""
    j = np.linspace(0, 1, grid)
    u = (n / (n + n_hub))[:, None]
    v = 1 - u
    p = lambda x: np.clip(-np.log(np.clip(1 - x * (BASE - 1) / BASE, 1e-12, None)) / math.log(BASE), 1e-9, 1)
    up, down = p(np.clip(u - v * j, 0, 1)), p(np.clip(v - u * j, 0, 1))
    more, fewer = (regs > hub).sum(1)[:, None], (regs < hub).sum(1)[:, None]
    like = more * np.log(up) + fewer * np.log(down) + (regs.shape[1] - more - fewer) * np.log(np.clip(1 - up - down, 1e-9, 1))
    like = np.where((u < v * j - 1e-9) | (v < u * j - 1e-9), -np.inf, like)  # no such similarity with these sizes
    return j[like.argmax(1)]


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, key: Key = PLAIN) -> DataFrame:
    """_id, _k (hash of id and text), _n (size of the set), _s1, _s2 (digest of the set, null where it is empty) and _regs, a row per row."""

    def rows(batches):
        for b in batches:
            ids, texts, ks = b.column(0), b.column(1), b.column(2)
            for at, to in slices(texts):
                sets = shingle_sets(texts.slice(at, to - at).to_pylist(), words, key)
                d = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8") if len(s) else (None, None) for s in sets]
                n = pa.array([len(s) for s in sets], pa.int64())
                s1, s2 = (pa.array([None if x[k] is None else int(x[k]) for x in d], pa.int64()) for k in (0, 1))
                regs = pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), ks.slice(at, to - at), n, s1, s2, regs], names=["_id", "_k", "_n", "_s1", "_s2", "_regs"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), F.xxhash64(id_col, text_col).alias("_k")).mapInArrow(tidied(rows), f"_id {kind}, _k long, _n long, _s1 long, _s2 long, _regs binary")


class _Block:
    """Classes of one cluster with their sets, sketches and what they are known to be connected to."""

    def __init__(self, nodes, groups, sets, regs):
        self.nodes, self.n = nodes, np.array([len(s) for s in sets])
        self.regs = np.stack([np.frombuffer(r, "<u2") for r in regs])
        self.at = np.concatenate([[0], np.cumsum(self.n)])[:-1]
        vocabulary, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(vocabulary), bool)
        first: dict = {}
        self.parent = [first.setdefault(g, i) for i, g in enumerate(groups)]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def link(self, hub: int, among: np.ndarray, num: int, den: int) -> list[int]:
        """The members of ``among`` that are linked with ``hub`` and weren't connected with it; they are now."""
        t, spread = num / den, math.sqrt(num / den * (1 - num / den) / REGISTERS)
        # sets of such sizes may be so similar, and about as many registers are equal as they are similar
        n, mine = self.n[among], self.n[hub]
        near = (den * n >= num * mine) & (den * mine >= num * n)
        near &= (self.regs[among] == self.regs[hub]).sum(1) >= REGISTERS * (t - EASY * spread)
        r = self.root(hub)
        other = np.array([i for i in among[near].tolist() if self.root(i) != r], np.int64)
        if not len(other):
            return []
        sure = estimate(self.regs[other], self.n[other], self.regs[hub], mine) >= t - SLACK * spread
        other = other[sure]
        if not len(other):
            return []
        mine = self.flat[self.at[hub] : self.at[hub] + self.n[hub]]
        self.mark[mine] = True
        both = np.array([int(self.mark[self.flat[a : a + k]].sum()) for a, k in zip(self.at[other].tolist(), self.n[other].tolist(), strict=True)])
        self.mark[mine] = False
        out = other[den * both >= num * (self.n[other] + self.n[hub] - both)].tolist()
        for i in out:
            self.parent[self.root(i)] = self.root(hub)
        return out


def _compare(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that connect what isn't connected, from rows of tasks (_task, _node, _group, _ask, _set, _regs).

    In each task every row that asks is compared with all rows of the task that it isn't connected with.
    """

    def work(batches):
        task, held = None, []

        def done():
            if len(held) < 2:
                return []
            nodes, groups, asks, sets, regs = zip(*held, strict=True)
            b = _Block(nodes, groups, [np.frombuffer(s, "<u8") for s in sets], regs)
            every, found = np.arange(len(nodes)), []
            for i in np.flatnonzero(np.array(asks)).tolist():
                found += [(nodes[i], nodes[k]) for k in b.link(i, every, num, den)]
            return found

        def out(links):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for a in range(0, batch.num_rows, 256):  # no batch of sets stands in memory twice
                part = batch.slice(a, 256)
                for t, *row in zip(*(part.column(k).to_pylist() for k in range(6)), strict=True):
                    if t != task:
                        if links := done():
                            yield out(links)
                        task, held = t, []
                    held.append(row)
        if links := done():
            yield out(links)

    ordered = rows.select("_task", "_node", "_group", "_ask", "_set", "_regs").repartition("_task").sortWithinPartitions("_task", "_node")
    return ordered.mapInArrow(tidied(work), "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int, key: Key) -> DataFrame:
    """``wanted`` (_node, _id, _k, _s1, _s2, _regs, _cluster) with _set, the sorted shingles of the class, from the text of one of its rows."""
    rows = docs.select(F.col(id_col).alias("_d"), F.xxhash64(id_col, text_col).alias("_dk"), F.col(text_col).alias("_t"))
    rows = rows.join(wanted, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_dk") == F.col("_k"))).select("_t", "_node", "_cluster", "_regs", "_s1", "_s2")

    def read(batches):
        for b in batches:
            for at, to in slices(b.column(0)):
                part = b.slice(at, to - at)
                sets = shingle_sets(part.column(0).to_pylist(), words, key)
                # two texts of one id may share their 64-bit hash
                digests = zip(part.column(4).to_pylist(), part.column(5).to_pylist(), strict=True)
                same = [len(s) > 0 and tuple(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8").tolist()) == d for s, d in zip(sets, digests, strict=True)]
                got = pa.RecordBatch.from_arrays([part.column(1), part.column(2), part.column(3), pa.array([s.tobytes() for s in sets], pa.binary())], names=["_node", "_cluster", "_regs", "_set"])
                yield got.filter(pa.array(same, pa.bool_()))

    return rows.mapInArrow(tidied(read), "_node long, _cluster long, _regs binary, _set binary").dropDuplicates(["_node"])


def _components(docs: DataFrame, num: int, den: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """_id, _k, _n and component_id, a row per row of ``docs``."""
    spark = docs.sparkSession
    scratch, key = Scratch(spark, "near"), Key()
    rows = scratch.table(sketch(docs, id_col, text_col, words, key), "sketches")
    classes = rows.filter("_s1 IS NOT NULL").groupBy("_s1", "_s2").agg(F.min_by(F.struct("_id", "_k", "_regs"), F.struct(F.col("_id").isNotNull(), "_id", "_k")).alias("_x"))
    # a class is known by its number, which the written table keeps; xxhash64 maps no two longs to one, and what it gives
    # doesn't shrink when it is written, so that sizes of files tell what a broadcast would take
    classes = scratch.table(classes.select(F.xxhash64(F.monotonically_increasing_id()).alias("_node"), "_s1", "_s2", "_x._id", "_x._k", "_x._regs"), "classes")
    bands = F.expr(f"explode(transform(sequence(0, {REGISTERS // ROWS - 1}), i -> xxhash64(i, substring(_regs, i * {2 * ROWS} + 1, {2 * ROWS}))))")
    keys = classes.select("_node", bands.alias("_key"))
    shared = keys.groupBy("_key").agg(F.min("_node").alias("_lo"), F.max("_node").alias("_hi")).filter("_lo <> _hi").select("_key", "_lo")
    hung = keys.join(shared, "_key").filter("_node <> _lo").select(F.col("_lo").alias("a"), F.col("_node").alias("b"))
    cluster = scratch.table(components(hung, scratch, "clusters").select(F.col("node").alias("_node"), F.col("component").alias("_cluster")), "clusters")
    scratch.drop("clusters-0")
    wanted = classes.join(cluster, "_node")
    sets = scratch.table(_sets(docs, wanted, id_col, text_col, words, key), "sets")
    # a block is bounded by the bytes of its sets too: those of long texts take a hundred times what others do
    sizes = sets.groupBy("_cluster").agg(F.count("*").alias("_size"), F.sum(F.octet_length("_set")).alias("_all"))
    sets = sets.join(sizes, "_cluster").withColumn("_blocks", F.when((F.col("_size") <= BLOCK) & (F.col("_all") <= BYTES), 1).otherwise(F.ceil(F.greatest(F.col("_size") / (BLOCK // 2), F.col("_all") / (BYTES // 2)))))
    sets = sets.withColumn("_blocks", F.least("_blocks", "_size")).drop("_all")
    whole = sets.filter("_blocks = 1").select(F.xxhash64("_cluster").alias("_task"), "_node", F.col("_node").alias("_group"), F.lit(True).alias("_ask"), "_set", "_regs", "_cluster")
    # large clusters: blocks by a hash, each with the same few hubs
    large = sets.filter("_blocks > 1")
    block = F.pmod(F.xxhash64("_node", F.lit(1)), F.col("_blocks"))
    hubs = _hubs(large)
    marked = large.join(hubs, ["_cluster", "_node"], "left").withColumn("_hub", F.coalesce("_hub", F.lit(False)))
    sent = marked.withColumn("_b", F.explode(F.when(F.col("_hub"), F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).otherwise(F.array(block))))
    blocks = sent.select(F.xxhash64("_cluster", "_b", F.lit(0)).alias("_task"), "_node", F.col("_node").alias("_group"), F.lit(True).alias("_ask"), "_set", "_regs", "_cluster")
    links = scratch.table(_compare(whole.unionByName(blocks), num, den), "links")
    if not large.isEmpty():
        # what the hubs and blocks have not joined to the largest part of a cluster is compared with all of it
        part = components(links, scratch, "parts").select(F.col("node").alias("_node"), F.col("component").alias("_group"))
        members = large.join(part, "_node", "left").withColumn("_group", F.coalesce("_group", "_node"))
        members = scratch.table(members, "members")
        counts = members.groupBy("_cluster", "_group").agg(F.count("*").alias("_c"))
        main = counts.groupBy("_cluster").agg(F.max_by("_group", F.struct("_c", "_group")).alias("_main"))
        members = members.join(main, "_cluster").withColumn("_ask", F.col("_group") != F.col("_main"))
        asking = members.groupBy("_cluster").agg(F.count_if("_ask").alias("_asking"), F.sum(F.when(F.col("_ask"), F.octet_length("_set"))).alias("_bytes")).filter("_asking > 0")
        asking = asking.select("_cluster", F.least("_asking", F.ceil(F.greatest(F.col("_asking") / (BLOCK // 2), F.col("_bytes") / (BYTES // 2)))).alias("_asks"))
        members = members.join(asking, "_cluster")
        mine = F.pmod(F.xxhash64("_node", F.lit(2)), F.col("_asks"))
        to = lambda i, k, ask: F.struct(F.xxhash64("_cluster", i, k, F.lit(3)).alias("_task"), ask.alias("_ask"))
        asked = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_asks") - 1), lambda i: to(i, block, F.lit(False)))
        asks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1), lambda k: to(mine, k, F.lit(True)))
        every = F.when(F.col("_ask"), F.concat(F.filter(asked, lambda x: x._task != F.xxhash64("_cluster", mine, block, F.lit(3))), asks)).otherwise(asked)
        spread = members.select("_node", "_group", "_set", "_regs", F.explode(every).alias("_x")).select("_x._task", "_node", "_group", "_x._ask", "_set", "_regs")
        links = links.unionByName(scratch.table(_compare(spread, num, den), "late"))
    joined = components(links, scratch, "joined").select(F.col("node").alias("_node"), F.col("component").alias("_c"))
    # the smallest id of a class is its row's here; so the first of a component is found among classes, not among rows
    named = classes.select("_node", "_s1", "_s2", F.struct(F.col("_id").isNotNull().alias("there"), F.col("_id").alias("id")).alias("_x")).join(joined, "_node", "left").withColumn("_c", F.coalesce("_c", "_node"))
    first = named.groupBy("_c").agg(F.min("_x").alias("_first"))
    named = scratch.table(named.join(first, "_c").select("_s1", "_s2", F.col("_first.id").alias("_first"), F.lit(True).alias("_found")), "named")
    scratch.keep("sketches", "named")
    out = rows.join(named, ["_s1", "_s2"], "left")
    return out.select("_id", "_k", "_n", F.when(F.col("_found"), F.col("_first")).otherwise(F.col("_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of ``docs``.

    Documents are linked where den * |intersection| >= num * |union| of their shingle sets; component_id is the smallest
    id that links reach, kept tells whether it is the row's own. Candidates share a band of registers: a pair at 0.85
    is missed with a chance of 2e-8, one at 0.8 with 1e-6, before other paths between them.

    No words or no text: an empty set, linked with nothing, kept. A null id stands before all others. Repeated ids: each
    row is its own, and rows that share component and id are all kept. Very long texts are read whole. Other columns,
    whatever their names, are ignored. Empty table: no rows.
    """
    out = _components(docs, num, den, words, id_col, text_col)
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _hubs(large: DataFrame) -> DataFrame:
    """HUBS classes of each large cluster, those of the smallest hashes, by the share that a cluster's size tells."""
    drawn = large.filter(F.pmod(F.xxhash64("_node"), F.greatest(F.lit(1), F.floor(F.col("_size") / HUBS))) == 0)
    return drawn.select("_cluster", "_node", F.lit(True).alias("_hub"))


def drop_near_duplicates(docs: DataFrame, num: int = 80, den: int = 100, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component those of its smallest id. Rows of one id are told apart by their texts."""
    gone = _components(docs, num, den, words, id_col, text_col).filter(~F.col("_id").eqNullSafe(F.col("component_id"))).select("_id", "_k").distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[id_col], docs[text_col]) == gone["_k"]), "left_anti")
