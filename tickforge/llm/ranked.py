"""Ranked lexical search by sort-based accumulation.

Texts are read once, into the counts of those terms that items ask for. A task takes the counts of some documents, puts
the (item, document, impact) of all their terms in a row, radix-sorts the packed items and documents, and adds up equal
ones. Of each item it keeps a heap of its best documents, whatever their number; the heaps of all tasks are dealt by
ranges of items and cut again.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import FOLD_BYTES, Scratch, tidied, values
from tickforge.llm.manifest import numbered

BEST = 50
#: Terms (and bytes of them) that a task holds to pick what is asked for; beyond, all terms are counted and joined.
TERMS, TERM_BYTES = 200_000, 4 << 20
#: Terms of items that a task scores with at once, entries that it sorts at once, and bytes of text that it splits at once.
PAIRS, ENTRIES, CHUNK = 500_000, 1 << 20, 1 << 20
#: Bytes of terms as they are, A-Z in lower case, and a blank for all others.
_TERM = bytes(FOLD_BYTES[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def term_counts(text: str | None) -> Counter:
    """The terms of a text, in UTF-8, with how often each occurs. A long text is split in parts, between terms."""
    data, out, at = (text or "").encode().translate(_TERM), Counter(), 0
    while at < len(data):
        cut = data.find(b" ", at + CHUNK) if len(data) - at > CHUNK else -1
        cut = len(data) if cut < 0 else cut
        out.update(data[at:cut].split())
        at = cut
    return out


def radix_order(keys: np.ndarray, bits: int) -> np.ndarray:
    """What sorts keys of so many bits, 16 of them at a time, the lowest first; numpy sorts 16-bit numbers by their digits."""
    order = np.argsort((keys & np.uint64(0xFFFF)).astype(np.uint16), kind="stable")
    for shift in range(16, bits, 16):
        digit = ((keys[order] >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
    return order


def accumulate(items: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int, n_items: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items, documents and the sums of their impacts, in that order."""
    if not len(items):
        return items, docs, impacts
    low = max(1, (n_docs - 1).bit_length())
    keys = (items.astype(np.uint64) << np.uint64(low)) | docs.astype(np.uint64)
    order = radix_order(keys, low + max(1, (n_items - 1).bit_length()))
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[at] >> np.uint64(low)).astype(np.int64), (keys[at] & np.uint64((1 << low) - 1)).astype(np.int64), np.add.reduceat(impacts[order], at)


class _Late:
    """A document id that is less than those before it, so that a heap's least entry is the worst; a null is before all."""

    __slots__ = ("id", "key")

    def __init__(self, id):
        self.id, self.key = id, (id is not None, id if id is not None else 0)

    def __lt__(self, other):
        return self.key > other.key

    def __eq__(self, other):
        return self.key == other.key


class Heaps:
    """The best k documents of each item."""

    def __init__(self, n: int, k: int):
        self.k, self.of, self.least = k, [[] for _ in range(n)], np.zeros(n, np.int64)

    def take(self, items: np.ndarray, docs: np.ndarray, scores: np.ndarray, ids: list) -> None:
        """Scores of documents, which stand by id; what can't be among the best any more is left out at once."""
        some = (scores > 0) & (scores >= self.least[items])
        items, docs, scores = items[some], docs[some], scores[some]
        order = np.lexsort((docs, -scores, items))
        items, docs, scores = items[order], docs[order], scores[order]
        begins = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else items
        rank = np.arange(len(items)) - np.repeat(begins, np.diff(np.append(begins, len(items))))
        first = rank < self.k
        for q, d, s in zip(items[first].tolist(), docs[first].tolist(), scores[first].tolist(), strict=True):
            heap = self.of[q]
            if len(heap) < self.k:
                heapq.heappush(heap, (s, _Late(ids[d])))
            else:
                heapq.heappushpop(heap, (s, _Late(ids[d])))
            if len(heap) == self.k:
                self.least[q] = heap[0][0]


def _counted(docs: DataFrame, known: dict[bytes, int] | None) -> DataFrame:
    """_id, _row, _n (all terms) and the counts of the terms in ``known``, by number, else of all terms: _t and _f."""
    kind = pa.int64() if known is not None else pa.binary()

    def rows(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n, t, f = [], [], []
                for text in values(part.column(2)):
                    c = term_counts(text)
                    n.append(c.total())
                    hit = list(c.keys() & known.keys() if known is not None else c)
                    t.append([known[x] for x in hit] if known is not None else hit)
                    f.append([c[x] for x in hit])
                lists = [pa.array(t, pa.list_(kind)), pa.array(f, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), *lists], names=["_id", "_row", "_n", "_t", "_f"])

    return docs.mapInArrow(tidied(rows), f"_id {dict(docs.dtypes)['_id']}, _row long, _n long, _t array<{'long' if known is not None else 'binary'}>, _f array<long>")


def _frequencies(counts: DataFrame) -> DataFrame:
    """_tid and _df, in how many documents it is."""

    def rows(batches):
        for b in batches:
            t, n = np.unique(b.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(n, pa.int64())], names=["_tid", "_df"])

    return counts.select("_t").mapInArrow(rows, "_tid long, _df long").groupBy("_tid").agg(F.sum("_df").alias("_df"))


def _best(counts: DataFrame, pairs: pa.Table, total: int, length: int, k: int) -> DataFrame:
    """_q, _id and _score of each task's best documents for the items of ``pairs`` (_q, _tid, _w)."""
    q, tid, w = (pairs.column(c).to_numpy() for c in ("_q", "_tid", "_w"))
    by = np.argsort(tid, kind="stable")
    names, item = np.unique(q, return_inverse=True)
    terms, first = np.unique(tid[by], return_index=True)
    item, weight, ends = item[by].astype(np.int64), w[by][first], np.append(first, len(by))
    kind = dict(counts.dtypes)["_id"]

    def rows(batches):
        heaps, id_type = Heaps(len(names), k), None
        for b in batches:
            id_type = b.column(0).type
            ids = b.column(0).to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0)), np.int64)
            b, ids = b.take(pa.array(order)), [ids[i] for i in order]
            lists = b.column(2)
            at = lists.offsets.to_numpy()
            t, f = lists.flatten().to_numpy(zero_copy_only=False), b.column(3).flatten().to_numpy(zero_copy_only=False)
            at = at - at[0]
            doc = np.repeat(np.arange(len(ids)), np.diff(at))
            n = b.column(1).to_numpy()
            m = 50 + (50 * n * total) // max(1, length)
            place = np.minimum(np.searchsorted(terms, t), len(terms) - 1)
            hit = terms[place] == t
            place, f, doc = place[hit], f[hit], doc[hit]
            impact = weight[place] * ((1_000_000_000 * f) // (1000 * f + 20 * m[doc]))
            many = ends[place + 1] - ends[place]
            upto = np.cumsum(many)
            a = 0
            while a < len(place):  # as many documents at once as have no more than ENTRIES, one at least
                z = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + ENTRIES, "right"))
                if z < len(place):
                    z = int(np.searchsorted(doc, doc[z])) if doc[z] != doc[a] else int(np.searchsorted(doc, doc[a], "right"))
                size = many[a:z]
                inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                got = accumulate(item[np.repeat(ends[place[a:z]], size) + inside], np.repeat(doc[a:z] - doc[a], size), np.repeat(impact[a:z], size), int(doc[z - 1] - doc[a]) + 1, len(names))
                heaps.take(got[0], got[1] + doc[a], got[2], ids)
                a = z
        if id_type is not None:
            found = [(int(names[i]), x.id, s) for i, heap in enumerate(heaps.of) for s, x in heap]
            for a in range(0, len(found), 10_000):
                cols = list(zip(*found[a : a + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], id_type), pa.array(cols[2], pa.int64())], names=["_q", "_id", "_score"])

    return counts.select("_id", "_n", "_t", "_f").mapInArrow(tidied(rows), f"_q long, _id {kind}, _score long")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item id, rank, doc id and score: of each row of ``items`` the k rows of ``docs`` of the highest score above 0, equal scores by id.

    Terms are runs of ASCII letters (A-Z in lower case), digits and characters beyond ASCII. Of N documents with a term and L terms in
    all of them, one with n terms has m = 50 + (50 * n * N) div L. A term in df documents weighs w = floor(1000 * ln((2N + 2) / (2df + 1))).
    A score is the sum of w * ((10^9 * tf) div (1000 * tf + 20 * m)) over the item's terms, once each.

    Null, empty and blank texts have no term and are found by none; such items find none. Very long texts are read whole, in
    parts. Repeated ids: each row is its own and may stand beside others of its id. Null ids come before all others. Other
    columns, whatever their names, are ignored. Empty tables: no rows. Ids may be of any type that has an order.

    The vocabulary of the items is sent to tasks up to TERMS; a larger one is joined with the counts of all terms. Items are
    scored in blocks of PAIRS terms and items, each of which reads the counts, never the texts, once more.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked")

    def read_items(batches):
        for b in batches:
            t = [list(term_counts(x)) for x in values(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(t, pa.list_(pa.binary()))], names=["_q", "_item", "_terms"])

    asked = items.select(F.monotonically_increasing_id().alias("_q"), F.col(item_col).alias("_item"), F.col(item_text_col).alias("_x"))
    asked = scratch.table(asked.mapInArrow(read_items, f"_q long, _item {dict(asked.dtypes)['_item']}, _terms array<binary>"), "items")
    wanted = asked.select("_q", F.explode("_terms").alias("_term"))
    terms = scratch.table(wanted.select("_term").distinct().select(F.monotonically_increasing_id().alias("_tid"), "_term"), "terms")
    n_terms, n_bytes = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_term")), F.lit(0))).first()
    rows = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_x"))
    if n_terms <= TERMS and n_bytes <= TERM_BYTES:
        counts = scratch.table(_counted(rows, {bytes(r["_term"]): r["_tid"] for r in terms.collect()}), "counts")
        found = counts
    else:
        counts = scratch.table(_counted(rows, None), "all")
        each = counts.select("_row", "_id", "_n", F.explode(F.arrays_zip("_t", "_f")).alias("_x")).select("_row", "_id", "_n", "_x._t", "_x._f")
        each = each.join(terms, F.col("_t") == F.col("_term")).groupBy("_row").agg(F.any_value("_id").alias("_id"), F.any_value("_n").alias("_n"), F.collect_list(F.struct("_tid", "_f")).alias("_x"))
        found = scratch.table(each.select("_id", "_n", F.col("_x._tid").alias("_t"), F.col("_x._f").alias("_f")), "counts")
    total, length = counts.agg(F.count_if(F.col("_n") > 0), F.coalesce(F.sum("_n"), F.lit(0))).first()
    weighed = _frequencies(found).select("_tid", F.floor(1000 * F.log(F.lit(2.0 * total + 2) / (2 * F.col("_df") + 1))).cast("long").alias("_w"))
    pairs = scratch.table(wanted.join(terms, "_term").join(weighed, "_tid").select("_q", "_tid", "_w"), "pairs")
    n_pairs = pairs.count()
    if n_pairs <= PAIRS:
        blocks, n_blocks = pairs.withColumn("_block", F.lit(0)), 1
    else:  # an item is in the block in which its first term is, so that a block has a single item's terms more at most
        each = numbered(pairs.withColumn("_g", F.lit(None).cast("string")), [F.col("_q")], scratch, "placed")
        first = each.groupBy("_q").agg(F.expr(f"cast(min(_i) div {PAIRS} as int)").alias("_block"))
        blocks, n_blocks = scratch.table(pairs.join(first, "_q"), "blocks"), -(-n_pairs // PAIRS)
    best = None
    for i in range(n_blocks):
        block = blocks.filter(F.col("_block") == i).select("_q", "_tid", "_w").toArrow()
        if block.num_rows:
            some = _best(found, block, total, length, k)
            best = some if best is None else best.unionByName(some)
    if best is None:
        best = found.select(F.lit(0).cast("long").alias("_q"), "_id", F.lit(0).cast("long").alias("_score")).limit(0)
    best = best.repartitionByRange("_q")
    rank = F.row_number().over(Window.partitionBy("_q").orderBy(F.col("_score").desc(), F.col("_id").asc_nulls_first()))
    best = best.withColumn("rank", rank).filter(F.col("rank") <= k).join(asked.select("_q", "_item"), "_q")
    return best.select(F.col("_item").alias(item_col), "rank", F.col("_id").alias(id_col), F.col("_score").alias("score"))
