"""Repeated passages by longest previous factors: every byte under a repeated string of a given length is found, and removed.

A string of ``length`` bytes is repeated only if the k-byte window in it of the smallest hash (its anchor, the first of
equal ones) is repeated too, at the same distance. So each string belongs to one anchor, and the strings of an anchor in
a row are one context. Where equal anchors have equal contexts all of it is repeated. Of the rest, one copy of each
distinct context is taken: sorted by what follows their anchor, contexts stand in suffix order; one byte further to the
left at a time, the order is kept up by stable partition. In it, the previous and the next context of a smaller place
give the longest previous factor of each suffix, those of a larger place the longest following one.

Contexts of one anchor are sorted together. Where they are too many for a task, they are split by what is common to a
half of their strings, again and again; the parts are solved alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, slices, tidied
from tickforge.llm.hashing import PLAIN, Key, blocks, spans, windows

LENGTH, GRAM = 200, 40
#: Bytes that are hashed at once, contexts that are sorted at once (a group may make it twice as many), and contexts of a group that a task holds.
CHUNK, SORTED, GROUP = 1 << 20, 1 << 14, 1 << 16
_AT = np.uint64((1 << 22) - 1)  # a place within a chunk
_NONE = b"\xff"  # no byte of UTF-8


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every window of w, from running minima within blocks of w to either side."""
    n = len(x) - w + 1
    pad = np.full(-(-len(x) // w) * w, x[-1], x.dtype)
    pad[: len(x)] = x
    pad = pad.reshape(-1, w)
    right = np.minimum.accumulate(pad, axis=1).ravel()
    left = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[w - 1 : w - 1 + n])


def anchors(b: np.ndarray, docs: np.ndarray, ranges: np.ndarray, length: int, gram: int, key: Key = PLAIN) -> tuple[np.ndarray, ...]:
    """Document number, place, hash and context hash of the anchors, and how far before them their first and last string begin.

    ``docs``: where documents begin and end in b; ``ranges``: those in which strings may begin, apart from each other.
    """
    if len(b) < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64, np.int64))
    g, at = blocks(b, key), np.arange(len(b) - gram + 1)
    h = windows(g, gram, key)
    least = _least((h & ~_AT) | at.astype(np.uint64), length - gram + 1)
    a = (least & _AT).astype(np.int64)
    ok = np.zeros(len(a) + 1, np.int64)
    lo, hi = np.clip(ranges[:, 0], 0, len(a)), np.clip(ranges[:, 1], 0, len(a))
    np.add.at(ok, lo[hi > lo], 1)
    np.add.at(ok, hi[hi > lo], -1)
    ok = np.concatenate([[False], np.cumsum(ok)[:-1] > 0, [False]])
    new = np.concatenate([[True], a[1:] != a[:-1], [True]])
    new[lo[hi > lo]] = True
    first = np.flatnonzero(ok[1:-1] & (new[:-1] | ~ok[:-2]))
    last = np.flatnonzero(ok[1:-1] & (new[1:] | ~ok[2:]))
    a = a[first]
    c = key.turn(spans(g, first, last + length, key) + (a - first).astype(np.uint64))
    return np.searchsorted(docs[:, 0], a, "right") - 1, a, h[a], c, a - first, a - last


def text_anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, key: Key = PLAIN):
    """Blocks (text number, place, hash, context hash, reach of the first and the last string) of whole texts; long texts in parts."""
    group, size = [], 0

    def flush():
        ends = np.cumsum([len(texts[i]) for i in group])
        docs = np.stack([ends - [len(texts[i]) for i in group], ends], 1)
        b = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        d, a, *rest = anchors(b, docs, np.stack([docs[:, 0], docs[:, 1] - length + 1], 1), length, gram, key)
        return np.array(group)[d], a - docs[d, 0], *rest

    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        if len(t) > CHUNK:
            s, n = 0, len(t) - length + 1
            while s < n:
                b = np.frombuffer(t[s : s + CHUNK + length], np.uint8)
                _, a, *rest = got = anchors(b, np.array([[0, len(b)]]), np.array([[0, min(CHUNK, n - s)]]), length, gram, key)
                if s + CHUNK < n:  # strings of the last anchor may go on
                    _, a, *rest = (x[:-1] for x in got)
                    yield np.full(len(a), i), a + s, *rest
                    s += int(got[1][-1] - got[4][-1])
                else:
                    yield np.full(len(a), i), a + s, *rest
                    break
            continue
        if size + len(t) > CHUNK:
            yield flush()
            group, size = [], 0
        group.append(i)
        size += len(t)
    if group:
        yield flush()


def previous_factors(place: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Of each suffix the longest common prefix with one of a smaller place, 0 without; suffixes are in suffix order.

    ``lcp``: common with the suffix before, negative where a new group begins. In each round the suffixes of a larger place
    than both neighbours have their previous and next smaller place beside them; they are judged and taken out.
    """
    best, at, rounds = np.zeros(len(place), lcp.dtype), np.arange(len(place)), 0
    while len(at) and rounds < 64:
        rounds += 1
        after = np.append(lcp[1:], -1)
        up = lcp < 0
        up[1:] |= place[:-1] < place[1:]
        down = after < 0
        down[:-1] |= place[1:] < place[:-1]
        top = up & down
        best[at[top]] = np.maximum(np.maximum(lcp[top], after[top]), 0)
        keep = np.flatnonzero(~top)
        if not len(keep):
            return best
        lcp = np.minimum.reduceat(lcp[: keep[-1] + 1], np.concatenate([[0], keep[:-1] + 1]))
        at, place = at[keep], place[keep]
    # places that rise or fall all along: a stack, once in either direction
    for way in (1, -1):
        stack: list[tuple[int, int]] = []  # place, and the least common prefix since the one below
        common = lcp if way > 0 else np.append(lcp[1:], -1)[::-1]
        for i, p, c in zip(at[::way].tolist(), place[::way].tolist(), common.tolist(), strict=True):
            if c < 0:
                stack.clear()
            while stack and stack[-1][0] > p:
                c = min(c, stack.pop()[1])
            if stack:
                best[i] = max(best[i], c)
            stack.append((p, c))
    return best


def _common(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many first bytes the rows i and j of x have in common."""
    out = np.empty(len(i), np.int32)
    for s in range(0, len(i), 4096):
        other = x[i[s : s + 4096]] != x[j[s : s + 4096]]
        n = other.argmax(1)
        out[s : s + 4096] = np.where(other[np.arange(len(n)), n], n, x.shape[1])
    return out


def _members(part: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the parts stand that the places ``at`` are in."""
    mask = np.zeros(int(part[-1]) + 1, bool)
    mask[part[at]] = True
    return np.flatnonzero(mask[part])


def factors(group: np.ndarray, place: np.ndarray, left: list[bytes], right: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each context, by how far a string begins before the anchor: whether it occurs at a smaller place, and at a larger one.

    ``left``: bytes before the anchor, read backwards; ``right``: from the anchor on. Contexts are sorted by group and right;
    strings that reach beyond a context are not judged.
    """
    n, reach = len(group), length - gram
    x = np.frombuffer(b"".join([r.ljust(length, _NONE) for r in right]), np.uint8).reshape(n, length)
    back = np.frombuffer(b"".join([v.ljust(reach, _NONE) for v in left]), np.uint8).reshape(n, reach)
    most, least = np.array([len(v) for v in left]), length - np.array([len(r) for r in right])
    smaller, larger = np.zeros((n, reach + 1), bool), np.zeros((n, reach + 1), bool)
    before, after = np.zeros(n, np.int32), np.zeros(n, np.int32)
    order = np.arange(n)
    lcp = np.full(n, -1, np.int32)
    if n > 1:
        lcp[1:] = np.where(group[1:] == group[:-1], _common(x, order[:-1], order[1:]), -1)
    changed = np.ones(n, bool)
    for far in range(reach + 1):
        if far and len(order):
            # suffixes one byte longer: those of a group that differ in the new byte part, in the order they have
            byte = back[order, far - 1]
            differ = np.flatnonzero((byte[1:] != byte[:-1]) & (lcp[1:] >= 0)) + 1
            if len(differ):
                part = np.cumsum(lcp < 0) - 1
                some = _members(part, differ)
                key = part[some] * 256 + byte[some]
                by = np.argsort(key, kind="stable")
                order[some], key = order[some][by], key[by]
                lcp[some[0]] = -1
                lcp[some[1:]] = np.where(key[1:] == key[:-1], 0, -1)
                pairs = some[1:][key[1:] == key[:-1]]
                lcp[pairs] = _common(x, order[pairs - 1], order[pairs])
                changed[some] = True
        alone = lcp < 0
        alone[:-1] &= lcp[1:] < 0
        keep = ~alone & (most[order] >= far)
        if not keep.all():
            at = np.flatnonzero(keep)
            if not len(at):
                break
            # a group loses contexts: the least common prefix over the gap
            gap = np.diff(at, prepend=-1) > 1
            lcp = np.minimum.reduceat(lcp[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
            changed = changed[at]
            changed |= gap
            changed[:-1] |= gap[1:]
            changed[-1] |= at[-1] < len(keep) - 1
            order = order[at]
        if changed.any():
            part = np.cumsum(lcp < 0) - 1
            some = _members(part, np.flatnonzero(changed))
            rows = order[some]
            before[rows], after[rows] = previous_factors(place[rows], lcp[some]), previous_factors(-place[rows], lcp[some])
            changed[:] = False
        smaller[order, far], larger[order, far] = before[order] + far >= length, after[order] + far >= length
    judged = (np.arange(reach + 1) >= least[:, None]) & (np.arange(reach + 1) <= most[:, None])
    return smaller & judged, larger & judged


def cover(flags: np.ndarray, length: int) -> list[int]:
    """Begin and end, in turn and from the anchor, of what strings cover that begin as far before it as ``flags`` tells."""
    p = -np.flatnonzero(flags)[::-1]
    if not len(p):
        return []
    cut = np.flatnonzero(np.diff(p) > length)
    return np.stack([p[np.concatenate([[0], cut + 1])], p[np.concatenate([cut, [len(p) - 1]])] + length], 1).ravel().tolist()


def _occurrences(docs: DataFrame, length: int, gram: int, key: Key) -> DataFrame:
    """_id, _k, _a, _h, _c, _most, _least: the anchors of all rows."""

    def rows(batches):
        names = ["_id", "_k", "_a", "_h", "_c", "_most", "_least"]
        for b in batches:
            for at, to in slices(b.column(2)):
                ids, ks, texts = (x.slice(at, to - at) for x in b.columns)
                for i, a, h, c, most, least in text_anchors(texts.to_pylist(), length, gram, key):
                    i = pa.array(i)
                    yield pa.RecordBatch.from_arrays([ids.take(i), ks.take(i), *(pa.array(x.astype(np.int32)) for x in (a,)), pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(most.astype(np.int16)), pa.array(least.astype(np.int16))], names=names)

    return docs.select("_id", "_k", "_t").mapInArrow(tidied(rows), f"_id {dict(docs.dtypes)['_id']}, _k long, _a int, _h long, _c long, _most short, _least short")


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (_g, _c, _n, _at, _most, _least) with _left and _right, once for each copy of the document in _at.

    A row has the anchors of one document, a fraction of its text.
    """
    x = F.struct("_g", "_c", "_n", "_most", "_least", "_at._a")
    lists = wanted.groupBy("_at._id", "_at._k").agg(F.collect_list(x).alias("_x")).withColumnsRenamed({"_id": "_id2", "_k": "_k2"})
    rows = docs.join(lists, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_k") == F.col("_k2"))).select("_id", "_k", "_t", "_x")

    def read(batches):
        names = ["_id", "_k", "_g", "_c", "_n", "_most", "_least", "_a", "_left", "_right"]
        for b in (batch.slice(at, to - at) for batch in batches for at, to in slices(batch.column("_t"))):
            x = b.column("_x")
            owner, y = np.repeat(np.arange(b.num_rows), np.diff(x.offsets.to_numpy())), x.flatten()
            texts, (most, least, a) = b.column("_t").to_pylist(), (y.field(k).to_numpy(zero_copy_only=False) for k in ("_most", "_least", "_a"))
            left, right = [], []
            for i, m, n, p in zip(owner.tolist(), most.tolist(), least.tolist(), a.tolist(), strict=True):
                t = texts[i]
                left.append(t[p - m : p][::-1])
                right.append(t[p : p + length - n])
            i = pa.array(owner)
            yield pa.RecordBatch.from_arrays([b.column(0).take(i), b.column(1).take(i), *(y.field(k) for k in names[2:8]), pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=names)

    return rows.mapInArrow(tidied(read), f"_id {dict(docs.dtypes)['_id']}, _k long, _g long, _c long, _n long, _most short, _least short, _a int, _left binary, _right binary")


def _sorted_factors(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """_g, _c, _earlier and _later (begins and ends, from the anchor) of contexts; the shuffle's sort puts those of a group in suffix order."""

    def done(t: pa.Table) -> pa.RecordBatch:
        g, c = t.column("_g").to_numpy(), t.column("_c").to_numpy()
        by = np.lexsort((c, g))
        new = np.ones(len(by), bool)
        new[by[1:]] = (g[by[1:]] != g[by[:-1]]) | (c[by[1:]] != c[by[:-1]])
        t = t.filter(pa.array(new))
        g, ids = t.column("_g").to_numpy(), t.column("_id").to_pylist()
        rank = {v: k for k, v in enumerate(sorted(set(ids), key=lambda v: (v is not None, v if v is not None else 0)))}
        order = np.lexsort((t.column("_a").to_numpy(), t.column("_k").to_numpy(), np.array([rank[v] for v in ids])))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        smaller, larger = factors(g, place, t.column("_left").to_pylist(), t.column("_right").to_pylist(), length, gram)
        some = np.flatnonzero(smaller.any(1) | larger.any(1))
        lists = (pa.array([cover(f, length) for f in x[some]], pa.list_(pa.int32())) for x in (smaller, larger))
        return pa.RecordBatch.from_arrays([pa.array(g[some]), pa.array(t.column("_c").to_numpy()[some]), *lists], names=["_g", "_c", "_earlier", "_later"])

    def work(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if len(held) >= SORTED:
                g = held.column("_g").to_numpy()
                end = int(np.searchsorted(g, g[-1]))  # the last group may go on
                if end:
                    yield done(held.slice(0, end))
                    held = held.slice(end)
        if held is not None and len(held):
            yield done(held)

    rows = contexts.select("_g", "_c", "_id", "_k", "_a", "_left", "_right").repartition("_g").sortWithinPartitions("_g", "_right")
    return rows.mapInArrow(tidied(work), "_g long, _c long, _earlier array<int>, _later array<int>")


def _large(groups: DataFrame, most: int) -> DataFrame | None:
    """_g of the groups of more than ``most`` rows, None if there are none."""
    out = groups.groupBy("_g").count().filter(F.col("count") > most).select("_g")
    return None if out.isEmpty() else out


def _digest(key: Key, *parts) -> Column:
    """A keyed 64-bit digest of numbers and bytes; ``parts`` must tell where each of them ends."""
    data = F.concat(F.lit(bytearray(key.seed)), *(p if kind == "bytes" else F.concat(F.encode(p.cast("string"), "utf-8"), F.lit(bytearray(b"|"))) for kind, p in parts))
    return F.conv(F.substring(F.sha2(data, 256), 1, 16), 16, -10).cast("long")


def _halves(contexts: DataFrame, length: int, key: Key) -> DataFrame:
    """Contexts with those of their strings that begin in a half of _lo to _hi; of a half, _g2 tells what all its strings have in common, _c2 all of it."""
    mid = "(_lo + _hi) div 2"
    rows = contexts.withColumn("_part", F.expr(f"explode(array(struct(_lo, {mid} as _hi), struct({mid} + 1 as _lo, _hi)))"))
    rows = rows.filter("_part._lo <= _part._hi AND _most >= _part._lo AND _least <= _part._hi")
    rows = rows.withColumns({"_lo": F.expr("cast(_part._lo as int)"), "_hi": F.expr("cast(_part._hi as int)")})
    rows = rows.withColumns({"_most": F.expr("cast(least(_most, _hi) as short)"), "_least": F.expr("cast(greatest(_least, _lo) as short)")})
    rows = rows.withColumns({"_left": F.expr("substring(_left, 1, _most)"), "_right": F.expr(f"substring(_right, 1, {length} - _least)")})
    # the lengths of the byte parts follow from the numbers
    core = _digest(key, *(("number", F.col(c)) for c in ("_g", "_lo", "_hi")), ("bytes", F.expr("substring(_left, 1, _lo)")), ("bytes", F.expr(f"substring(_right, 1, {length} - _hi)")))
    whole = _digest(key, ("number", F.col("_most")), ("number", F.col("_least")), ("bytes", F.col("_left")), ("bytes", F.col("_right")))
    return rows.withColumns({"_g2": core, "_c2": whole}).drop("_part")


def _factors(contexts: DataFrame, large: DataFrame | None, scratch: Scratch, length: int, gram: int, group: int, key: Key, depth: int = 0) -> DataFrame:
    """The same for all contexts, ``large`` (_g) being groups that no task may hold: these are split by halves until they are small.

    Halves of contexts that are equal are one, so that a passage in very many rows is a single context wherever its own
    strings are; one half is at last one string, and a group one context.
    """
    if large is None:
        return _sorted_factors(contexts, length, gram)
    found = _sorted_factors(contexts.join(large, "_g", "left_anti"), length, gram)
    if not depth:
        contexts = contexts.withColumns({"_lo": F.lit(0), "_hi": F.lit(length - gram)})
    halves = _halves(contexts.join(large, "_g", "left_semi"), length, key).withColumn("_place", F.struct(F.col("_id").isNotNull(), "_id", "_k", "_a"))
    halves = scratch.table(halves, f"halves-{depth}")
    same = [F.any_value(c).alias(c) for c in ("_most", "_least", "_lo", "_hi", "_left", "_right")]
    same = halves.groupBy("_g2", "_c2").agg(F.sum("_n").alias("_n"), F.min("_place").alias("_first"), *same).withColumnsRenamed({"_g2": "_g", "_c2": "_c"})
    same = scratch.table(same.withColumns({c: F.col(f"_first.{c}") for c in ("_id", "_k", "_a")}), f"parts-{depth}")
    judged = _factors(same, _large(same, group), scratch, length, gram, group, key, depth + 1)
    judged = same.select("_g", "_c", F.col("_n").alias("_times"), "_first").join(judged, ["_g", "_c"], "left").withColumnsRenamed({"_g": "_g2", "_c": "_c2"})
    whole = F.array(-F.col("_most").cast("int"), F.lit(length) - F.col("_least").cast("int"))
    out = halves.select("_g", "_c", "_g2", "_c2", "_place", "_most", "_least", "_n").join(judged, ["_g2", "_c2"])
    # of equal halves all but the first have an earlier one
    earlier, later = F.when(F.col("_place") != F.col("_first"), whole).otherwise(F.col("_earlier")), F.when(F.col("_times") > F.col("_n"), whole).otherwise(F.col("_later"))
    return found.unionByName(out.groupBy("_g", "_c").agg(F.flatten(F.collect_list(earlier)).alias("_earlier"), F.flatten(F.collect_list(later)).alias("_later")))


def find_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, keep_first: bool = False, group: int = GROUP) -> DataFrame:
    """_id, _k and _spans (begins and ends, in turn) of what is repeated in each row of docs (_id, _k, _t)."""
    if gram < 8 or gram > length:
        raise ValueError("anchors have 8 bytes at least, and no more than the strings")
    key = Key()
    found = scratch.table(_occurrences(docs, length, gram, key), "anchors")
    again = found.groupBy("_h").agg(F.count("*").alias("_m"), F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).filter("_m > 1").select("_h", (F.col("_lo") != F.col("_hi")).alias("_mixed"))
    again = scratch.table(again, "again")  # joins of written tables can be split where an anchor has very many places
    found = scratch.table(found.join(again, "_h"), "repeated")
    scratch.drop("anchors")
    scratch.drop("again")
    place = F.struct(F.col("_id").isNotNull(), "_id", "_k", "_a")
    same = [F.any_value(c).alias(c) for c in ("_mixed", "_most", "_least")]
    classes = scratch.table(found.groupBy("_h", "_c").agg(F.count("*").alias("_n"), F.min(place).alias("_at"), *same), "classes")
    mixed = classes.filter("_mixed").withColumnRenamed("_h", "_g")
    if not keep_first:  # where every context has a copy, all is repeated
        mixed = mixed.join(mixed.filter("_n = 1").select("_g").distinct(), "_g", "left_semi")
    large = _large(mixed, group)
    contexts = _contexts(docs, mixed, length)
    contexts = contexts if large is None else scratch.table(contexts.dropDuplicates(["_g", "_c"]), "contexts")
    parts = scratch.table(_factors(contexts, large, scratch, length, gram, group, key), "factors").withColumnRenamed("_g", "_h")
    whole, none = F.array(-F.col("_most").cast("int"), F.lit(length) - F.col("_least").cast("int")), F.array().cast("array<int>")
    some = F.coalesce("_earlier", none) if keep_first else F.concat(F.coalesce("_earlier", none), F.coalesce("_later", none))
    judged = classes.join(parts, ["_h", "_c"], "left").select("_h", "_c", "_n", "_at", whole.alias("_whole"), some.alias("_some")).filter("_n > 1 OR size(_some) > 0")
    judged = scratch.table(judged, "judged")
    scratch.keep("repeated", "judged")
    full = (place != F.col("_at")) if keep_first else (F.col("_n") > 1)
    hit = found.select("_h", "_c", "_id", "_k", "_a").join(judged, ["_h", "_c"]).select("_id", "_k", F.transform(F.when(full, F.col("_whole")).otherwise(F.col("_some")), lambda x: x + F.col("_a")).alias("_x"))
    return hit.groupBy("_id", "_k").agg(F.flatten(F.collect_list("_x")).alias("_spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (begins and ends in bytes) and kept (the bytes left), a row per row.

    Texts are UTF-8 bytes. Removed is each byte under a string of ``length`` bytes that starts at another place of any row
    (its own included), or with ``keep_first`` at an earlier one by id and place. Strings are judged on the input.

    Null text: no bytes. Texts of fewer than ``length`` bytes lose nothing; long ones are read in parts, with the same
    result. A null id comes before all others. Rows of the same id are told apart by a hash of their text; rows equal in both
    are two places, and with ``keep_first`` both count as the first. Other columns, whatever their names, are ignored. Empty
    table: no rows.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    base = docs.select(F.col(id_col).alias("_id"), F.xxhash64(id_col, text_col).alias("_k"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_t"))
    hits = find_repeats(base, scratch, length, gram, keep_first, group).withColumnsRenamed({"_id": "_id2", "_k": "_k2"})
    rows = base.join(hits, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_k") == F.col("_k2")), "left").select("_id", "_t", "_spans")

    def cut(batches):
        for b in (batch.slice(at, to - at) for batch in batches for at, to in slices(batch.column(1))):
            out = []
            for d, t, x in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                x = np.array(x or [], np.int64)
                s, e = x[::2], x[1::2]
                order = np.argsort(s, kind="stable")
                s, e = s[order], np.maximum.accumulate(e[order]) if len(e) else e
                new = np.flatnonzero(s[1:] > e[:-1]) + 1 if len(s) else np.empty(0, np.int64)
                begins, ends = (s[np.concatenate([[0], new])], e[np.concatenate([new - 1, [len(e) - 1]])]) if len(s) else (s, e)
                left, at = [], 0
                for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
                    left.append(t[at:i])
                    at = j
                kept = b"".join([*left, t[at:]])
                out.append((d, len(t), len(t) - len(kept), len(begins), np.stack([begins, ends], 1).ravel().tolist(), kept))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = (b.column(0).type, *[pa.int64()] * 3, pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return rows.mapInArrow(tidied(cut), f"doc_id {dict(base.dtypes)['_id']}, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary")
