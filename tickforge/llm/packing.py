"""Best-fit packing of tokenized documents into sequences of bounded length.

The lengths are counted; the configuration linear program over the histogram, in groups of lengths of equal volume, is
solved by multiplicative weights, with a knapsack dynamic program that prices configurations by the dual prices of the
groups and gives a lower bound in each round. A share of the solution is rounded down to whole sequences, filled with
lengths that add up to the capacity; best fit places the rest. The plan holds configurations with how often each is
used, so its size depends on the capacity and not on the input. Pieces are dealt to the plan by their rank among pieces
of their length.
"""

from __future__ import annotations

import logging
import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, tidied, values

_LOG = logging.getLogger(__name__)
CAPACITY, END_ID = 4096, 1
#: Groups of lengths in the linear program, rounds at most, gap to the bound at which they end, rate of the weights, the part
#: of what its scarcest group still has that a round takes, and the share of the solution that is rounded to sequences.
GROUPS, ROUNDS, GAP, RATE, STEP, SHARE = 128, 1500, 0.05, 5.0, 0.3, 0.8
#: Pieces of one length that are ranked together.
ROWS_PER_SALT = 1000


def cut(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of tokenized documents: doc_id, piece, start, length, ids_crc32 and, on demand, ids.

    A document is the ids of its text, then ``end_id``; one of more than ``capacity`` ids is cut into pieces of that many,
    of which the last may be shorter. Null or empty text: ``end_id`` alone. Rows aren't merged: repeated ids give
    repeated pieces.
    """
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches):
        from tickforge.llm.tokens import encoder

        e, size = encoder(tokenizer_path), 4 * capacity
        for b in batches:
            ids, piece, start, length, crc, raw = [], [], [], [], [], []
            for d, t in zip(b.column(0).to_pylist(), values(b.column(1)), strict=True):
                x = e.encode(t or b"") + end
                for k in range(0, len(x), size):
                    part = x[k : k + size]
                    ids.append(d), piece.append(k // size), start.append(k // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if with_ids:
                        raw.append(np.frombuffer(part, "<u4").astype(np.int32))
            out = [pa.array(ids, b.column(0).type), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(out + [pa.array(raw, pa.list_(pa.int32()))] * with_ids, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
        e.close()

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(tidied(pieces), schema)


def price(value: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable configuration: how many items of each size fit ``capacity`` together; ``value`` is that of an item."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for k, size in enumerate(sizes.tolist()):
        for c in range(size, capacity + 1, size):
            end = min(c + size, capacity + 1)
            got = best[c - size : end - size] + value[k]
            up = got > best[c:end] * (1 + 1e-12)
            best[c:end][up], take[c:end][up] = got[up], k
    out, c = np.zeros(len(sizes), np.int64), int(best.argmax())
    while take[c] >= 0:
        out[take[c]] += 1
        c -= int(sizes[take[c]])
    return out


def length_groups(count: np.ndarray, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """The largest length and the number of items of groups of lengths, each of about the same volume."""
    lengths = np.flatnonzero(count)
    if not len(lengths):
        return lengths, lengths
    volume = np.cumsum(count[lengths] * lengths).astype(float)
    k = np.minimum(((volume - 1) / volume[-1] * groups).astype(int), groups - 1)
    last = np.flatnonzero(np.append(k[1:] != k[:-1], True))
    return lengths[last], np.diff(np.cumsum(count[lengths])[last], prepend=0)


@dataclass
class Solution:
    """Configurations (items of each size) with how often to use each, how many sequences that is, and the dual bound."""

    uses: dict[tuple[int, ...], float]
    value: float
    bound: float


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS, gap: float = GAP) -> Solution:
    """The covering program min sum(x) with items of each size at least ``demand``, by multiplicative weights.

    A size's weight starts with its volume and falls exponentially with its relative coverage; weight by demand is its dual
    price. Prices over the value of the best configuration are feasible in the dual, which bounds the optimum from below.
    """
    x: dict[tuple[int, ...], float] = defaultdict(float)
    d, covered, total, bound, least = demand.astype(float), np.zeros(len(sizes)), 0.0, 0.0, 0.0
    for _ in range(rounds if len(sizes) else 0):
        ratio = covered / d
        y = sizes * np.exp(RATE * (ratio.min() - ratio))
        a = price(y, sizes, capacity)
        bound = max(bound, float(d @ y) / float(a @ y))
        use = STEP * float((d[a > 0] / a[a > 0]).min())
        x[tuple(a.tolist())] += use
        covered, total = covered + a * use, total + use
        least = float((covered / d).min())
        if least > 0 and total <= (1 + gap) * bound * least:
            break
    if least <= 0:
        return Solution({}, 0.0 if not len(sizes) else float("inf"), bound)
    return Solution({c: u / least for c, u in x.items()}, total / least, bound)


def _fill(items: list[tuple[int, int]], rest: np.ndarray, capacity: int) -> dict[int, int] | None:
    """Lengths (and copies) for a configuration: one of each range (over, up to), the last two so that they fill what is left, if any do."""
    inside: dict[int, int] = defaultdict(int)
    room, free = capacity, rest

    def longest(lo: int, hi: int) -> bool:
        nonlocal room, free
        at = np.flatnonzero(free[lo + 1 : min(hi, room) + 1])
        if not len(at):
            return False
        n = int(at[-1]) + lo + 1
        free = free.copy() if free is rest else free
        free[n] -= 1
        inside[n] += 1
        room -= n
        return True

    for lo, hi in items[:-2]:
        if not longest(lo, hi):
            return None
    if len(items) > 1:
        lo, hi = items[-2]
        n = np.arange(min(hi, room - 1), lo, -1)
        n = n[(free[n] > 0) & (free[room - n] > (n == room - n))]
        if len(n):
            for k in (int(n[0]), room - int(n[0])):
                inside[k] += 1
            return inside
        if not longest(lo, hi):
            return None
    return inside if longest(0, capacity) else None


def _best_fit(count: np.ndarray, capacity: int, groups: list[tuple[int, int, tuple]]) -> list[tuple[int, int, tuple]]:
    """Place ``count[l]`` items of each length l, longest first, each where least room is left over.

    ``groups``: (room, sequences, contents) with contents ((length, copies), ...). Sequences alike move as one group.
    """
    rooms: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
    has = np.zeros(capacity + 1, bool)
    for room, m, inside in groups:
        rooms[room].append((m, inside))
        has[room] = True
    for length in np.flatnonzero(count)[::-1].tolist():
        n = int(count[length])
        while n:
            at = length + int(has[length:].argmax()) if has[length:].any() else -1
            if at < 0:
                k = capacity // length
                if n >= k:
                    new, per = n // k, k
                else:
                    new, per = 1, n
                room = capacity - per * length
                rooms[room].append((new, ((length, per),)))
                has[room] = True
                n -= new * per
                continue
            m, inside = rooms[at].pop()
            per = min(at // length, n)
            used = min(m, n // per)
            if used < m:
                rooms[at].append((m - used, inside))
            has[at] = bool(rooms[at])
            rooms[at - per * length].append((used, (*inside, (length, per))))
            has[at - per * length] = True
            n -= used * per
    return [(room, m, inside) for room, g in rooms.items() for m, inside in g]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, share: float = SHARE) -> list[tuple[int, tuple]]:
    """(sequences, ((length, copies), ...)) that place every item of the histogram."""
    rest = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        rest[length] = n
    sizes, demand = length_groups(rest, groups)
    found = solve(sizes, demand, capacity)
    over, packed = [0, *sizes[:-1].tolist()], []
    for config, use in sorted(found.uses.items(), key=lambda x: (-x[1], x[0])):
        m = int(use * share)
        items = [(over[k], int(sizes[k])) for k in range(len(sizes) - 1, -1, -1) for _ in range(config[k])]
        while m > 0 and (inside := _fill(items, rest, capacity)):
            times = min(m, *(int(rest[n]) // a for n, a in inside.items()))
            for n, a in inside.items():
                rest[n] -= a * times
            packed.append((capacity - sum(n * a for n, a in inside.items()), times, tuple(inside.items())))
            m -= times
    _LOG.info("linear program: %.1f sequences, at least %.1f; %d of its sequences are used", found.value, found.bound, sum(m for _, m, _ in packed))
    return [(m, inside) for _, m, inside in _best_fit(rest, capacity, packed) if m]


def ranges(configs: list[tuple[int, tuple]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, copies a sequence, first sequence, offset of the first copy), by rank."""
    out: dict[int, list] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for m, inside in configs:
        offset = 0
        for length, a in inside:
            out[length].append((taken[length], a, sequence, offset))
            taken[length] += a * m
            offset += a * length
        sequence += m
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset: each sequence is gapless and at most ``capacity`` long.

    ``pieces`` is read three times: give a written table. No pieces: no rows. At most ``capacity`` rows of counts come
    to the driver.
    """
    counts = pieces.groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in counts.collect()}
    spans = ranges(plan(histogram, capacity))
    salts = pieces.sparkSession.createDataFrame([(n, -(-c // ROWS_PER_SALT)) for n, c in histogram.items()] or [(0, 1)], "length long, _salts long")
    dealt = pieces.join(F.broadcast(salts), "length")  # at most `capacity` rows
    dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), "_salts")).drop("_salts")
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    before = dealt.groupBy("length", "_salt").count()
    before = before.select("length", "_salt", (F.sum("count").over(Window.partitionBy("length").orderBy("_salt")) - F.col("count")).alias("_before"))
    ranked = dealt.withColumn("_k", F.row_number().over(order)).join(before, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_k") - 1 + F.col("_before")).drop("_k", "_before", "_salt")
    names = pieces.columns

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if not len(part):
                    continue
                s, n = spans[int(length[part[0]])], int(length[part[0]])
                row = s[np.searchsorted(s[:, 0], rank[part], "right") - 1]
                k = rank[part] - row[:, 0]
                seq[part], off[part] = row[:, 2] + k // row[:, 1], row[:, 3] + k % row[:, 1] * n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.select(*names, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Cut and pack documents; pieces go through a table in the shared folder, so that nothing is tokenized twice."""
    pieces = Scratch(docs.sparkSession, "packing").table(cut(docs, tokenizer_path, capacity, end_id, with_ids), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each packed sequence, from pieces packed ``with_ids``. A sequence has at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_p")).select("sequence_id", F.expr("flatten(transform(_p, p -> p.ids))").alias("ids"))
