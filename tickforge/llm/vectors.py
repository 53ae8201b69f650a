"""Near-duplicate vectors by randomised-rotation binary codes.

A vector is rotated at random, padded to more dimensions, and of every coordinate only the sign is kept: its code. The
code's own product with the vector is stored as a correction factor, which makes the estimate of its product with any
other vector unbiased, with a known spread. Signs of other random directions are keys of several tables: vectors that share a key of
a table meet there, in blocks of bounded size. Estimates with their confidence bounds decide which pairs are computed
anew, exactly and in double precision; a pair is looked at in the first table only in which it meets. Tasks give counts
of links and the links that span what is connected, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, tidied
from tickforge.llm.graph import components

#: Dimensions of a code at least, chance to miss a pair right at the threshold, and deviations of an estimate.
BITS, MISS, DEVIATIONS = 256, 1e-6, 5.0
#: Vectors of a key on average, and of a key in one block at most.
MEET, BLOCK = 256, 1024


@cache
def rotation(dim: int, bits: int) -> np.ndarray:
    """The rows of a random rotation that vectors padded with zeros meet: dim x bits, the same in every task."""
    g = np.random.default_rng([1, dim, bits]).standard_normal((bits, bits))
    q, r = np.linalg.qr(g)
    return np.ascontiguousarray((q * np.sign(np.diag(r)))[:dim])


@cache
def directions(dim: int, n: int) -> np.ndarray:
    return np.random.default_rng([2, dim, n]).standard_normal((dim, n))


def code_bits(dim: int) -> int:
    return max(BITS, -(-dim // 64) * 64)


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed signs of the rotated coordinates) of unit vectors, and their correction factors, the product with the vector."""
    bits = code_bits(unit.shape[1])
    turned = unit @ rotation(unit.shape[1], bits)
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / math.sqrt(bits)


def estimates(codes: np.ndarray, factors: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated products of coded vectors (rows) with others (columns), without bias, and the deviation of each row's."""
    bits = code_bits(unit.shape[1])
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    turned = (unit @ rotation(unit.shape[1], bits)).astype(np.float32)
    got = (signs @ turned.T) / (math.sqrt(bits) * factors[:, None]).astype(np.float32)
    return got, np.sqrt(np.maximum(0, 1 - factors**2) / (bits - 1)) / factors


def plan(n: int, least: float) -> tuple[int, int]:
    """Bits of a key and tables, so that about MEET vectors share a key and a pair right at ``least`` is missed with a chance of MISS."""
    k = min(60, max(1, math.ceil(math.log2(max(2, n) / MEET))))
    same = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    return k, max(1, math.ceil(math.log(MISS) / math.log1p(-min(1 - 1e-12, same**k))))


def keys(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """The key of each vector in each table, from the signs of k directions of the table's own."""
    side = (unit @ directions(unit.shape[1], k * tables) >= 0).reshape(len(unit), tables, k)
    return side @ (1 << np.arange(k, dtype=np.int64))


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors by a power of two, which changes no cosine, so that no square is too large or lost."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _read(rows: DataFrame, kind: str) -> DataFrame:
    """_id, _dim, _x (components, as ``kind``) and _h (digest of them); nulls where a vector can't be compared."""

    def read(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                dim, xs, hs = [], [], []
                for v in part.column(1).to_pylist():
                    x = np.array(v, kind) + 0.0 if v and None not in v else np.empty(0)
                    good = len(x) > 0 and bool(np.isfinite(x).all() and x.any())
                    dim.append(len(x) if good else None)
                    xs.append(x.tobytes() if good else None)
                    hs.append(hashlib.sha256(xs[-1]).digest() if good else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(dim, pa.int32()), pa.array(xs, pa.binary()), pa.array(hs, pa.binary())], names=["_id", "_dim", "_x", "_h"])

    return rows.mapInArrow(tidied(read), f"_id {dict(rows.dtypes)['_id']}, _dim int, _x binary, _h binary")


def _coded(classes: DataFrame, kind: str, k: int, tables: int) -> DataFrame:
    """Classes (_v, _dim, _x, _m) with _code, _factor, _keys and the same as bytes."""
    names = ["_v", "_dim", "_x", "_m", "_code", "_factor", "_keys", "_bytes"]

    def code(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                same = b.filter(pa.array(dims == dim))
                for at in range(0, same.num_rows, 1024):
                    part = same.slice(at, 1024)
                    x = scaled(np.frombuffer(b"".join(part.column(2).to_pylist()), kind).reshape(-1, dim).astype(np.float64))
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    codes, factors = encode(unit)
                    own = keys(unit, k, tables)
                    cols = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factors), pa.array(own.tolist(), pa.list_(pa.int64())), pa.array([c.tobytes() for c in own.astype("<i8")], pa.binary())]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(4)), *cols], names=names)

    return classes.select("_v", "_dim", "_x", "_m").mapInArrow(tidied(code), "_v long, _dim int, _x binary, _m long, _code binary, _factor double, _keys array<long>, _bytes binary")


def links_of(x: np.ndarray, codes: np.ndarray, factors: np.ndarray, own: np.ndarray, sides: np.ndarray, table: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of vectors that meet in ``table`` first and whose cosine is ``least`` or more; of different sides, if there are two.

    Only pairs whose estimate is within its bounds of ``least`` or above are computed, exactly.
    """
    norm = np.linalg.norm(x, axis=1)
    unit = x / norm[:, None]
    out = []
    for a in range(0, len(x), 128):
        got, dev = estimates(codes[a : a + 128], factors[a : a + 128], unit)
        maybe = got + DEVIATIONS * dev[:, None] >= least
        maybe &= np.arange(len(x))[None, :] > np.arange(a, min(a + 128, len(x)))[:, None]
        if sides[0] != sides[-1]:  # members stand by side
            maybe &= sides[a : a + 128, None] != sides[None, :]
        i, j = np.nonzero(maybe)
        i += a
        for s in range(0, len(i), 8192):
            p, q = i[s : s + 8192], j[s : s + 8192]
            first = (own[p] == own[q]).argmax(1) == table
            p, q = p[first], q[first]
            near = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= least
            out.append((p[near], q[near]))
    return tuple(np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k in (0, 1))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first member that each is connected with."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _meet(members: DataFrame, kind: str, least: float) -> DataFrame:
    """_v, _n (vectors newly linked with it) and _to (one that it is connected with), from rows that meet by _dim, _t, _key, _lo, _hi."""
    by = ["_dim", "_t", "_key", "_lo", "_hi"]

    def work(batches):
        at, held = None, []

        def done():
            v, m, x, code, factor, own, side = zip(*held, strict=True)
            dim, table = at[0], at[1]
            x = scaled(np.frombuffer(b"".join(x), kind).reshape(-1, dim).astype(np.float64))
            codes = np.frombuffer(b"".join(code), np.uint8).reshape(len(v), -1)
            i, j = links_of(x, codes, np.array(factor), np.frombuffer(b"".join(own), "<i8").reshape(len(v), -1), np.array(side), table, least)
            if not len(i):
                return None
            v, m = np.array(v), np.array(m, np.int64)
            n = np.zeros(len(v), np.int64)
            np.add.at(n, i, m[j])
            np.add.at(n, j, m[i])
            some, root = np.flatnonzero(n), _roots(len(v), i, j)
            return pa.RecordBatch.from_arrays([pa.array(v[some]), pa.array(n[some]), pa.array(v[root[some]])], names=["_v", "_n", "_to"])

        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                for *group, v, m, x, code, factor, own, side in zip(*(part.column(k).to_pylist() for k in range(12)), strict=True):
                    if group != at:
                        if len(held) > 1 and (found := done()):
                            yield found
                        at, held = group, []
                    held.append((v, m, x, code, factor, own, side))
        if len(held) > 1 and (found := done()):
            yield found

    rows = members.select(*by, "_v", "_m", "_x", "_code", "_factor", "_bytes", "_side").repartition(*by).sortWithinPartitions(*by, "_side", "_v")
    return rows.mapInArrow(tidied(work), "_v long, _n long, _to long")


def near_vectors(rows: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id and kept: a row per row of ``rows``.

    Vectors are linked where their cosine, in double precision, is ``least`` or more; n_links counts the other rows that
    a row is linked with, component_id is the smallest id that links reach, kept tells whether it is the row's own.
    Equal vectors are one class, which is compared once; they are linked. Every link is computed exactly; a pair right at
    ``least`` is missed with a chance of MISS, a closer one with less.

    Null or empty vectors, those of zeros, and those that hold a null or a number that isn't finite are linked with nothing
    and kept. Vectors of different dimensions aren't compared. A null id stands before all others; repeated ids: each row is
    its own. Other columns, whatever their names, are ignored. Empty table: no rows.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "vectors")
    kind = "<f4" if dict(rows.dtypes)[vector_col] == "array<float>" else "<f8"
    base = scratch.table(_read(rows.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_e")), kind), "rows")
    classes = base.filter("_h IS NOT NULL").groupBy("_h").agg(F.any_value("_dim").alias("_dim"), F.any_value("_x").alias("_x"), F.count("*").alias("_m"), F.min(F.struct(F.col("_id").isNotNull().alias("there"), F.col("_id").alias("id"))).alias("_first"))
    # classes are known by a number, which the written table keeps
    classes = scratch.table(classes.withColumn("_v", F.xxhash64(F.monotonically_increasing_id())), "classes")
    coded = scratch.table(_coded(classes, kind, *plan(classes.count(), least)), "coded")
    keyed = coded.select("_v", "_dim", F.posexplode("_keys").alias("_t", "_key"))
    sizes = scratch.table(keyed.groupBy("_dim", "_t", "_key").agg(F.count("*").alias("_size")).filter("_size > 1"), "sizes")
    blocks = F.when(F.col("_size") <= BLOCK, F.lit(1)).otherwise(F.ceil(F.col("_size") / (BLOCK // 2)))
    keyed = keyed.join(sizes, ["_dim", "_t", "_key"]).withColumn("_blocks", blocks.cast("int"))
    keyed = keyed.withColumn("_side", F.pmod(F.xxhash64("_v", "_t"), F.col("_blocks")).cast("int"))
    # every two blocks of a key meet once, and each block by itself
    keyed = keyed.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    keyed = keyed.select("_v", "_t", "_key", "_side", F.least("_side", "_with").alias("_lo"), F.greatest("_side", "_with").alias("_hi"))
    found = scratch.table(_meet(keyed.join(coded.drop("_keys"), "_v"), kind, least), "found")
    degree = found.groupBy("_v").agg(F.sum("_n").alias("_n"))
    joined = components(found.select(F.col("_v").alias("a"), F.col("_to").alias("b")), scratch, "joined").select(F.col("node").alias("_v"), F.col("component").alias("_c"))
    named = classes.select("_v", "_h", "_m", "_first").join(degree, "_v", "left").join(joined, "_v", "left").withColumn("_c", F.coalesce("_c", "_v"))
    least_id = named.groupBy("_c").agg(F.min("_first").alias("_least"))
    named = named.join(least_id, "_c").select("_h", (F.coalesce("_n", F.lit(0)) + F.col("_m") - 1).alias("_n"), F.col("_least.id").alias("_least"), F.lit(True).alias("_found"))
    named = scratch.table(named, "named")
    scratch.keep("rows", "named")
    out = base.select("_id", "_h").join(named, "_h", "left")
    out = out.select(F.col("_id").alias(id_col), F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("_found"), F.col("_least")).otherwise(F.col("_id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
