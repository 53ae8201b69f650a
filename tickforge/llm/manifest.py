"""A Merkle manifest of a table: a hash tree over the rows of each group, and one over the groups' roots.

Rows are numbered within their group by a range shuffle and counts of the ranges, so that no group is held by one task.
Each level is a table of its own: nodes are grouped by their index divided by the fanout, and the sorted children of a
group are hashed to their parent. On the way back each level is joined with what is known of its parents, and every
child gets its siblings in front of its parent's, down to the leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch

FANOUT = 3
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """A value as it is hashed: ``-`` if null, else its length in UTF-8 bytes, a colon and itself."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*(field(c) for c in values))


def siblings(proof: Column) -> Column:
    """Digests of a proof put together, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda x: F.concat(x.left, x.right)), "")


def fold(first: Column, proof: Column) -> Column:
    """The root that a leaf leads to with the siblings of its proof."""
    return F.aggregate(proof, first, lambda h, x: digest(x.left, h, x.right))


def numbered(rows: DataFrame, order: Sequence[Column], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with _i, their place by ``order`` in their group _g, from 0, and _n, the size of the group; nulls are a group."""
    by = [F.col("_g").asc_nulls_first(), *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = scratch.table(placed.withColumns({"_p": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name)
    ranges = placed.groupBy("_g", "_p").agg(F.min("_at").alias("_lo"), F.count("*").alias("_c"))  # a row for each group and range
    before = "coalesce(sum(_c) OVER (PARTITION BY _g ORDER BY _p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - _lo"
    ranges = ranges.select(F.col("_g").alias("_g2"), F.col("_p").alias("_p2"), F.expr(before).alias("_off"), F.expr("sum(_c) OVER (PARTITION BY _g)").alias("_n"))
    out = placed.join(ranges, F.col("_g").eqNullSafe(F.col("_g2")) & (F.col("_p") == F.col("_p2")))
    return out.withColumn("_i", F.col("_at") + F.col("_off")).drop("_g2", "_p", "_p2", "_at", "_off")


def levels(nodes: DataFrame, fanout: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """Levels of the trees of all groups above ``nodes`` (_g, _i, _n, _h), each with its nodes' children (_x); a group ends where _n is 1."""
    out, most = [], nodes.agg(F.max("_n")).first()[0] or 0
    below = nodes
    while most > 1:
        children = F.sort_array(F.collect_list(F.struct("_i", "_h")))  # fanout at most
        up = below.filter("_n > 1").groupBy("_g", F.expr(f"_i div {fanout}").alias("_up")).agg(F.max(F.expr(f"(_n + {fanout - 1}) div {fanout}")).alias("_n"), children.alias("_x"))
        up = up.select("_g", F.col("_up").alias("_i"), "_n", F.transform("_x", lambda c: c["_h"]).alias("_x"))
        below = scratch.table(up.select("_g", "_i", "_n", digest(F.array_join("_x", "")).alias("_h"), "_x"), f"{name}-{len(out) + 1}")
        out.append(below)
        most = -(-most // fanout)
    return out


def _roots(nodes: DataFrame, above: list[DataFrame]) -> DataFrame:
    """_g and _h of the root of each group."""
    out = nodes.filter("_n = 1").select("_g", "_h")
    for level in above:
        out = out.unionByName(level.filter("_n = 1").select("_g", "_h"))
    return out


def _proved(nodes: DataFrame, known: DataFrame | None, top: DataFrame) -> DataFrame:
    """``nodes`` with _sub and _proof: of roots from ``top``, of others from ``known``, what their parents handed down."""
    same = F.col("_g").eqNullSafe(F.col("_g2")) & (F.col("_i") == F.col("_i2"))
    out = nodes.filter("_n = 1").join(top, same)
    return (out if known is None else out.unionByName(nodes.filter("_n > 1").join(known, same))).drop("_g2", "_i2")


def proofs(nodes: DataFrame, above: list[DataFrame], top: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with _sub and _proof. ``above``: their levels; ``top``: _g, _sub (a group's root) and _proof (what follows it)."""
    top = top.select(F.col("_g").alias("_g2"), F.lit(0).cast("long").alias("_i2"), "_sub", "_proof")
    left, right = F.array_join(F.slice("_x", F.lit(1), F.col("_pos")), ""), F.array_join(F.slice("_x", F.col("_pos") + 2, F.size("_x")), "")
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    known = None
    for level in reversed(above):
        own = _proved(level.select("_g", "_i", "_n", "_x"), known, top).select("*", F.posexplode("_x").alias("_pos", "_child"))
        known = own.select(F.col("_g").alias("_g2"), (F.col("_i") * fanout + F.col("_pos")).alias("_i2"), "_sub", F.concat(step, "_proof").alias("_proof"))
    return _proved(nodes, known, top)


def manifest(rows: DataFrame, fields: Sequence[str], group_col: str = "source", id_col: str = "doc_id", fanout: int = FANOUT, keep: Sequence[str] = ()) -> DataFrame:
    """id, leaf, subroot, root and proof of each row, and its columns ``keep``.

    A leaf is the digest of ``fields``, each after its length, so that no two rows read alike. The leaves of a group stand
    by id (and by leaf, where ids repeat); every ``fanout`` nodes in a row, the last of a level fewer, have one parent, until one
    is left: the subroot, a lone leaf itself. Subroots, by group (null first, else by their bytes), lead to the root alike.
    A proof has, level by level, the digests left and right of the path: ``fold(leaf, proof)`` is the root.

    Null in any column: hashed as such; null ids stand first, a null group is a group. Empty and very long texts are hashed
    whole. Repeated rows are leaves of their own with equal digests and proofs of their own. Other columns, whatever their
    names, have no part in it. Empty table: no rows.
    """
    scratch = Scratch(rows.sparkSession, "manifest")
    base = rows.select(F.col(group_col).alias("_g"), F.col(id_col).alias("_id"), leaf(*(F.col(c) for c in fields)).alias("_h"), F.struct(F.lit(0).alias("_"), *keep).alias("_keep"))
    base = scratch.table(base, "leaves")  # texts are hashed once, not again for the bounds of the ranges
    leaves = scratch.table(numbered(base, [F.col("_id").asc_nulls_first(), F.col("_h")], scratch, "placed"), "numbered")
    above = levels(leaves, fanout, scratch, "level")
    subroots = _roots(leaves, above).withColumnsRenamed({"_g": "_group"}).withColumn("_g", F.lit(None).cast("string"))
    subroots = scratch.table(numbered(subroots, [F.col("_group").asc_nulls_first()], scratch, "subroots"), "groups")
    over = levels(subroots, fanout, scratch, "over")
    root = _roots(subroots, over).first()  # one row
    last = scratch.table(rows.sparkSession.range(1).select(F.lit(None).cast("string").alias("_g"), F.lit(root["_h"] if root else None).cast("string").alias("_sub"), F.array().cast(PROOF).alias("_proof")), "last")
    top = scratch.table(proofs(subroots, over, last, fanout).select(F.col("_group").alias("_g"), F.col("_h").alias("_sub"), "_proof"), "top")
    scratch.keep("numbered", "level", "top")
    out = proofs(leaves, above, top, fanout)
    return out.select(F.col("_id").alias(id_col), F.col("_h").alias("leaf"), F.col("_sub").alias("subroot"), F.lit(root["_h"] if root else None).cast("string").alias("root"), F.col("_proof").alias("proof"), *(F.col("_keep")[c].alias(c) for c in keep))
