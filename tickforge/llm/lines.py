"""Line dedup by a deletion-neighbourhood join: of lines within one edit of each other, the earliest stays.

Variants of a line with a character deleted are hashed keys; lines that share one are joined, verified by edit distance,
and removed if the partner comes earlier. Two coarser keys of the same kind come first and lose nothing: a line has an
intact half of at least a power of two of characters in common with any line within one edit, and then all but one of
its blocks. Only lines that share such keys with another line emit their variants, and only within the blocks at hand.

Built-in expressions only. Groups that share a key are reduced to their earliest line; no pairs within a group are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import SPACES, Scratch

#: Characters from which on one edit leaves two lines similar by 0.8; shorter lines are the same only if they are equal.
MIN_CHARS = 5
BLOCKS, BLOCK_CHARS = 8, 256


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The lines with a word: _id, _k (hash of id and text, which tells rows of the same id apart), _pos, _line, _h1, _h2."""
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(id_col, text_col).alias("_k"), F.posexplode(F.split(F.col(text_col), "\n")).alias("_pos", "_line"))
    rows = rows.filter(F.ltrim("_line", F.lit(f" {SPACES}")) != "")
    return rows.select("*", F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(1), F.col("_line")).alias("_h2"))


def _near(lines: DataFrame, scratch: Scratch, min_chars: int) -> DataFrame:
    """_h1, _h2 of the lines with an earlier line within one edit."""
    at = F.struct("_id", "_k", "_pos")
    long = lines.filter(F.length("_line") >= min_chars)
    half = lambda n0: f"shiftleft(1, length(bin(({n0}) div 2)) - 1)"
    ends = lambda c: f"xxhash64({c}, 0, left(_line, {c})), xxhash64({c}, 1, right(_line, {c}))"
    n = "length(_line)"
    keys = long.select("_h1", "_h2", at.alias("_at"), F.explode(F.expr(f"array_distinct(array({ends(half(n))}, {ends(half(n + ' - 1'))}))")).alias("_key"))
    shared = lambda df: df.groupBy("_key").agg(F.min("_h1").alias("_lo"), F.max("_h1").alias("_hi")).filter("_lo <> _hi").select("_key")
    some = keys.join(shared(keys), "_key", "left_semi").groupBy("_h1", "_h2").agg(F.min("_at").alias("_at"))
    some = scratch.table(some, "halves")
    texts = long.select("_h1", "_h2", "_line").join(some, ["_h1", "_h2"]).dropDuplicates(["_h1", "_h2"])
    texts = scratch.table(texts, "texts")

    n_blocks = f"greatest({BLOCKS}, (n0 + {BLOCK_CHARS - 1}) div {BLOCK_CHARS})"
    blocks = texts.select("*", F.explode(F.expr(f"array({n}, {n} - 1)")).alias("n0")).select("*", F.expr(n_blocks).alias("nb"))
    blocks = blocks.select("*", F.explode(F.expr("sequence(0L, nb - 1)")).alias("i"))
    blocks = blocks.select("*", F.expr("cast(i * n0 div nb as int)").alias("b"), F.expr("cast((i + 1) * n0 div nb as int)").alias("e"))
    blocks = blocks.select(
        "_h1", "_h2", "_at", F.expr("xxhash64(n0, i, left(_line, b), right(_line, n0 - e))").alias("_key"),
        F.expr(f"substring(_line, b + 1, {n} - (n0 - e) - b)").alias("_mid"), F.expr(f"n0 = {n}").alias("_same"),
    )
    blocks = blocks.join(shared(blocks), "_key", "left_semi")
    gone = "transform(sequence(1, length(_mid)), p -> xxhash64(_key, {}, concat(left(_mid, p - 1), substring(_mid, p + 1))))"
    # of lines of the same length those that are equal but for one place; of lines one longer those that lack one place
    variants = F.expr(f"""CASE WHEN length(_mid) = 0 THEN array(xxhash64(_key, 0, ''))
      WHEN _same THEN array_append({gone.format('p')}, xxhash64(_key, 0, _mid)) ELSE {gone.format('0')} END""")
    # the last key of a line of base length is the whole line
    rows = blocks.select("_h1", "_h2", "_at", "_same", F.posexplode(variants).alias("_p", "_variant"), F.expr("length(_mid)").alias("_m"))
    rows = rows.select("_h1", "_h2", "_at", "_variant", F.expr("CASE WHEN NOT _same THEN 'longer' WHEN _p = _m THEN 'whole' ELSE 'other' END").alias("_role"))
    rows = scratch.table(rows, "variants")
    me = F.struct("_at", "_h1", "_h2")
    first = lambda role: F.min(F.when(F.col("_role") == role, me)).alias(role)
    groups = rows.groupBy("_variant").agg(first("longer"), first("whole"), first("other"))
    partner = F.expr("CASE _role WHEN 'longer' THEN whole WHEN 'whole' THEN longer ELSE other END")
    links = rows.join(groups, "_variant").select("_h1", "_h2", "_at", partner.alias("_to")).filter("_to._at < _at")
    links = links.select("_h1", "_h2", F.col("_to._h1").alias("_g1"), F.col("_to._h2").alias("_g2")).distinct()
    mine, other = texts.select("_h1", "_h2", F.col("_line").alias("_a")), texts.select(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"), F.col("_line").alias("_b"))
    verified = links.join(mine, ["_h1", "_h2"]).join(other, ["_g1", "_g2"]).filter(F.expr("levenshtein(_a, _b, 1) = 1"))
    return scratch.table(verified.select("_h1", "_h2").distinct(), "near")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, counts: bool = True, length_col: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` cut to the lines that stay, with ``counts`` plus n_lines and n_removed (lines with a word; long).

    Lines are ordered by document id, then place. A line with a word is removed if an earlier one is equal, or, where both
    have at least ``min_chars`` characters, is within one inserted, deleted or replaced character, whether or not that
    one stays. Lines without a word stay. Other columns are kept; the counts replace columns of these names, and
    ``length_col``, if there is such a column, gets the length of the texts that lose a line.

    Null text stays null. A null id comes before all others. Rows of the same id are ordered by a hash of their text; rows
    equal in id and text are one document seen twice, and the same lines of both stay. Empty table: no rows.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = _lines(docs, id_col, text_col)
    near = _near(lines, scratch, min_chars).withColumn("_near", F.lit(True))
    scratch.keep("near")
    places = lines.select("_h1", "_h2", F.struct("_id", "_k", "_pos").alias("_at"))
    seen = places.groupBy("_h1", "_h2").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    judged = seen.join(near, ["_h1", "_h2"], "left").filter("_n > 1 OR _near").select("_h1", "_h2", "_first", F.coalesce("_near", F.lit(False)).alias("_near"))
    removed = places.join(judged, ["_h1", "_h2"]).filter("_near OR _at > _first").select("_at._id", "_at._k", "_at._pos")
    removed = removed.groupBy("_id", "_k").agg(F.collect_set("_pos").alias("_gone")).withColumnRenamed("_k", "_k2")
    keep = [c for c in docs.columns if not counts or c not in ("n_lines", "n_removed")]
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row")  # what other columns are called doesn't matter
    out = docs.select(row, F.col(id_col).alias("_id1"), F.col(text_col).alias("_text"), F.xxhash64(id_col, text_col).alias("_k1"))
    out = out.join(removed, F.col("_id1").eqNullSafe(F.col("_id")) & (F.col("_k1") == F.col("_k2")), "left")
    out = out.withColumn("_all", F.split(F.col("_text"), "\n")).withColumn("_left", F.expr("array_except(sequence(0, size(_all) - 1), _gone)"))
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.expr("array_join(transform(_left, i -> get(_all, i)), '\n')"))
    cols = [text.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in keep]
    if length_col in keep:
        kind = docs.schema[length_col].dataType
        at = keep.index(length_col)
        cols[at] = F.when(F.col("_gone").isNotNull(), F.length(text).cast(kind)).otherwise(F.col("_row").getField(length_col)).alias(length_col)
    if not counts:
        return out.select(*cols)
    words = F.coalesce(F.size(F.filter("_all", lambda x: F.ltrim(x, F.lit(f" {SPACES}")) != "")), F.lit(0))
    return out.select(*cols, F.greatest(words, F.lit(0)).cast("long").alias("n_lines"), F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"))
