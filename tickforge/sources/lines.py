"""Text files of any size as numbered lines, in the order in which they stand, read in splits by many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.sources.lists import TICKER


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """line_no (from 0) and line of the files of ``path``, by their names. Lines end with a line feed, a carriage return before it is dropped.

    Each split of a file counts its own lines; the counts before it, a row a split, give its first number. No line is moved.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"), F.regexp_replace("value", "\r$", "").alias("line"))
    splits = raw.groupBy("_file", "_start").agg(F.min("_at").alias("_lo"), F.count("*").alias("_n"))
    before = F.expr("coalesce(sum(_n) OVER (ORDER BY _file, _start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - _lo")
    return raw.join(splits.select("_file", "_start", before.alias("_off")), ["_file", "_start"]).select((F.col("_at") + F.col("_off")).alias("line_no"), "line")


def universe(lines: DataFrame) -> DataFrame:
    """pos, symbol of the lines after the first that starts with ``Ticker``, as ``lists.universe`` reads them from one text."""
    header = lines.filter(F.startswith("line", F.lit("Ticker"))).agg(F.min("line_no").alias("_header"))
    symbol = F.upper(x.trimmed(F.get(F.split("line", ","), 0)))
    after = lines.join(header, F.col("line_no") > F.col("_header"))  # one row, null where there is no header
    return after.select(F.col("line_no").alias("pos"), symbol.alias("symbol")).filter(F.col("symbol").rlike(TICKER))


def tickers(lines: DataFrame, raw: str | None = None) -> DataFrame:
    """symbol and at (part, line_no, k), its first place: of a comma list ``raw`` and then of a file's lines, several a line, # lines skipped."""
    given = lines.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("line_no"), F.lit(raw or "").alias("line"))
    of_file = lines.filter(~F.startswith(x.trimmed("line"), F.lit("#"))).select(F.lit(1).alias("part"), "line_no", "line")
    words = given.unionByName(of_file).select("part", "line_no", F.posexplode(F.split("line", ",")).alias("k", "w"))
    words = words.select(F.struct("part", "line_no", "k").alias("at"), F.upper(x.trimmed("w")).alias("symbol")).filter("symbol <> ''")
    return words.groupBy("symbol").agg(F.min("at").alias("at"))
