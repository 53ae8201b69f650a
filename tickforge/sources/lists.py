"""Symbol lists: universe files, ticker arguments and category texts. Whole small texts, one per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import expr as x

TICKER = "^[A-Z0-9.]+$"


def texts(spark: SparkSession, *values: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def text_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.lit(0).alias("id"), F.col("value").alias("text"))


def universe(rows: DataFrame) -> DataFrame:
    """pos, symbol of the lines after the first that starts with ``Ticker``; first field, upper case, kept if it is a ticker.

    Quotes aren't understood and duplicates stay.
    """
    lines = rows.select("id", F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line"), F.split("text", r"\r?\n").alias("_all"))
    header = F.array_position(F.transform("_all", lambda s: F.startswith(s, F.lit("Ticker"))), True) - 1
    after = lines.filter((header >= 0) & (F.col("line_no") > header))
    symbol = F.upper(x.trimmed(F.get(F.split("line", ","), 0)))
    out = after.select("id", "line_no", symbol.alias("symbol")).filter(F.col("symbol").rlike(TICKER))
    return out.select("id", F.col("line_no").alias("pos"), "symbol")


def combined(*parts: DataFrame) -> DataFrame:
    """The lists one after another, duplicates kept."""
    out = None
    for k, p in enumerate(parts):
        p = p.select(F.lit(k).alias("part"), "pos", "symbol")
        out = p if out is None else out.unionByName(p)
    return out


def ordered_distinct(rows: DataFrame, key: str = "symbol", pos: str | Column = "pos") -> DataFrame:
    """The first place of each value."""
    return rows.groupBy(key).agg(F.min(pos).alias("pos"))


def ticker_arguments(raw: str | None, file_text: str | None, spark: SparkSession) -> DataFrame:
    """pos, symbol from a comma list and a file's text (blank and # lines skipped, several a line); first of equals stays.

    Raises ValueError where nothing is left.
    """
    rows = spark.createDataFrame([(0, 0, raw or "")], "part int, line_no int, line string")
    lines = spark.createDataFrame([(1, file_text or "")], "part int, text string").select("part", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line_no", "line"))
    lines = lines.filter(~F.startswith(x.trimmed("line"), F.lit("#")))
    words = rows.unionByName(lines).select("part", "line_no", F.posexplode(F.split("line", ",")).alias("k", "w"))
    words = words.select(F.struct("part", "line_no", "k").alias("at"), F.upper(x.trimmed("w")).alias("symbol")).filter("symbol <> ''")
    out = words.groupBy("symbol").agg(F.min("at").alias("at"))
    if out.isEmpty():
        raise ValueError("no tickers given")
    return out


def categories(rows: DataFrame) -> DataFrame:
    """cat_pos, category, sym_pos, symbol of the blocks of texts (id, text), in the order of ids; of a repeated name the last list at the first place.

    A block stands in one text. cat_pos tells the text, its id times 2^32, and the block's place there.
    """
    blocks = rows.select("id", F.posexplode(x.category_blocks("text")).alias("k", "b")).select((F.shiftleft(F.col("id").cast("long"), 32) + F.col("k")).alias("at"), "b")
    blocks = blocks.select("at", x.trimmed("b.name").alias("category"), x.block_symbols("b.inner").alias("symbols")).filter(F.size("symbols") > 0)
    last = blocks.groupBy("category").agg(F.min("at").alias("cat_pos"), F.max_by("symbols", "at").alias("symbols"))
    return last.select("cat_pos", "category", F.posexplode("symbols").alias("sym_pos", "symbol"))


BAD_REQUEST = "symbols must be a non-empty array of non-blank strings"


def requests(rows: DataFrame) -> DataFrame:
    """id, pos, symbol and error of JSON request bodies (id, text): a row for each symbol, or one with the error of a body that can't be taken."""
    symbols = F.from_json("text", "symbols array<string>, date string").getField("symbols")
    body = rows.select("id", symbols.alias("symbols"))
    good = F.coalesce((F.size("symbols") > 0) & F.forall("symbols", lambda v: F.coalesce(x.trimmed(v), F.lit("")) != ""), F.lit(False))
    each = body.select("id", F.posexplode_outer(F.when(good, F.col("symbols"))).alias("pos", "symbol"))
    return each.withColumn("error", F.when(F.col("pos").isNull(), BAD_REQUEST))


def request(rows: DataFrame) -> DataFrame:
    """pos, symbol of a JSON request body {"symbols": [...]}; raises ValueError unless all are non-blank strings."""
    body = rows.select(F.from_json("text", "symbols array<string>, date string").alias("b"))
    out = body.select(F.posexplode("b.symbols").alias("pos", "symbol"))
    bad = out.agg(F.count("*").alias("n"), F.count_if(F.coalesce(x.trimmed("symbol"), F.lit("")) == "").alias("blank")).first()
    if not bad["n"] or bad["blank"]:
        raise ValueError(BAD_REQUEST)
    return out
