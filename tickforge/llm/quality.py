"""Quality rules by line-first cleaning: judge each line, drop the failures, then judge what is left.

Built-in expressions only; one pass over the rows, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import SPACES

#: Line endings of prose, separators of navigation bars, symbols, and phrases of boilerplate.
TERMINAL = ".!?…:;\"'”’»)"
SEPARATORS = "|»›·•"
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript", "licensed under",
    "lorem ipsum", "permission is hereby granted", "privacy policy", "read more", "sign in", "subscribe to our",
    "terms of service", "terms of use",
)
MIN_WORDS, MAX_REPEAT_PERCENT, MAX_LOST_PERCENT = 50, 50, 40


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def line_rules(line: str, low: str, words: str) -> dict[str, str]:
    """SQL predicates, each true where a line fails. ``line``: SQL for the trimmed line; ``low``: for it in lower case; ``words``: for its word count."""
    symbols = f"(length({line}) - length(translate({line}, {_quote(SYMBOLS)}, '')))"
    separators = f"(length({line}) - length(translate({line}, {_quote(SEPARATORS)}, '')))"
    ends = f"instr({_quote(TERMINAL)}, right({line}, 1)) = 0"
    phrases = " OR ".join(f"contains({low}, {_quote(p)})" for p in BOILERPLATE)
    return {
        "punctuation": f"({ends} AND {words} < 5) OR 3 * {symbols} > {words} OR ({words} >= 5 AND {line} <> {low} AND {line} = upper({line}))",
        "navigation": f"{separators} >= 2 AND 4 * {separators} >= {words}",
        "boilerplate": phrases,
    }


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """One row per input row: the id, base counts, the cleaned text and the verdict.

    ``cleaned`` is the text without the lines that fail a rule (lines without a word stay as they are). ``kept`` is
    false if the base rules fail or more than ``max_lost_percent`` percent of the words were in removed lines.

    Null and empty texts: no words, base_failed. Null ids and repeated rows pass through, a row each. Very long texts and
    lines are judged whole. Other columns, whatever their names, are ignored. Empty table: no rows.
    """
    spaced = f"translate(_t, {_quote(SPACES)}, '     ')"
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    out = out.select("doc_id", "_t", F.expr(f"filter(split({spaced}, ' '), w -> w <> '')").alias("_w"), F.expr("split(_t, '\n')").alias("_raw"))
    windows = "CASE WHEN size(_w) < 4 THEN array() ELSE transform(slice(_w, 1, size(_w) - 2), (w, i) -> struct(xxhash64(w, get(_w, i + 1), get(_w, i + 2)) AS h, i AS i)) END"
    line = f"trim(translate(l, {_quote(SPACES)}, '     '))"
    out = out.select(
        "doc_id", "_t", F.expr("size(_w)").alias("n_words"),
        F.expr(f"length(translate(_t, {_quote(SPACES + ' ')}, ''))").alias("word_chars"),
        F.expr(f"length(_t) - length(translate(_t, {_quote(SYMBOLS)}, ''))").alias("n_symbols"),
        F.expr(f"sort_array({windows})").alias("_s"), "_raw",
        F.expr(f"transform(transform(_raw, l -> {line}), t -> named_struct('t', t, 'low', lower(t), 'n', size(filter(split(t, ' '), w -> w <> ''))))").alias("_l"),
    )
    rules = " OR ".join(f"({r})" for r in line_rules("x.t", "x.low", "x.n").values())
    out = out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "_raw", "_l",
        F.expr("sort_array(transform(filter(_s, (x, i) -> get(_s, i - 1).h <=> x.h OR get(_s, i + 1).h <=> x.h), x -> x.i))").alias("_p"),
        F.expr("filter(_raw, (l, i) -> get(_l, i).n > 0)").alias("_real"),
        F.expr(f"transform(_l, x -> x.n > 0 AND ({rules}))").alias("_bad"),
    )
    out = out.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        F.expr("size(_real) - size(array_distinct(_real))").alias("n_dup_lines"),
        F.expr("aggregate(transform(_p, (p, i) -> least(3, coalesce(get(_p, i + 1), p + 3) - p)), 0, (a, x) -> a + x)").alias("n_repeat_words"),
        F.expr("array_join(filter(_raw, (l, i) -> NOT get(_bad, i)), '\n')").alias("cleaned"),
        F.expr("aggregate(filter(_l, (x, i) -> get(_bad, i)), 0, (a, x) -> a + x.n)").alias("n_lost_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words").cast("long") > MAX_REPEAT_PERCENT * F.col("n_words").cast("long"))
    lost = 100 * F.col("n_lost_words").cast("long") > max_lost_percent * F.col("n_words").cast("long")
    longs = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")]
    return out.select("doc_id", *longs, failed.alias("base_failed"), (~failed & ~lost).alias("kept"), "cleaned")
