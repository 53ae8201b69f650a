"""The corpus pipeline: from documents to packed sequences, in stages that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import decontamination, lines, near, packing, toxicity
from tickforge.llm.common import Scratch, read, scratches_closed
from tickforge.llm.registry import tokenizer_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5. Null and empty texts have no evidence and stay."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand earlier, also within one edit; n_chars, if there, follows the text. Null texts stay null."""
    return lines.dedup_lines(docs, counts=False, length_col="n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the rows of the smallest id. Texts without a word are like no other and stay."""
    return near.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; null texts leak none."""
    return decontamination.drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each with its sequence and its place there. Null texts are an end alone."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Nearest labelled examples and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents of ``sf_dir``. A stage's own tables, and its input, go when its output is written.

    All stages take null and repeated ids, null, empty and very long texts, repeated rows, empty tables and other columns of
    any name, which all but the last hand on.
    """
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        with scratches_closed():
            docs = scratch.table(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
