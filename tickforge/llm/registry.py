"""The subpackage's queries, with production parameters over whole tables, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import chat, decontamination, lines, lm, manifest, near, oracles, packing, quality, ranked, repeats, toxicity, urls, vectors
from tickforge.llm.common import bucket_col, read


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    out = urls.filter_urls(pages, urls.page_outcomes(pages, read(spark, sf_dir, "labels")))
    return out.select("page_id", "host", "path", "rule", "verdict")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", (bucket_col(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "evidence")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), num=85)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(read(spark, sf_dir, "documents")).drop("cleaned")


def op10_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_rotated_codes_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    docs = read(spark, sf_dir, "documents").select(*fields)
    docs = docs.withColumn("tampered", manifest.leaf(*(text if c == "text" else F.col(c) for c in fields)))
    out = manifest.manifest(docs, fields, keep=["tampered"])
    out = out.withColumn("folded_root", manifest.fold(F.col("tampered"), F.col("proof")))
    proof = manifest.digest(manifest.siblings(F.col("proof"))).alias("proof_sha256")
    return out.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_url_filter": op1_url_filter,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_decontamination": op3_decontamination,
    "op4_chat_format": op4_chat_format,
    "op5_toxicity": op5_toxicity,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_setsketch_near_dedup": op7_setsketch_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_hmm_scoring": op10_hmm_scoring,
    "op11_ranked_search": op11_ranked_search,
    "op12_rotated_codes_dedup": op12_rotated_codes_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL = {
    "op1_url_filter": oracles.OP1,
    "op4_chat_format": oracles.OP4,
    "op7_setsketch_near_dedup": oracles.OP7,
    "op8_line_dedup": oracles.OP8,
    "op9_quality_rules": oracles.OP9,
    "op11_ranked_search": oracles.OP11,
    "op12_rotated_codes_dedup": oracles.OP12,
    "op13_merkle_manifest": oracles.OP13,
}
