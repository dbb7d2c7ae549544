"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.llm import (
    decontamination,
    hilbert,
    language,
    line_dedup,
    lm_scoring,
    merkle,
    packing,
    quality,
    simhash,
    spelling,
    token_counts,
    token_files,
    vector_cells,
)
from arrearscope.session import scratch_path

WORD_TOKENIZER, WORD_END = "word_bpe_49k.json", 2
BYTE_TOKENIZER, BYTE_END = "byte_bpe_50k.json", 0
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), WORD_END)
    return token_files.read(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.assign(_table(spark, sf_dir, "documents"), ["source", "lang", "n_chars"])
    body = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.sequences(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER), BYTE_END)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.link(_table(spark, sf_dir, "documents"))
    return linked.select(
        F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("chosen_key").alias("component_id"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count(docs, public_tokenizers.path(PIECES))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    return vector_cells.search(table, table.filter("vec_id % 50 = 0"), 5).withColumnRenamed("id", "vec_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in merkle.FIELDS} | {"n_chars": F.try_add(F.col("n_chars"), F.lit(1))}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf(list(fields.values())))
    rows = merkle.manifest(docs, carried={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_hilbert_shards, op3_decontamination, op4_lm_scores, op5_packing,
        op6_language, op7_simhash, op8_quality_rules, op9_token_counts, op10_line_dedup,
        op11_vector_search, op12_spelling_variants, op13_merkle_manifest,
    )
}
