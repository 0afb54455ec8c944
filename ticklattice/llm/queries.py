"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, codes, contamination, langid, licenses, lines, minhash, packing, resampling, setjoin, sharding, sql, substrings
from .common import place_in_file, read_table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    dictionaries = langid.learn(docs.filter(~docs["held_out"]).select("doc_id", "text", "lang"))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), dictionaries)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score", "margin", "rejected")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = lines.dedup_lines(docs.select("doc_id", "text"), uid=place_in_file(docs))
    return found.select("row.doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"), F.length("text").alias("kept_chars"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = substrings.remove_repeats(docs, uid=place_in_file(docs))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = minhash.near_duplicates(docs, width=4, uid=place_in_file(docs))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line_no", "license", "saved", "changed", F.array_join("missing", " ").alias("missing"), F.array_join("added", " ").alias("added"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return setjoin.join_sets(docs, uid=place_in_file(docs)).select("doc_id", "n_shingles", "component_id")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read_table(spark, sf_dir, "embeddings")).drop("label")


_QUERIES = (
    op1_best_fit_packing,
    op2_chat_formatting,
    op3_language_id,
    op4_benchmark_decontamination,
    op5_nearest_neighbours,
    op6_line_dedup,
    op7_sharding,
    op8_suffix_array_dedup,
    op9_minhash_near_dedup,
    op10_license_scan,
    op11_ngram_jaccard_join,
    op12_importance_resampling,
    op13_vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_benchmark_decontamination": sql.CONTAINED,
        "op6_line_dedup": sql.LINES,
        "op8_suffix_array_dedup": sql.REPEATS,
        "op9_minhash_near_dedup": sql.NEAR,
        "op11_ngram_jaccard_join": sql.JOINED,
        "op12_importance_resampling": sql.RESAMPLED,
        "op13_vector_codes": sql.CODES,
    }
