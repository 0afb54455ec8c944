"""From raw documents to packed sequences: five stages, each one operator on all that the one before it kept.

1. language_id: drops documents without a language (no letters, or a margin too narrow to tell).
2. line_dedup: takes out lines that an equal or nearly equal line precedes; drops documents of which nothing is left.
3. near_dedup: keeps the document with the smallest doc_id of each group of near copies (five-word shingles, 0.8).
4. decontamination: drops documents that hold a benchmark item (five-word shingles, 0.8 of the item's).
5. packing: packs what is left into sequences of 2048 tokens.

Defined results: a row without text goes in the first stage, as it has no language; a null doc_id is kept and ranks first in line
dedup, but is never a near duplicate; rows with one doc_id are documents of their own, told apart by their place in the stage's
input, and of repeated rows the first stays; ties go to the smaller doc_id; an empty table gives an empty result; the first four
stages return the columns that they get, extra ones included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklattice.llm import contamination, langid, lines, minhash, packing
from ticklattice.llm.common import NULL_ID, if_small, place_in_file, read_table, write_table

#: SQL can't express zstandard sizes, sketches or best fit; tests compare the stages with brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dictionaries = langid.learn(docs.filter(~langid.held_out()).select("doc_id", "text", "lang"))
    return langid.identify(docs, dictionaries).filter(~F.col("rejected")).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(docs, uid=place_in_file(docs))
    left = found.filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return left.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    uid = place_in_file(docs)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc")
    found = minhash.near_duplicates(docs, uid=uid).filter(~F.col("first"))
    gone = if_small(write_table(found.select(doc, "uid"), "near-copies"))
    return docs.select(doc, uid.alias("uid"), F.struct("*").alias("row")).join(gone, ["doc", "uid"], "left_anti").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), uid=place_in_file(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
