"""Corpus pipeline over ``documents``: each stage works on all its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a table with the columns of
``documents``, the last one the encoded documents. Rows without an id pass the stages that compare by id. A
text that line dedup leaves without a word was a later copy as a whole, and its document goes.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm.bpe import bpe_round_trip
from parcelle.llm.common import small_or_shuffled, table
from parcelle.llm.lines import line_dedup
from parcelle.llm.near import near_duplicates
from parcelle.llm.quality import quality_rules
from parcelle.llm.templates import contaminated
from parcelle.session import work_folder

VOCABULARY = "byte_bpe_50k.tiktoken"
# Ids of rejected documents in a broadcast (8 MB); more are joined by shuffle.
BROADCAST_IDS = 1_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules or their host's verdict reject go."""
    columns = docs.columns
    return quality_rules(docs).where("__kept").select(*[f"`{c}`" for c in columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go from the texts; ``n_chars`` follows."""
    cut = line_dedup(docs, carry=docs.columns).where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("carried.text")),
               "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("carried.n_chars"))}
    return cut.select(*[changed.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 80 percent) stays, the one with the least id."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(small_or_shuffled(gone, BROADCAST_IDS), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go, also those that differ in capitals."""
    gone = contaminated(docs, table(spark, sf_dir, "benchmark"), any_case=True).select("doc_id").distinct()
    return docs.join(small_or_shuffled(gone, BROADCAST_IDS), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and the digest of what they decode to."""
    coded = bpe_round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality", quality), ("lines", lines), ("near", near), ("decontamination", decontamination), ("encoding", encoding),
]
# Byte-pair encoding has no counterpart in SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
