"""Shared pieces: column picking, joins with a checked broadcast, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.session import work_folder

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
LAST = (1 << 63) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` under the shared checkpoint folder and reads it back.

    The files outlive executors, so a later step never recomputes the lineage.
    """
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    # finished steps' shuffle files go once the JVM notices that nobody refers to them
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def picked(df: DataFrame, id_column: str, text_column: str, carry: list[str] | None = None) -> DataFrame:
    """Only the id and the text, under fixed names, whatever else the table holds; ``carry`` goes along in a struct."""
    more = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    return df.select(
        *more,
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def keyed(docs: DataFrame, id_column: str, text_column: str, carry: list[str] | None = None) -> DataFrame:
    """``(key, place, doc_id, text)``: a key for each row and its place in the order of ids (null ids last).

    The id is the key where it is unique; else rows are numbered in a written copy, so that a lost task
    finds the same numbers again.
    """
    texts = picked(docs, id_column, text_column, carry).withColumn("place", F.coalesce("doc_id", F.lit(LAST)))
    repeated = texts.groupBy("place").count().where("count > 1").limit(1).count()
    if not repeated:
        return texts.withColumn("key", F.col("place"))
    return kept_table(texts.withColumn("key", F.monotonically_increasing_id()), "keyed")


def small_or_shuffled(df: DataFrame, bound: int) -> DataFrame:
    """A broadcast hint only if ``df`` is counted to hold at most ``bound`` rows.

    Beyond the bound the planner joins by shuffle and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if df.count() <= bound else df


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)`` with the least node of each.

    Alternates large-star and small-star steps. Every node sends its neighbours to the least one
    it knows, so a hot node's rows spread over its neighbours; each round is a written table and
    the rounds grow with the logarithm of the longest path.
    """
    links = kept_table(
        edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(),
        "links",
    )
    while True:
        both = links.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(links.select("hi", "lo"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
            .where("lo <> hi").distinct()
        )
        # small star: each node links all its lower neighbours, and itself, to the least of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(low, "hi").select(F.explode(F.array("lo", "hi")).alias("hi"), F.col("m").alias("lo"))
            .where("lo <> hi").distinct()
        )
        after = kept_table(small, "links")
        changed = after.join(links, ["lo", "hi"], "left_anti").limit(1).count() or (
            links.join(after, ["lo", "hi"], "left_anti").limit(1).count()
        )
        links = after
        if not changed:
            break
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        links.select("lo", "lo").distinct()
    )
