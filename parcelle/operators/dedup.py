"""Duplicate removal and best-row-per-key.

``row_number() <= k`` is planned with a group limit on the map side, so a key that
holds a large share of the rows sends at most k rows per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def latest_snapshot(
    df: DataFrame,
    keys: Sequence[str] = ("source", "listing_id"),
    order: str = "scraped_at",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Last row per key; rows with a blank id are all distinct and stay."""
    id_column = keys[-1]
    has_id = F.coalesce(F.col(id_column).cast("string"), F.lit("")) != ""
    newest = [F.col(order).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]]
    return top_per_key(df.where(has_id), keys, newest).unionByName(df.where(~has_id))
