"""Joining rows with one summary row for each key when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot with more than this share of all rows, so fewer than its inverse are.
SHARE = 1 / 1000


def with_summary(rows: DataFrame, summary: DataFrame, key: str, counted: str, total: int) -> DataFrame:
    """``rows`` joined with the ``summary`` row of their ``key``, which holds the key's number of rows in ``counted``.

    ``rows`` should be a written table, as it is read twice. At most a thousand hot keys are broadcast, so their rows stay
    where they are; the others are joined by shuffle. Null keys match each other.
    """
    name = f"__{key}"
    named = summary.withColumnRenamed(key, name)
    same = F.col(key).eqNullSafe(F.col(name))
    is_hot = F.col(counted) > F.lit(total * SHARE)
    hot = named.where(is_hot)
    of_hot = rows.join(F.broadcast(hot), same)
    others = rows.join(F.broadcast(hot.select(name)), same, "left_anti")
    return of_hot.unionByName(others.join(named.where(~is_hot), same)).drop(name)
