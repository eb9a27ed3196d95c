"""Exact medians and percentile ranks that no single task has to hold.

The built-in ``median`` and an ordered window both bring a whole group to one task. Here a group is cut by value
instead: equal values are counted first (map-side combined). While a group or a part of one holds more than ``LARGEST``
distinct values, its own least and greatest value give splitters that cut it into parts, and parts that are still too
large are cut again with splitters of their own. A value's position is its position inside the last part plus the size
of all lower parts. Splitters are spread evenly over the floating numbers between both ends, so each round narrows a part
by its number of parts, whatever the range or clustering of the values: a part of equal values is one distinct value,
and narrow, wide and clustered ranges all end after a few rounds. No task sorts more than ``LARGEST`` distinct values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.functions.scores import present, steady_round
from parcelle.params import NEUTRAL_SCORE
from parcelle.session import stored

# Distinct values of a part, that is rows a task sorts at once.
LARGEST = 65_536
# A part is cut into at least so many parts, and into enough to expect a quarter of ``LARGEST`` in each.
LEAST_PARTS = 16
# Infinite values count as the greatest number when splitters are spread.
GREATEST = 1.7976931348623157e308

# A value that holds a thousandth of its metric is heavy: at most 1000 per metric.
HEAVY_SHARE = 1_000
HEAVY_SALTS = 64

# Groups above this many rows are not sorted in one task.
HOT_ROWS = 1_000_000
# Rows are first counted by so many hashes of their keys; groups are only counted inside a hash above ``HOT_ROWS``.
HASHES = 65_536


def _spread(x: Column) -> Column:
    """A number that grows evenly over the floating numbers: sign, exponent and fraction, piecewise linear in the value."""
    size = F.abs(x)
    exponent = F.floor(F.log2(size))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * (1_100 + exponent + size / F.pow(F.lit(2.0), exponent)))


def _part(x: Column, low: Column, high: Column, parts: Column) -> Column:
    """The part of ``x`` between ``low`` and ``high``; the ends fall into the first and the last part."""
    # within a factor of two, floating numbers lie evenly
    even = ((low > 0) & (high <= 2 * low)) | ((high < 0) & (low >= 2 * high))
    bounded = [F.greatest(F.least(v, F.lit(GREATEST)), F.lit(-GREATEST)) for v in (x, low, high)]
    at, start, end = (F.when(even, v).otherwise(_spread(v)) for v in bounded)
    place = F.floor((at - start) / (end - start) * parts)
    return F.when(x == low, 0).when(x == high, parts - 1).otherwise(F.greatest(F.least(place, parts - 1), F.lit(0))).cast("int")


def _cut(counts: DataFrame, keys: Sequence[str], value: str, largest: int) -> DataFrame:
    """``counts`` with the ``_path`` of its part: the numbers of the parts it falls into, from the widest on."""
    level, done = counts.withColumn("_path", F.array().cast("array<int>")), None
    while True:
        whole = level.groupBy(*keys, "_path").agg(
            F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(F.lit(1)).alias("_values")
        ).where(F.col("_values") > largest)
        whole = stored(whole, "large-parts")
        if not whole.limit(1).count():
            return level if done is None else done.unionByName(level)
        named = whole.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_path").alias("_k_path"), "_low", "_high",
                             F.greatest(F.ceil(F.col("_values") * 4 / largest), F.lit(LEAST_PARTS)).alias("_parts"))
        match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_path") == F.col("_k_path"))
        cut = stored(level.join(named, match, "left"), "cut-values")
        columns = [*keys, value, "n", "_path"]
        small = cut.where(F.col("_parts").isNull()).select(*columns)
        done = small if done is None else done.unionByName(small)
        inner = _part(F.col(value), F.col("_low"), F.col("_high"), F.col("_parts"))
        level = cut.where(F.col("_parts").isNotNull()).withColumn("_path", F.concat("_path", F.array(inner))).select(*columns)


def ordered_values(df: DataFrame, keys: Sequence[str], value: str, largest: int | None = None) -> DataFrame:
    """Distinct values per group with ``n``, ``before`` (rows below) and ``total``."""
    counts = stored(
        df.select(*keys, present(F.col(value)).cast("double").alias(value))
        .where(F.col(value).isNotNull())
        # equal zeros are one value
        .withColumn(value, F.col(value) + F.lit(0.0))
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n")),
        "counted-values",
    )
    parts = _cut(counts, keys, value, largest or LARGEST)
    whole = Window.partitionBy(*keys)
    lower = whole.orderBy("_path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (
        parts.groupBy(*keys, "_path")
        .agg(F.sum("n").alias("_size"))
        .select(
            *[F.col(k).alias(f"_o_{k}") for k in keys],
            F.col("_path").alias("_o_path"),
            (F.sum("_size").over(lower) - F.col("_size")).alias("_offset"),
            F.sum("_size").over(whole).alias("total"),
        )
    )
    inside = (
        Window.partitionBy(*keys, "_path")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = parts.withColumn("_inside", F.sum("n").over(inside) - F.col("n"))
    match = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    match.append(F.col("_path") == F.col("_o_path"))
    return placed.join(offsets, reduce(and_, match)).select(
        *keys, value, "n", (F.col("_offset") + F.col("_inside")).alias("before"), "total"
    )


def split_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact interpolated median per group for groups of any size."""
    low = F.floor((F.col("total") - 1) / 2)
    high = F.floor(F.col("total") / 2)
    last = F.col("before") + F.col("n") - 1
    middle = ((F.col("before") <= low) & (low <= last)) | ((F.col("before") <= high) & (high <= last))
    # The two middle positions sit on one distinct value or on two: their mean.
    return (
        ordered_values(df, keys, value)
        .where(middle)
        .groupBy(*keys)
        .agg(F.avg(value).alias(out))
    )


def grouped_stats(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    medians: Mapping[str, str],
    hot_rows: int = HOT_ROWS,
    accuracy: int | None = None,
) -> DataFrame:
    """Aggregates plus exact medians (``out -> column``) per group.

    Groups up to ``hot_rows`` rows are sorted inside their task (the sort spills), which measured twice as fast as the
    built-in ``median`` buffer. Larger ones, found by a key-only count beforehand, are cut by splitters of their own values;
    without any, the plan holds no trace of them. A group has no more rows than the hash it falls into, so its keys are
    shuffled for the count only where that hash is large. ``accuracy`` asks for the approximate median instead.
    """
    if accuracy is not None:
        approx = [F.percentile_approx(c, 0.5, accuracy).alias(o) for o, c in medians.items()]
        return df.groupBy(*keys).agg(*aggregates, *approx)
    hashed = F.pmod(F.xxhash64(*keys), F.lit(HASHES))
    crowded = stored(
        df.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows).select("_hash"),
        "crowded-hashes",
    )
    some_hot = crowded.limit(1).count() > 0
    if some_hot:
        hot = stored(
            df.withColumn("_hash", hashed).join(crowded, "_hash", "left_semi")
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .where(F.col("_rows") > hot_rows)
            .select(*[F.col(k).alias(f"_h_{k}") for k in keys]),
            "large-groups",
        )
        some_hot = hot.limit(1).count() > 0
    # no hint: broadcast only if measured to be small, else shuffled
    is_hot = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    ordinary_rows = df.join(hot, is_hot, "left_anti") if some_hot else df
    # The windows and the group-by share one partitioning, and both window
    # functions one ordering: a single shuffle and a single sort.
    for out, column in medians.items():
        value = present(F.col(column))
        ordered = Window.partitionBy(*keys).orderBy(value.asc_nulls_last())
        everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        known, place = F.count(value).over(everything), F.row_number().over(ordered)
        ordinary_rows = ordinary_rows.withColumns({"_known": known, "_place": place}).withColumn(
            f"_mid_{out}",
            F.when(
                F.col("_place").between(
                    F.floor((F.col("_known") + 1) / 2), F.floor(F.col("_known") / 2) + 1
                ),
                value,
            ),
        )
    ordinary = ordinary_rows.groupBy(*keys).agg(
        *aggregates, *[F.avg(f"_mid_{o}").alias(o) for o in medians]
    )
    if not some_hot:
        return ordinary
    large_rows = df.join(hot, is_hot, "left_semi")
    grouped = large_rows.groupBy(*keys)
    large = grouped.agg(*aggregates) if aggregates else large_rows.select(*keys).distinct()
    for out, column in medians.items():
        part = split_median(large_rows, keys, column, out)
        part = part.select(*[F.col(k).alias(f"_m_{k}") for k in keys], out)
        match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
        large = large.join(part, match, "left").drop(*[f"_m_{k}" for k in keys])
    return ordinary.unionByName(large)


def metric_rows(df: DataFrame, key: str | None, metrics: Mapping[str, Column]) -> DataFrame:
    """Wide to long: one (key, metric, value) row per non-null metric."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), present(c).alias("value"))
            for name, c in metrics.items()
        ]
    )
    kept = [key] if key else []
    return df.select(*kept, F.inline(pairs)).where(F.col("value").isNotNull())


def global_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, median) rows: the exact median of whole columns."""
    rows = metric_rows(df, None, {c: F.col(c) for c in columns})
    return split_median(rows, ["metric"], "value", "median")


def fill_with_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null becomes the column's median; an all-null column stays null."""
    pairs = F.collect_list(F.struct("metric", "median"))  # one entry per column
    medians = global_medians(df, columns).agg(F.map_from_entries(pairs)).scalar()
    return (
        df.withColumn("_medians", medians)
        .withColumns(
            {
                c: F.coalesce(present(F.col(c)), F.try_element_at(F.col("_medians"), F.lit(c)))
                for c in columns
            }
        )
        .drop("_medians")
    )


def percent_ranks(df: DataFrame, key: str, metrics: Mapping[str, Column]) -> DataFrame:
    """(key, one share in (0, 1] per metric): mean rank of ties over non-null count.

    ``key`` is unique. All metrics go through one set of shuffles. The way back
    from distinct value to row is a join on the value, where one value may hold a
    large share of the rows; those few values are salted on both sides.
    """
    rows = metric_rows(df, key, metrics)
    shares = ordered_values(rows, ["metric"], "value").select(
        "metric",
        "value",
        ((F.col("before") + (F.col("n") + 1) / 2) / F.col("total")).alias("share"),
        (F.col("n") * HEAVY_SHARE >= F.col("total")).alias("heavy"),
    )
    # At most HEAVY_SHARE rows per metric, whatever the input size.
    heavy = F.broadcast(shares.where("heavy").select("metric", "value", "heavy"))
    salted_rows = rows.join(heavy, ["metric", "value"], "left").select(
        key,
        "metric",
        "value",
        F.when(F.col("heavy"), F.pmod(F.xxhash64(key), F.lit(HEAVY_SALTS)))
        .otherwise(0)
        .cast("int")
        .alias("salt"),
    )
    salted_shares = shares.select(
        "metric",
        "value",
        "share",
        F.explode(
            F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(HEAVY_SALTS - 1))).otherwise(
                F.array(F.lit(0))
            )
        ).alias("salt"),
    )
    return (
        salted_rows.join(salted_shares, ["metric", "value", "salt"])
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("metric") == m, F.col("share"))).alias(m) for m in metrics])
    )


def rank_scores(
    df: DataFrame,
    key: str,
    metrics: Mapping[str, Column],
    inverse: Sequence[str] = (),
    rounded: bool = True,
) -> DataFrame:
    """Adds one 0-100 percentile score per metric; a missing value scores neutral."""
    shares = percent_ranks(df, key, metrics)
    renamed = shares.select(key, *[F.col(m).alias(f"_share_{m}") for m in metrics])

    def score(name: str) -> Column:
        filled = F.coalesce(F.col(f"_share_{name}") * 100, F.lit(NEUTRAL_SCORE))
        turned = F.lit(100.0) - filled if name in inverse else filled
        return steady_round(turned, 2) if rounded else turned

    return (
        df.join(renamed, key, "left")
        .withColumns({m: score(m) for m in metrics})
        .drop(*[f"_share_{m}" for m in metrics])
    )
