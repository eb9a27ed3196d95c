"""Grouped counts and means. All are map-side combined before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.cleaning import commune_code, to_number
from parcelle.functions.order_stats import grouped_stats
from parcelle.functions.scores import row_mean
from parcelle.operators.columns import is_4g, is_5g, resolve_by_pattern
from parcelle.operators.filters import apartments
from parcelle.operators.joins import equipment_categories
from parcelle.params import (
    EQUIPMENT_CODE_COLUMNS, EQUIPMENT_CODES, NETWORK_CODE_COLUMNS, POI_TYPES,
)


def pivot_counts(df: DataFrame, key: str, category: str, outputs: Mapping[str, str]) -> DataFrame:
    """One zero-filled count per category (``value -> output``) in a single aggregate."""
    return df.groupBy(key).agg(
        *[F.count_if(F.col(category) == value).alias(out) for value, out in outputs.items()]
    )


def equipment_counts(equipment: DataFrame) -> DataFrame:
    """Equipment rows to eight counts per commune; unmapped codes are dropped."""
    code = resolve_by_pattern(equipment.columns, EQUIPMENT_CODE_COLUMNS)
    if code is None:
        raise ValueError(f"no commune code column among {equipment.columns}")
    rows = equipment.select(
        commune_code(F.col(code)).alias("code_commune"), F.upper(F.trim("TYPEQU")).alias("TYPEQU")
    ).join(F.broadcast(equipment_categories(equipment.sparkSession)), "TYPEQU")
    return pivot_counts(rows, "code_commune", "category", {c: c for c in EQUIPMENT_CODES})


def equipment_for_scores(counts: DataFrame) -> DataFrame:
    """The columns the scores expect: stops from transport, no trains, no forests."""
    added = {}
    if "bus_stop_count" not in counts.columns:
        added["bus_stop_count"] = F.col("transport_count")
    for absent in ("train_station_count", "forest_count"):
        if absent not in counts.columns:
            added[absent] = F.lit(0)
    return counts.withColumns(added)


def poi_counts(points: DataFrame) -> DataFrame:
    """Assigned points to ten counts per commune."""
    return pivot_counts(points, "code_commune", "poi_type", {t: f"{t}_count" for t in POI_TYPES})


def network_coverage(sites: DataFrame) -> DataFrame | None:
    """Mean of the 4G and 5G columns per commune, then the mean of the two."""
    code = resolve_by_pattern(
        sites.columns, NETWORK_CODE_COLUMNS, lambda c: "com" in c and "insee" in c
    )
    found = {
        "_4g": resolve_by_pattern(sites.columns, pattern=is_4g),
        "_5g": resolve_by_pattern(sites.columns, pattern=is_5g),
    }
    used = {k: v for k, v in found.items() if v}
    if code is None or not used:
        return None
    return (
        sites.select(
            commune_code(F.col(code)).alias("code_commune"),
            *[to_number(F.col(v)).alias(k) for k, v in used.items()],
        )
        .groupBy("code_commune")
        .agg(*[F.avg(k).alias(k) for k in used])
        .select("code_commune", row_mean([F.col(k) for k in used]).alias("network_score_raw"))
    )


def stop_flags(counts: DataFrame, routes_known: bool) -> DataFrame:
    """Mode flags: only bus can be told, and only if routes are known."""
    return counts.withColumns(
        {
            "has_train": F.lit(False), "has_metro": F.lit(False),
            "has_tram": F.lit(False), "has_bus": F.lit(routes_known),
        }
    )


def rental_values(rows: DataFrame) -> DataFrame:
    """Median rental value per commune over flats; communes without one drop out."""
    kept = apartments(rows) if "nature_locaux" in rows.columns else rows
    values = kept.select(
        commune_code(F.col("code_commune")).alias("code_commune"),
        to_number(F.col("vl_au_m2")).alias("vl"),
    )
    return grouped_stats(values, ["code_commune"], [], {"vl_m2_commune": "vl"}).where(
        F.col("vl_m2_commune").isNotNull()
    )


def listing_stats(listings: DataFrame) -> DataFrame:
    return grouped_stats(
        listings.where(F.col("source").isNotNull()),
        ["source", "commune_code"],
        [
            F.count(F.lit(1)).alias("listing_count"),
            F.avg("price_m2").alias("avg_listing_price_m2"),
            F.min("price_m2").alias("min_listing_price_m2"),
            F.max("price_m2").alias("max_listing_price_m2"),
            F.max("scraped_at").alias("last_updated"),
        ],
        {"median_listing_price_m2": "price_m2"},
    ).select(
        F.col("source").alias("source_name"),
        F.col("commune_code").alias("code_commune"),
        "listing_count", "avg_listing_price_m2", "median_listing_price_m2",
        "min_listing_price_m2", "max_listing_price_m2", "last_updated",
    )


def weighted_listing_mean(stats: DataFrame) -> DataFrame:
    """Across sources, weighted by the number of listings."""
    n = F.col("listing_count")
    return stats.groupBy("code_commune").agg(
        F.sum(n).alias("listing_count"),
        F.try_divide(F.sum(F.col("avg_listing_price_m2") * n), F.sum(n)).alias("avg_listing_price_m2"),
    )


def plain_listing_mean(stats: DataFrame) -> DataFrame:
    """Across sources, every source alike."""
    return stats.groupBy("code_commune").agg(
        F.avg("avg_listing_price_m2").alias("avg_listing_price_m2"),
        F.sum("listing_count").alias("listing_count"),
    )


def roll_up(df: DataFrame, key: str, quality: str | None = None) -> DataFrame:
    """Communes, population and mean price per region or department.

    The distinct count goes through one row per (key, commune) first, so its
    shuffle spreads over communes and not over the few keys.
    """
    sums = [
        F.sum("population").alias("_pop"),
        F.sum("avg_price_m2").alias("_price"),
        F.count("avg_price_m2").alias("_priced"),
    ]
    if quality:
        sums += [F.sum(quality).alias("_quality"), F.count(quality).alias("_rated")]
    per_commune = df.where(F.col(key).isNotNull()).groupBy(key, "code_commune").agg(*sums)
    outputs = [
        F.count("code_commune").alias("communes"),
        F.sum("_pop").alias("population"),
        F.try_divide(F.sum("_price"), F.sum("_priced")).alias("prix_m2_moyen"),
    ]
    if quality:
        outputs.append(F.try_divide(F.sum("_quality"), F.sum("_rated")).alias("score_qualite"))
    return per_commune.groupBy(key).agg(*outputs)


def filled_share(df: DataFrame, column: str, out: str) -> DataFrame:
    """Per cent of rows where the column is known; null for an empty table."""
    return df.agg(
        F.round(F.try_divide(100.0 * F.count_if(F.col(column).isNotNull()), F.count(F.lit(1))), 1).alias(out)
    )


def table_volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(name).alias("table"), "lignes")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mean_of(df: DataFrame, column: str, digits: int, out: str) -> DataFrame:
    return df.agg(F.round(F.avg(column), digits).alias(out))


def means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])
