"""Enrichment, lookup, translation and completeness joins.

No side is hinted as broadcast: the dimensions may grow, so the choice is left to
the planner, which broadcasts a side only once its measured size is below the
session threshold and otherwise shuffles and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.params import EQUIPMENT_CODES, PROPERTY_TAX_DEFAULT, PROPERTY_TAX_RATES


def with_region_names(communes: DataFrame, regions: DataFrame | None) -> DataFrame:
    if regions is None:
        return communes.withColumn("nom_region", F.lit(None).cast("string"))
    return communes.join(regions.select("code_region", "nom_region"), "code_region", "left")


def communes_with_prices(communes: DataFrame, gold: DataFrame) -> DataFrame:
    return communes.join(gold.drop("nom_commune"), "code_commune", "inner")


def enrich(
    df: DataFrame,
    optional: DataFrame | None,
    on: str | Sequence[str],
    defaults: Mapping[str, object],
) -> DataFrame:
    """Left join with a source that may be absent: then its columns get defaults."""
    if optional is None:
        return df.withColumns(
            {
                name: value if isinstance(value, Column) else F.lit(value)
                for name, value in defaults.items()
            }
        )
    return df.join(optional, on, "left")


def literal_lookup(key: Column, table: Mapping[str, object], default=None) -> Column:
    """Value of a small fixed table, held as a map literal in the plan."""
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    found = F.try_element_at(F.create_map(*pairs), key)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def equipment_categories(spark: SparkSession) -> DataFrame:
    """The fixed code table (TYPEQU, category), under 200 rows."""
    rows = [F.struct(F.lit(code).alias("TYPEQU"), F.lit(name).alias("category")) for name, codes in EQUIPMENT_CODES.items() for code in codes]
    return spark.range(1).select(F.inline(F.array(*rows)))


def property_tax_rate(department: Column) -> Column:
    return literal_lookup(department, PROPERTY_TAX_RATES, PROPERTY_TAX_DEFAULT)


def merge_rents(all_flats: DataFrame, small: DataFrame, large: DataFrame) -> DataFrame:
    """Three rent tables side by side on the commune, with an active-market flag."""
    merged = all_flats.join(small, "code_commune", "left").join(large, "code_commune", "left")
    return merged.withColumn(
        "marche_locatif_actif", F.coalesce(F.col("nb_annonces_app"), F.lit(0)) > 0
    )


def postal_lookup(communes: DataFrame) -> DataFrame:
    """code -> commune: valid codes map to themselves, a postal code to its most
    populous commune (larger code on a tie). ``codes_postaux`` is comma-joined."""
    valid = communes.where(F.col("code_commune").isNotNull()).select(
        F.col("code_commune").alias("lookup_code"), F.col("code_commune").alias("translated")
    ).distinct()
    postal = (
        communes.select(
            F.explode(F.split("codes_postaux", ",")).alias("postal"), "code_commune", "population"
        )
        .select(F.trim("postal").alias("lookup_code"), "code_commune", "population")
        .where(F.col("lookup_code") != "")
        .groupBy("lookup_code")
        .agg(
            F.max_by(
                "code_commune",
                F.struct(F.coalesce(F.col("population"), F.lit(-1)), F.col("code_commune")),
            ).alias("translated")
        )
    )
    return valid.unionByName(postal.join(valid, "lookup_code", "left_anti"))


def translate_codes(df: DataFrame, communes: DataFrame, column: str = "commune_code") -> DataFrame:
    """Postal codes become commune codes; unknown codes stay."""
    lookup = postal_lookup(communes)
    return (
        df.join(lookup, F.col(column) == F.col("lookup_code"), "left")
        .withColumn(column, F.coalesce(F.col("translated"), F.col(column)))
        .drop("lookup_code", "translated")
    )


def orphans(df: DataFrame, reference: DataFrame, key: str = "code_commune") -> DataFrame:
    """Rows per key and name that the reference does not know.

    Counted before the anti join, so the join sees one row per key.
    """
    counted = df.groupBy(key, "nom_commune").agg(F.count(F.lit(1)).alias("lignes"))
    return counted.join(reference.select(key), key, "left_anti")


def complete_counts(
    communes: DataFrame, counts: DataFrame, columns: Sequence[str], key: str = "code_commune"
) -> DataFrame:
    """Every commune appears; an absent count is zero."""
    return (
        communes.select(key)
        .join(counts, key, "left")
        .na.fill(0, subset=list(columns))
        .select(key, *[F.col(c).cast("int").alias(c) for c in columns])
    )


def star_rows(mart: DataFrame, communes: DataFrame, departments: DataFrame, regions: DataFrame) -> DataFrame:
    """mart x commune x department x region on natural keys."""
    geo = (
        communes.select("code_commune", "code_departement")
        .join(departments.select("code_departement", "nom_departement", "code_region"), "code_departement")
        .join(regions.select("code_region", "nom_region"), "code_region")
    )
    return mart.join(geo, "code_commune")


def with_predictions(df: DataFrame, predictions: DataFrame) -> DataFrame:
    return df.join(
        predictions.select("code_commune", "predicted_avg_price_m2", "predicted_growth_pct"),
        "code_commune",
        "left",
    )


def named_sentiment(sentiment: DataFrame, communes: DataFrame) -> DataFrame:
    return sentiment.join(communes.select("code_commune", "nom_commune"), "code_commune", "left").withColumn(
        "nom_commune", F.coalesce("nom_commune", "code_commune")
    )


def listing_gap(prices: DataFrame, listing_means: DataFrame) -> DataFrame:
    """How far asking prices lie above sale prices, per cent."""
    sale, asked = F.col("avg_price_m2"), F.col("avg_listing_price_m2")
    return prices.join(
        listing_means.select("code_commune", "avg_listing_price_m2"), "code_commune"
    ).withColumn("ecart_pct", F.try_divide(asked - sale, sale) * 100)
