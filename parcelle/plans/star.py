"""Star tables on natural keys, and the BI extract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions.cleaning import first_postal, to_decimal
from parcelle.plans.territory import star_scores


@dataclass(frozen=True)
class Star:
    regions: DataFrame
    departements: DataFrame
    communes: DataFrame
    real_estate_transactions: DataFrame
    territorial_scores: DataFrame


def star_departments(departments: DataFrame, regions: DataFrame) -> DataFrame:
    """Departments with their region code, null where the region is unknown."""
    known = regions.select(F.col("code_region").alias("_known"))
    return departments.join(known, F.col("code_region") == F.col("_known"), "left").select(
        "code_departement", "nom_departement", F.col("_known").alias("code_region")
    )


def star_communes(communes: DataFrame, departments: DataFrame) -> DataFrame:
    known = departments.select(F.col("code_departement").alias("_known"))
    return communes.join(known, F.col("code_departement") == F.col("_known"), "left").select(
        "code_commune", "nom_commune", first_postal(F.col("codes_postaux")).alias("code_postal"),
        F.col("_known").alias("code_departement"), "latitude", "longitude",
        F.col("population").cast("int").alias("population"),
    )


def star_sales(sales: DataFrame, communes: DataFrame) -> DataFrame:
    """Sales of known communes, amounts as decimals. The semi join keeps the sales
    side in place when the measured commune list is small, and splits skewed
    communes when it is not."""
    return sales.join(communes.select("code_commune"), "code_commune", "left_semi").select(
        F.col("date_mutation").cast("date").alias("date_mutation"),
        to_decimal(F.col("valeur_fonciere")).alias("valeur_fonciere"),
        to_decimal(F.col("surface_reelle_bati"), 12).alias("surface_reelle_bati"),
        "nombre_pieces", "type_local", "code_commune",
        to_decimal(F.col("prix_m2")).alias("prix_m2"), "source",
    )


def unmapped(sales: DataFrame, communes: DataFrame) -> DataFrame:
    """How many sales name an unknown commune."""
    per_code = sales.groupBy("code_commune").agg(F.count(F.lit(1)).alias("n"))
    lost = per_code.join(communes.select("code_commune"), "code_commune", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ventes_ecartees"))


def load_star(
    regions: DataFrame, departments: DataFrame, communes: DataFrame,
    sales: DataFrame, scores: DataFrame, year: int,
) -> Star:
    return Star(
        regions=regions.select("code_region", "nom_region"),
        departements=star_departments(departments, regions),
        communes=star_communes(communes, departments),
        real_estate_transactions=star_sales(sales, communes),
        territorial_scores=star_scores(scores, communes, year),
    )


def write_star(star: Star, root: str) -> None:
    """Truncate-and-reload: every table is replaced."""
    for name in Star.__dataclass_fields__:
        getattr(star, name).write.mode("overwrite").parquet(f"{root}/{name}")


def bi_mart(history: DataFrame) -> DataFrame:
    """History as the BI mart (population unknown there)."""
    return history.select(
        "nom_commune", "code_commune", "year", "transaction_count", "avg_price", "avg_price_m2",
        "median_price_m2", "avg_surface", F.lit(None).cast("int").alias("population"),
    )


def export_marts(
    history: DataFrame, predictions: DataFrame | None, texts: DataFrame | None
) -> dict[str, DataFrame]:
    out = {"mart_commune_real_estate": bi_mart(history)}
    if predictions is not None:
        out["price_predictions"] = predictions.where(
            F.col("target_year") == predictions.agg(F.max("target_year")).scalar()
        )
    if texts is not None:
        out["nlp_sentiment"] = texts.select("code_commune", "n_texts", "sentiment_score", "sentiment_label")
    return out
