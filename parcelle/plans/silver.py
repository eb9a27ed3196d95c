"""Bronze to silver: typed, valid, distinct sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions import cleaning as c
from parcelle.operators.columns import computed_once, normalize_columns, resolve_columns
from parcelle.operators.dedup import exact_rows
from parcelle.operators.filters import valid_sales
from parcelle.params import SALE_COLUMNS


def bronze_sales(raw: DataFrame, year: int) -> DataFrame:
    """Normalised headers, texts only, year and source file."""
    rows = normalize_columns(raw)
    texts = [F.col(n).cast("string").alias(n) for n in rows.columns if n != "source_file"]
    origin = F.col("source_file") if "source_file" in rows.columns else F.lit(None).cast("string")
    return rows.select(*texts, F.lit(year).alias("source_year"), origin.alias("source_file"))


def clean_sales(resolved: DataFrame, year) -> DataFrame:
    """Coerces the logical columns; a missing commune code stays null and drops out."""
    parsed = computed_once(
        resolved,
        {
            "_date": c.to_timestamp(F.col("date_mutation")),
            "_amount": c.to_number(F.col("valeur_fonciere")),
            "_surface": c.to_number(F.col("surface_reelle_bati")),
            "_code": c.commune_code(F.col("code_commune")),
        },
    )
    typed = parsed.select(
        F.col("_date").alias("date_mutation"),
        F.col("_amount").alias("valeur_fonciere"),
        F.col("_surface").alias("surface_reelle_bati"),
        c.to_int(F.col("nombre_pieces")).alias("nombre_pieces"),
        F.col("type_local").cast("string").alias("type_local"),
        F.col("_code").alias("code_commune"),
        c.title_case(F.col("nom_commune")).alias("nom_commune"),
        c.postal_code(F.col("code_postal")).alias("code_postal"),
        c.unit_price(F.col("_amount"), F.col("_surface")).alias("prix_m2"),
        F.lit("DVF").alias("source"),
        (year if not isinstance(year, int) else F.lit(year)).alias("year"),
    )
    return exact_rows(valid_sales(typed))


def silver_sales(bronze: DataFrame, year: int) -> DataFrame:
    return clean_sales(resolve_columns(bronze, SALE_COLUMNS), year)
