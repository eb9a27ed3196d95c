"""Writers, external tables, lineage and the database target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelle.plans.silver import bronze_sales
from parcelle.sources.commits import by_commits, sync_partitions

# --- fixed values: declared tables ------------------------------------------------
TABLES = {
    "regions": ("code_region STRING, nom_region STRING", ()),
    "departements": ("code_departement STRING, nom_departement STRING, code_region STRING", ()),
    "communes": (
        "code_commune STRING, nom_commune STRING, code_departement STRING, code_region STRING, "
        "latitude DOUBLE, longitude DOUBLE, population INT", (),
    ),
    "gold_real_estate": (
        "code_commune STRING, nom_commune STRING, year INT, transaction_count BIGINT, avg_price DOUBLE, "
        "avg_price_m2 DOUBLE, median_price_m2 DOUBLE, avg_surface DOUBLE, price_m2_yoy_variation DOUBLE, "
        "annee INT", ("annee",),
    ),
    "gold_territory_scores": (
        "code_commune STRING, nom_commune STRING, code_departement STRING, code_region STRING, region STRING, "
        "latitude DOUBLE, longitude DOUBLE, population INT, avg_price_m2 DOUBLE, avg_price DOUBLE, "
        "median_price_m2 DOUBLE, transaction_count BIGINT, annual_price_growth DOUBLE, "
        "affordability_score DOUBLE, transport_score DOUBLE, network_score DOUBLE, green_score DOUBLE, "
        "services_score DOUBLE, education_score DOUBLE, health_score DOUBLE, "
        "investment_potential_score DOUBLE, income_score DOUBLE, score_etudiant DOUBLE, "
        "score_jeune_actif DOUBLE, score_famille DOUBLE, score_personne_agee DOUBLE, score_investisseur DOUBLE", (),
    ),
    "bronze_listings": (
        "listing_id STRING, source STRING, commune_code STRING, city STRING, price DOUBLE, surface_m2 DOUBLE, "
        "price_m2 DOUBLE, rooms INT, postal_code STRING, property_type STRING, url STRING, scraped_at STRING, "
        "source_name STRING, source_date STRING, batch_id BIGINT", ("source_name", "source_date", "batch_id"),
    ),
    "silver_listings": (
        "code_commune STRING, listing_count BIGINT, avg_listing_price_m2 DOUBLE, "
        "median_listing_price_m2 DOUBLE, min_listing_price_m2 DOUBLE, max_listing_price_m2 DOUBLE, "
        "last_updated STRING, source_name STRING", ("source_name",),
    ),
    "network_coverage": (
        "code_commune STRING, operator STRING, coverage_4g_score DECIMAL(5,2), coverage_5g_score DECIMAL(5,2), source STRING", (),
    ),
    "transport_access": (
        "code_commune STRING, transport_score DECIMAL(5,2), nearest_station_distance DECIMAL(10,2), source STRING", (),
    ),
    "socio_economic_indicators": (
        "code_commune STRING, year INT, median_income DECIMAL(12,2), unemployment_rate DECIMAL(5,2), "
        "population_density DECIMAL(10,2), source STRING", (),
    ),
}


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrites only the partitions present in ``df``.

    Tasks write what they hold, without a shuffle by partition column, so a
    partition with most of the rows is written by many tasks.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_bronze(raw: DataFrame, year: int, path: str) -> int:
    """Bronze table of a year; an empty input is an error. Returns the row count."""
    seen = Observation()
    rows = bronze_sales(raw, year).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(path)
    written = seen.get["rows"]
    if not written:
        raise ValueError(f"no rows found for {year}")
    return written


def lineage(spark: SparkSession, table: str, source: str, dataset: str, year: int | None, target: str,
            counts: Mapping[str, int]) -> None:
    """Appends one row about an import to the lineage table."""
    row = spark.range(1).select(
        F.lit(source).alias("source"), F.lit(dataset).alias("dataset"), F.lit(year).cast("int").alias("year"),
        F.lit(target).alias("target"), F.current_timestamp().alias("imported_at"),
        F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
        .cast("map<string,bigint>").alias("row_counts"),
    )
    row.write.mode("append").parquet(table)


def register_tables(spark: SparkSession, root: str, names: Sequence[str] | None = None, database: str | None = None) -> None:
    """External Parquet tables under ``root`` with their partitions: those of the commit log where there is one (what streams
    write), else the folders found. A ``database`` is made if need be."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names or TABLES:
        columns, by = TABLES[name]
        full = f"{database}.{name}" if database else name
        partitioned = f"PARTITIONED BY ({', '.join(by)})" if by else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING PARQUET {partitioned} LOCATION '{root}/{name}'"
        )
        if by:
            repair(spark, full, f"{root}/{name}")


def repair(spark: SparkSession, name: str, path: str) -> None:
    """Picks up partition folders written since, and lets go of those a compaction replaced."""
    if by_commits(spark, path):
        sync_partitions(spark, name, path)
        return
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def as_declared(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns that table ``name`` declares in their types (null where a text is no such value)."""
    types = {c.split()[0]: c.split()[1] for c in TABLES[name][0].split(", ")}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def register_views(spark: SparkSession) -> None:
    """The two serving views; sorting is left to the reader."""
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY VIEW vw_commune_full AS
        SELECT t.*, l.avg_listing_price_m2, l.listing_count
        FROM gold_territory_scores t
        LEFT JOIN (
            SELECT code_commune, avg(avg_listing_price_m2) AS avg_listing_price_m2,
                   sum(listing_count) AS listing_count
            FROM silver_listings GROUP BY code_commune
        ) l ON l.code_commune = t.code_commune
        """
    )
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY VIEW vw_ranking AS
        SELECT code_commune, nom_commune, region, avg_price_m2, affordability_score, transport_score,
               network_score, score_etudiant, score_jeune_actif, score_famille, score_personne_agee,
               score_investisseur
        FROM gold_territory_scores
        """
    )


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch: int = 5_000) -> None:
    """Reloads a database table in place; the driver jar comes with the cluster."""
    (
        df.write.mode("overwrite")
        .options(truncate=True, batchsize=batch)
        .jdbc(url, table, properties=dict(properties))
    )
