"""Silver sales to the commune price mart and its SQL-style views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from parcelle.functions.cleaning import first_of_january, like_or_all, to_decimal
from parcelle.functions.order_stats import HOT_ROWS, grouped_stats
from parcelle.operators.filters import enough_sales, plausible_prices
from parcelle.operators.joins import star_rows
from parcelle.params import GOLD_PRICE_M2

# Of a price sketch: size, and the share of rows by which a median's rank may be off.
SKETCH_SIZE, SKETCH_ERROR = 400, 0.01

GOLD_COLUMNS = [
    "code_commune", "nom_commune", "year", "transaction_count", "avg_price", "avg_price_m2",
    "median_price_m2", "avg_surface", "price_m2_yoy_variation",
]


def commune_prices(
    sales: DataFrame, hot_rows: int = HOT_ROWS, accuracy: int | None = None
) -> DataFrame:
    """Per commune, name and year: sales, means, median; at least three sales."""
    stats = grouped_stats(
        plausible_prices(sales),
        ["code_commune", "nom_commune", "year"],
        [
            F.count(F.lit(1)).alias("transaction_count"),
            F.avg("valeur_fonciere").alias("avg_price"),
            F.avg("prix_m2").alias("avg_price_m2"),
            F.avg("surface_reelle_bati").alias("avg_surface"),
        ],
        {"median_price_m2": "prix_m2"},
        hot_rows=hot_rows,
        accuracy=accuracy,
    )
    return enough_sales(stats)


def counted_prices(sales: DataFrame) -> tuple[DataFrame, Observation]:
    """``sales`` as they are; the rows read and those the price bounds remove are counted by whatever reads them first."""
    seen = Observation()
    fits = F.coalesce(F.col("prix_m2").between(*GOLD_PRICE_M2), F.lit(False))
    return sales.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~fits).alias("removed")), seen


def price_sketches(sales: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per commune and year: number of plausible prices and a mergeable sketch of them.

    Stored with the mart, sketches give medians of any grouping of communes and years without the sales. The sketch's
    memory is bounded by ``size``; medians are off by at most ``SKETCH_ERROR`` of the rows, almost surely.
    """
    return plausible_prices(sales).groupBy("code_commune", "year").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.kll_sketch_agg_double("prix_m2", F.lit(size)).alias("price_sketch")
    )


def merged_medians(sketches: DataFrame, by: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """Approximate medians of the groups ``by`` from the sketches of their parts."""
    merged = sketches.groupBy(*by).agg(
        F.sum("transaction_count").alias("transaction_count"), F.kll_merge_agg_double("price_sketch", F.lit(size)).alias("_sketch")
    )
    median = F.kll_sketch_get_quantile_double("_sketch", F.lit(0.5))
    return merged.select(*by, "transaction_count", median.alias("median_price_m2"))


def with_yoy(gold: DataFrame) -> DataFrame:
    """Change against the previous year within one history table.

    A frame of exactly one year back replaces the self join: the mart is shuffled
    once by commune and a commune has only its few years. Several spellings of a
    commune in the previous year count as one price, weighted by sales.
    """
    year_before = Window.partitionBy("code_commune").orderBy("year").rangeBetween(-1, -1)
    price, n = F.col("avg_price_m2"), F.col("transaction_count")
    previous = F.sum(price * n).over(year_before) / F.sum(n).over(year_before)
    change = F.when(F.col("code_commune").isNotNull(), F.try_divide(price - previous, previous))
    return gold.withColumn("price_m2_yoy_variation", change).select(*GOLD_COLUMNS)


def with_previous(gold: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Change against the stored mart of the previous year (null without one)."""
    if previous is None:
        return gold.withColumn("price_m2_yoy_variation", F.lit(None).cast("double")).select(*GOLD_COLUMNS)
    n = F.col("transaction_count")
    per_code = previous.groupBy("code_commune").agg(
        F.try_divide(F.sum(F.col("avg_price_m2") * n), F.sum(n)).alias("_previous")
    )
    price = F.col("avg_price_m2")
    return (
        gold.join(per_code, "code_commune", "left")
        .withColumn("price_m2_yoy_variation", F.try_divide(price - F.col("_previous"), F.col("_previous")))
        .select(*GOLD_COLUMNS)
    )


def commune_year_view(sales: DataFrame, communes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sales x communes per calendar year. Aggregated first, joined after."""
    stats = grouped_stats(
        sales.where(F.col("prix_m2").isNotNull()).withColumn("year", F.year("date_mutation")),
        ["code_commune", "year"],
        [
            F.count(F.lit(1)).alias("transaction_count"),
            F.avg("valeur_fonciere").alias("avg_price"),
            F.avg("prix_m2").alias("avg_price_m2"),
            F.avg("surface_reelle_bati").alias("avg_surface"),
        ],
        {"median_price_m2": "prix_m2"},
        hot_rows=hot_rows,
    )
    return stats.join(communes.select("code_commune", "nom_commune", "population"), "code_commune")


def sql_view(sales: DataFrame, communes: DataFrame) -> DataFrame:
    """The declared view: amounts as NUMERIC(14, 2)."""
    view = commune_year_view(sales, communes)
    return view.select(
        "code_commune", "nom_commune", "year", "transaction_count",
        *[to_decimal(F.col(c)).alias(c) for c in ("avg_price", "avg_price_m2", "median_price_m2")],
    )


def commune_mart(sales: DataFrame, communes: DataFrame) -> DataFrame:
    """The BI mart: population and amounts rounded to cents."""
    view = commune_year_view(sales, communes)
    return view.select(
        "code_commune", "nom_commune", "population", "year", "transaction_count",
        *[to_decimal(F.col(c)).alias(c)
          for c in ("avg_price", "avg_price_m2", "median_price_m2", "avg_surface")],
    )


def of_latest_year(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("year") == mart.agg(F.max("year")).scalar())


def latest_year_average(mart: DataFrame) -> DataFrame:
    return of_latest_year(mart).agg(F.round(F.avg("avg_price_m2"), 0).alias("prix_moyen"))


def region_year_series(
    mart: DataFrame, communes: DataFrame, departments: DataFrame, regions: DataFrame, region: str = "%"
) -> DataFrame:
    """Mean and median commune price per year. A year is a large group, so the
    median is the one cut by value."""
    rows = star_rows(mart, communes, departments, regions).where(like_or_all(F.col("nom_region"), region))
    rows = rows.withColumn("prix", F.col("avg_price_m2").cast("double"))
    series = grouped_stats(
        rows, ["year"], [F.avg("prix").alias("prix_moyen")], {"prix_median": "prix"}
    )
    return series.select(
        first_of_january(F.col("year")).alias("time"),
        F.round("prix_moyen", 0).alias("prix_moyen"),
        F.round("prix_median", 0).alias("prix_median"),
    )


def top_departments(
    mart: DataFrame, communes: DataFrame, departments: DataFrame, regions: DataFrame,
    region: str = "%", limit: int = 12,
) -> DataFrame:
    rows = star_rows(of_latest_year(mart), communes, departments, regions)
    return (
        rows.where(like_or_all(F.col("nom_region"), region))
        .groupBy("nom_departement")
        .agg(F.round(F.avg("avg_price_m2"), 0).alias("prix_m2"))
        .orderBy(F.desc("prix_m2"), "nom_departement")
        .limit(limit)
    )


def coverage_per_year(mart: DataFrame) -> DataFrame:
    return mart.groupBy("year").agg(
        F.count(F.lit(1)).alias("communes_couvertes"),
        F.round(F.avg("transaction_count"), 0).alias("transactions_moy"),
        F.round(F.avg("avg_price_m2"), 0).alias("prix_moyen"),
    )


def price_history(gold: DataFrame, predictions: DataFrame | None, code: str | None = None) -> DataFrame:
    """Yearly prices, plus the forecast point for communes with two or more years."""
    history = gold.select("code_commune", F.col("year").alias("annee"), "avg_price_m2", F.lit("constate").alias("serie"))
    if code is not None:
        history = history.where(F.col("code_commune") == code)
    if predictions is None:
        return history
    known = history.groupBy("code_commune").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= 2)
    points = predictions.join(known, "code_commune", "left_semi").select(
        "code_commune", F.col("target_year").alias("annee"),
        F.col("predicted_avg_price_m2").alias("avg_price_m2"), F.lit("prediction").alias("serie"),
    )
    return history.unionByName(points)
