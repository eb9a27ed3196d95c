"""From raw files to gated price marts, and on to scores, forecasts, star tables and the BI extract."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators.forecast import forecast
from parcelle.operators.quality import gate, gold_checks
from parcelle.operators.words import text_analysis
from parcelle.plans.gold import GOLD_COLUMNS, commune_prices, counted_prices, price_sketches, with_previous
from parcelle.plans.silver import silver_sales
from parcelle.plans.star import export_marts, load_star, write_star
from parcelle.plans.territory import territory_scores
from parcelle.sources.files import load_history, read_csv_flexible
from parcelle.sources.tables import lineage, write_bronze, write_partitioned

log = logging.getLogger(__name__)


def _previous(spark: SparkSession, root: str, year: int) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root}/gold/real_estate/annee={year}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_batch(spark: SparkSession, raw: str, root: str, year: int) -> DataFrame:
    """Lands bronze, silver and gold under ``root``, then runs the quality gate. The lineage table tells how many rows the
    price bounds removed.

    Each layer is a written table, so a lost executor costs at most one layer and
    the next one starts from storage.
    """
    bronze, silver = f"{root}/bronze/sales/year={year}", f"{root}/silver/sales"
    rows = write_bronze(read_csv_flexible(spark, raw), year, bronze)
    lineage(spark, f"{root}/lineage", raw, "sales", year, bronze, {"bronze": rows})
    cleaned = silver_sales(spark.read.parquet(bronze), year).withColumn("annee", F.lit(year))
    write_partitioned(cleaned, silver, ["annee"])
    sales = spark.read.parquet(f"{silver}/annee={year}")
    counted, seen = counted_prices(sales)
    gold = with_previous(commune_prices(counted), _previous(spark, root, year - 1))
    write_partitioned(gold.withColumn("annee", F.lit(year)), f"{root}/gold/real_estate", ["annee"])
    stored = spark.read.parquet(f"{root}/gold/real_estate/annee={year}")
    counts = {"silver": seen.get["rows"], "removed": seen.get["removed"], "gold": stored.count()}
    log.info("%s: %s sales, %s outside the price bounds, %s rows in the mart", year, *counts.values())
    lineage(spark, f"{root}/lineage", silver, "gold", year, f"{root}/gold/real_estate/annee={year}", counts)
    gate(gold_checks(stored, year))
    return stored


@dataclass(frozen=True)
class References:
    """Reference tables and the optional extracts; what is absent stays neutral in the scores."""

    communes: DataFrame
    departments: DataFrame
    regions: DataFrame
    equipment: DataFrame | None = None
    stops: DataFrame | None = None
    network: DataFrame | None = None
    rents: DataFrame | None = None
    property_tax: DataFrame | None = None
    incomes: DataFrame | None = None
    texts: DataFrame | None = None


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run_all(spark: SparkSession, raw: Mapping[int, str], root: str, references: References, horizon: int = 2, **forest) -> dict[str, int]:
    """The whole batch: the price mart of each year of ``raw`` in order, then for the last year territory scores, price sketches, a
    forecast ``horizon`` years ahead, texts, star tables and the BI extract, all under ``root``. Returns rows by table.

    A failed quality gate stops it before anything is derived. The forecast is skipped with fewer than two years. Every table is
    written before the next one reads it.
    """
    for year in sorted(raw):
        gold = run_batch(spark, raw[year], root, year)
    year = max(raw)
    r = references
    scores = _kept(territory_scores(
        r.communes, gold, r.regions, equipment=r.equipment, stops=r.stops, network=r.network, rents=r.rents,
        property_tax=r.property_tax, incomes=r.incomes,
    ), f"{root}/gold_territory_scores")
    sales = spark.read.parquet(f"{root}/silver/sales/annee={year}")
    tables = {"gold_territory_scores": scores, "price_sketches": _kept(price_sketches(sales), f"{root}/price_sketches/annee={year}")}
    history = load_history(spark, f"{root}/gold/real_estate", GOLD_COLUMNS).drop("data_year")
    predicted = forecast(history, year + horizon, **forest)
    if predicted is None:
        log.warning("%s: too few years for a forecast", year)
    else:
        predicted = tables["price_predictions"] = _kept(predicted, f"{root}/price_predictions/target={year + horizon}")
    texts = None if r.texts is None else _kept(text_analysis(r.texts), f"{root}/text_analysis")
    star = load_star(r.regions, r.departments, r.communes, sales, scores, year)
    write_star(star, f"{root}/star")
    tables |= {f"star/{name}": spark.read.parquet(f"{root}/star/{name}") for name in star.__dataclass_fields__}
    for name, mart in export_marts(history, predicted, texts).items():
        tables[f"marts/{name}"] = _kept(mart, f"{root}/marts/{name}")
    counts = {name: table.count() for name, table in tables.items()}
    lineage(spark, f"{root}/lineage", root, "pipeline", year, root, counts)
    return counts
