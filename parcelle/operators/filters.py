"""Row filters, as conjuncts that Catalyst can push into the scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.params import GOLD_PRICE_M2, MIN_SALES, SILVER_PRICE_M2


def valid_sales(df: DataFrame, bounds: tuple[float, float] = SILVER_PRICE_M2) -> DataFrame:
    low, high = bounds
    return df.dropna(
        subset=["date_mutation", "valeur_fonciere", "surface_reelle_bati", "code_commune"]
    ).where(
        (F.col("surface_reelle_bati") > 0)
        & (F.col("valeur_fonciere") > 0)
        & F.col("prix_m2").between(low, high)
    )


def plausible_prices(df: DataFrame, bounds: tuple[float, float] = GOLD_PRICE_M2) -> DataFrame:
    return df.where(F.col("prix_m2").between(*bounds))


def enough_sales(df: DataFrame, minimum: int = MIN_SALES) -> DataFrame:
    return df.where(F.col("transaction_count") >= minimum)


def reliable(df: DataFrame, minimum: int) -> DataFrame:
    return df.where(F.coalesce(F.col("transaction_count"), F.lit(0)) >= minimum)


def valid_listings(df: DataFrame) -> DataFrame:
    """A commune code that is not blank and a positive price per square metre."""
    code = F.trim(F.col("commune_code"))
    return (
        df.withColumn("commune_code", F.when(code != "", code))
        .where(F.col("commune_code").isNotNull() & (F.col("price_m2") > 0))
    )


def plottable(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["latitude", "longitude", "avg_price_m2"])


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(columns))


def all_of(df: DataFrame, conditions: Iterable[Column | None]) -> DataFrame:
    """Keeps rows that meet every condition given; ``None`` means not asked for."""
    asked = [c for c in conditions if c is not None]
    return df.where(reduce(and_, asked)) if asked else df


def equals_if(column: str, value) -> Column | None:
    return None if value is None else F.col(column) == value


def at_most_if(column: str, value) -> Column | None:
    return None if value is None else F.col(column) <= value


def at_least_if(column: str, value) -> Column | None:
    return None if value is None else F.coalesce(F.col(column), F.lit(0)) >= value


def within_budget(df: DataFrame, budget, tolerance: float = 1.1) -> DataFrame:
    limit = budget if isinstance(budget, Column) else F.lit(float(budget))
    return df.where(F.col("cout_acquisition_total") <= limit * tolerance)


def self_financing(df: DataFrame) -> DataFrame:
    return df.withColumn("autofinancee", F.col("cashflow_mensuel") >= 0)


def in_codes(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    return df.where(F.col("code_commune").isin(*codes))


def apartments(df: DataFrame) -> DataFrame:
    return df.where(F.trim(F.col("nature_locaux")) == "D")


def listings_up_to(df: DataFrame, max_price: float | None) -> DataFrame:
    """A missing or zero price is kept; order ascending, those last."""
    kept = df
    if max_price:
        price = F.col("price")
        kept = df.where(price.isNull() | (price == 0) | (price <= max_price))
    return kept.orderBy(F.nullif(F.col("price"), F.lit(0.0)).asc_nulls_last())
