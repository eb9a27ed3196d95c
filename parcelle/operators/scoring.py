"""Scores over all communes: min-max, density, transport, personas, investor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle import params as P
from parcelle.functions.order_stats import fill_with_median, rank_scores
from parcelle.functions.scores import (
    density_per_10k, quality_score, row_mean, steady_round, weighted_score, weighted_sum,
)

KEY = "code_commune"


def _with_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``_range``: smallest and largest value of every column, from one pass."""
    bounds = F.struct(
        *[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    )
    return df.withColumn("_range", df.agg(bounds).scalar())


def min_max_scores(
    df: DataFrame, metrics: Mapping[str, str], inverse: Sequence[str] = ()
) -> DataFrame:
    """0-100 between minimum and maximum (``score -> column``); constant column: 100."""

    def score(name: str, column: str) -> Column:
        low, high = F.col(f"_range.{column}.low"), F.col(f"_range.{column}.high")
        share = steady_round(F.try_divide(F.col(column) - low, high - low) * 100, 2)
        plain = F.when(high == low, F.lit(100.0)).otherwise(share)
        return steady_round(100 - plain, 2) if name in inverse else plain

    ranged = _with_ranges(df, sorted(set(metrics.values())))
    return ranged.withColumns({n: score(n, c) for n, c in metrics.items()}).drop("_range")


def one_to_ten(df: DataFrame, column: str, out: str) -> DataFrame:
    low, high = F.col(f"_range.{column}.low"), F.col(f"_range.{column}.high")
    spread = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    score = steady_round((F.col(column) - low) / spread * 9 + 1, 1)
    return _with_ranges(df, [column]).withColumn(out, score).drop("_range")


def density_metrics() -> dict[str, Column]:
    """Raw densities behind the green, education, health and services scores."""
    people = F.col("population")
    pairs = {
        "green_score": ("park_count", "forest_count"),
        "education_score": ("school_count", "university_count"),
        "health_score": ("hospital_count", "pharmacy_count"),
        "services_score": ("supermarket_count", "restaurant_count"),
    }
    return {
        name: density_per_10k([F.col(c) for c in columns], people)
        for name, columns in pairs.items()
    }


def log_population() -> Column:
    return F.log1p(F.coalesce(F.col("population"), F.lit(0)).cast("double"))


def transport_metric(df: DataFrame) -> Column:
    """Stops and trains per 10 000 inhabitants if a fifth of the communes have
    any, else log population. The gate is a scalar subquery, not a driver branch."""
    raw = density_per_10k(
        [
            F.col("bus_stop_count"),
            F.coalesce(F.col("train_station_count"), F.lit(0)) * P.TRAIN_STATION_WEIGHT,
        ],
        F.col("population"),
    )
    covered = df.agg(
        F.try_divide(F.count_if(raw > 0) * F.lit(100.0), F.count(F.lit(1)))
    ).scalar()
    return F.when(covered >= P.TRANSPORT_COVERAGE_PCT, raw).otherwise(log_population())


def log_stops() -> Column:
    return F.log1p(F.coalesce(F.col("stop_count"), F.lit(0)).cast("double"))


def market_metrics() -> dict[str, Column]:
    return {
        "affordability_score": F.col("avg_price_m2"),
        "investment_potential_score": F.coalesce(F.col("price_m2_yoy_variation"), F.lit(0.0)),
    }


def persona_scores(
    df: DataFrame, weights: Mapping[str, Mapping[str, float]] = P.PERSONA_WEIGHTS
) -> DataFrame:
    return df.withColumns({name: weighted_score(w, df.columns) for name, w in weights.items()})


def global_score(df: DataFrame) -> Column:
    """Mean of the persona scores present in the table."""
    return row_mean([F.col(c) for c in df.columns if c.startswith("score_")])


def declared_global_score(available: Sequence[str]) -> Column:
    """The documented 40/20/20/20 formula."""
    return weighted_score(P.GLOBAL_SCORE_WEIGHTS, available)


def demo_composite(df: DataFrame) -> DataFrame:
    """Min-max scores, investment mix and the demonstration persona weights."""
    scored = min_max_scores(
        df,
        {
            "affordability_score": "avg_price_m2",
            "price_growth_score": "annual_price_growth",
            "liquidity_score": "transaction_count",
        },
        inverse=["affordability_score"],
    )
    mixed = scored.withColumn(
        "investment_potential_score", weighted_sum(P.DEMO_INVESTMENT_WEIGHTS)
    )
    return mixed.withColumns({n: weighted_sum(w) for n, w in P.DEMO_PERSONA_WEIGHTS.items()})


def with_quality(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    return df.withColumn("critere_score", quality_score(weights, df.columns))


def investor_scores(df: DataFrame, profit_weight_pct: float = 70.0) -> DataFrame:
    """Cash-flow and yield after vacancy (4:3) against territory quality."""
    vacancy = F.col("taux_vacance")
    ranked = rank_scores(
        df,
        KEY,
        {
            "score_cf": F.col("cashflow_net_fiscal") - F.col("loyer_estime") * vacancy,
            "score_rdt": F.col("rendement_net_fiscal") * (1 - vacancy),
            "score_qdv": F.col("critere_score"),
        },
        rounded=False,
    )
    profit = F.col("score_cf") * (4 / 7) + F.col("score_rdt") * (3 / 7)
    return ranked.withColumn(
        "score_final",
        profit * profit_weight_pct / 100 + F.col("score_qdv") * (100 - profit_weight_pct) / 100,
    )


def network_and_income(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Median-filled raw columns and the metrics ranked from them."""
    metrics = {}
    raw = [c for c in ("network_score_raw", "median_income_raw") if c in df.columns]
    filled = fill_with_median(df, raw) if raw else df
    if "network_score_raw" in raw:
        metrics["network_score"] = F.col("network_score_raw")
    if "median_income_raw" in raw:
        metrics["income_score"] = F.col("median_income_raw")
    return filled, metrics
