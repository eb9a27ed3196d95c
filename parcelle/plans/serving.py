"""Read-side queries as DataFrame functions. Every limit is part of its report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle import params as P
from parcelle.functions.finance import gross_yield
from parcelle.operators.aggregates import plain_listing_mean
from parcelle.operators.dedup import first_per_key, top_per_key
from parcelle.operators.filters import all_of, at_least_if, at_most_if, equals_if, in_codes
from parcelle.operators.joins import with_predictions

# --- fixed values: columns of the reports -------------------------------------------
RANKING_COLUMNS = [
    "transport_score", "network_score", "green_score", "education_score", "health_score",
    "affordability_score",
]
COMPARE_COLUMNS = [
    "code_commune", "nom_commune", "region", "avg_price_m2", "affordability_score",
    "transport_score", "network_score", "green_score", "education_score", "health_score",
    *P.PERSONA_WEIGHTS,
]
RANKING_VIEW = [
    "code_commune", "nom_commune", "region", "avg_price_m2", "affordability_score",
    "transport_score", "network_score", *P.PERSONA_WEIGHTS,
]
RADAR = {
    "Accessibilité": "affordability_score", "Transport": "transport_score",
    "Réseau mobile": "network_score", "Espaces verts": "green_score",
    "Services": "services_score", "Éducation": "education_score",
    "Santé": "health_score", "Investissement": "investment_potential_score",
}


class NotFound(LookupError):
    """The commune asked for does not exist."""


def _limit(value: int, most: int) -> int:
    if not 0 < value <= most:
        raise ValueError(f"limit must lie between 1 and {most}")
    return value


def top(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def regions(df: DataFrame) -> DataFrame:
    return df.select("code_region", "nom_region").orderBy("nom_region")


def departments(df: DataFrame, code_region: str | None = None) -> DataFrame:
    rows = all_of(df, [equals_if("code_region", code_region)])
    return rows.select("code_departement", "nom_departement", "code_region").orderBy("code_departement")


def communes(df: DataFrame, code_departement: str | None = None, limit: int = 500) -> DataFrame:
    most = _limit(limit, 5_000)
    rows = all_of(df, [equals_if("code_departement", code_departement)])
    return top(
        rows.select("code_commune", "nom_commune", "latitude", "longitude", "population"),
        [F.col("nom_commune"), F.col("code_commune")], most,
    )


def territories(df: DataFrame) -> DataFrame:
    return df


def scores(df: DataFrame, code_commune=None, region=None, limit: int = 100) -> DataFrame:
    rows = all_of(df, [equals_if("code_commune", code_commune), equals_if("region", region)])
    return top(rows, [F.desc("score_etudiant"), F.col("code_commune")], _limit(limit, 5_000))


def ranking(
    df: DataFrame, persona: str = "etudiant", region=None, max_price_m2=None, limit: int = 50
) -> DataFrame:
    if persona not in P.PERSONAS:
        raise ValueError(f"persona must be one of {P.PERSONAS}")
    rows = all_of(df, [equals_if("region", region), at_most_if("avg_price_m2", max_price_m2)])
    return top(
        rows.select(
            "code_commune", "nom_commune", "region", "avg_price_m2",
            F.col(f"score_{persona}").alias("persona_score"), *RANKING_COLUMNS,
        ),
        [F.desc("persona_score"), F.col("code_commune")], _limit(limit, 500),
    )


def commune_full(territory: DataFrame, listing_stats: DataFrame) -> DataFrame:
    """Territory row with listing figures; sources are reduced before the join."""
    return territory.join(plain_listing_mean(listing_stats), "code_commune", "left")


def commune(full: DataFrame, code: str) -> DataFrame:
    found = full.where(F.col("code_commune") == code).limit(1)
    if found.isEmpty():
        raise NotFound(code)
    return found


def commune_profiles(
    territory: DataFrame, predictions: DataFrame | None = None, listing_means: DataFrame | None = None
) -> DataFrame:
    """Key figures of each commune; forecast and asking-price gap where known."""
    df = territory.select(
        "code_commune", "nom_commune", "avg_price_m2", "investment_potential_score", "annual_price_growth",
        gross_yield(F.col("avg_price_m2")).alias("rendement_brut"), "network_score", "transport_score",
    )
    if predictions is not None:
        df = with_predictions(df, predictions)
    if listing_means is not None:
        asked, sold = F.col("prix_annonces"), F.col("avg_price_m2")
        means = listing_means.select("code_commune", F.col("avg_listing_price_m2").alias("prix_annonces"))
        df = df.join(means, "code_commune", "left").withColumn(
            "ecart_annonces_pct", F.try_divide(asked - sold, sold) * 100
        )
    return df


def ranking_view(territory: DataFrame) -> DataFrame:
    return territory.select(*RANKING_VIEW)


def compare(df: DataFrame, codes: str | Sequence[str]) -> DataFrame:
    wanted = [c.strip() for c in codes.split(",")] if isinstance(codes, str) else list(codes)
    wanted = [c for c in wanted if c]
    if not wanted:
        raise ValueError("no commune codes given")
    return in_codes(df, wanted).select(*COMPARE_COLUMNS).orderBy("nom_commune", "code_commune")


def compare_criteria(df: DataFrame) -> DataFrame:
    """Criteria as rows: one row per commune and criterion."""
    used = {label: c for label, c in RADAR.items() if c in df.columns}
    rows = F.array(*[F.struct(F.lit(l).alias("critere"), F.round(c, 0).alias("note")) for l, c in used.items()])
    return df.select("code_commune", "nom_commune", F.inline(rows))


def compare_table(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Criteria down, the chosen communes across (the list bounds the columns)."""
    chosen = first_per_key(df.where(F.col("nom_commune").isin(*names)), ["nom_commune"], [F.col("code_commune")])
    return compare_criteria(chosen).groupBy("critere").pivot("nom_commune", list(names)).agg(F.max("note"))


def real_estate_stats(gold: DataFrame, code_commune: str, year: int | None = None) -> DataFrame:
    rows = all_of(gold, [equals_if("code_commune", code_commune), equals_if("year", year)])
    return rows.orderBy(F.desc("year"))


def listings(stats: DataFrame, code_commune=None, source=None, limit: int = 100) -> DataFrame:
    rows = all_of(stats, [equals_if("code_commune", code_commune), equals_if("source_name", source)])
    return top(
        rows, [F.desc_nulls_last("avg_listing_price_m2"), F.col("code_commune"), F.col("source_name")], limit
    )


def growth_leaders(predictions: DataFrame, limit: int = 15) -> DataFrame:
    return top(
        predictions.select("code_commune", "nom_commune", "last_avg_price_m2", "predicted_avg_price_m2", "predicted_growth_pct"),
        [F.desc_nulls_last("predicted_growth_pct"), F.col("code_commune")], limit,
    )


def global_leaders(star_scores: DataFrame, communes_: DataFrame, limit: int = 20) -> DataFrame:
    rows = star_scores.join(communes_.select("code_commune", "nom_commune"), "code_commune")
    return top(rows, [F.desc_nulls_last("global_score"), F.col("code_commune")], limit)


def largest_communes(communes_: DataFrame, limit: int = 2_000) -> DataFrame:
    rows = communes_.dropna(subset=["latitude", "population"])
    return top(
        rows.select("code_commune", "latitude", "longitude", "nom_commune", "population"),
        [F.desc("population"), F.col("code_commune")], limit,
    )


def price_points(mart: DataFrame, communes_: DataFrame, limit: int = 3_000) -> DataFrame:
    """Map points of the latest year; the limit is the map's."""
    from parcelle.plans.gold import of_latest_year

    rows = of_latest_year(mart).join(
        communes_.where(F.col("latitude").isNotNull()).select("code_commune", "latitude", "longitude"),
        "code_commune",
    )
    return top(
        rows.select("code_commune", "latitude", "longitude", F.round(F.col("avg_price_m2").cast("double"), 0).alias("prix_m2")),
        [F.col("code_commune")], limit,
    )


def map_points(metrics: DataFrame, limit: int = 3_000, department: str | None = None) -> DataFrame:
    """Most populous communes, of one department if asked for, with the cash-flow clipped for the colour scale; in the order of
    drawing, profitable ones last and so on top."""
    shown = F.greatest(F.least(F.col("cashflow_mensuel"), F.lit(500.0)), F.lit(-500.0))
    asked = metrics if department is None else metrics.where(F.col("code_departement") == department)
    chosen = top(asked, [F.desc_nulls_last("population"), F.col("code_commune")], limit)
    # at most ``limit`` rows are sorted
    return chosen.withColumn("cashflow_affiche", shown).orderBy("cashflow_affiche", "code_commune")


def investor_pool(
    metrics: DataFrame, min_cashflow=None, min_yield=None, price_range=None,
    vacancy_levels: Sequence[int] | None = None, only_positive: bool = False,
    only_observed_rent: bool = False, min_scores: dict[str, float] | None = None,
) -> DataFrame:
    """The advanced filters of the investor list; each parameter adds a condition."""
    return all_of(
        metrics,
        [
            None if min_cashflow is None else F.col("cashflow_net_fiscal") >= min_cashflow,
            None if min_yield is None else F.col("rendement_net_fiscal") >= min_yield,
            None if price_range is None else F.col("prix_bien_possible").between(*price_range),
            None if vacancy_levels is None else F.col("risque_vacance").isin(*vacancy_levels),
            F.col("cashflow_net_fiscal") >= 0 if only_positive else None,
            F.coalesce(F.col("loyer_m2_app"), F.lit(0.0)) > 0 if only_observed_rent else None,
            *[at_least_if(c, v) for c, v in (min_scores or {}).items() if v > 0],
        ],
    )


def best_per_department(metrics: DataFrame, order: str = "cashflow_mensuel", k: int = 1) -> DataFrame:
    rows = metrics.where(F.col("code_departement").isNotNull())
    return top_per_key(rows, ["code_departement"], [F.desc_nulls_last(order), F.col("code_commune")], k)
