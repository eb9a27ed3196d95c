"""Open-data extracts, all texts as read, to the tables the territory job joins.

Headers are expected as ``read_csv_strings`` gives them. Codes are padded to five places; rows without a code drop out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions.cleaning import commune_code, to_number
from parcelle.operators import aggregates, spatial
from parcelle.operators.columns import is_income, is_stop_commune, resolve_by_pattern, suffix_columns
from parcelle.operators.dedup import first_per_key
from parcelle.operators.joins import merge_rents, property_tax_rate
from parcelle.params import INCOME_CODE_COLUMNS

RENT_COLUMNS = {
    "loypredm2": "loyer_m2_{}", "lwr.IPm2": "loyer_m2_{}_min", "upr.IPm2": "loyer_m2_{}_max",
    "nbobs_com": "nb_annonces_{}", "TYPPRED": "qualite_{}",
}


def _coded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("code_commune", commune_code(F.col(f"`{column}`"))).where(F.col("code_commune").isNotNull())


def incomes(extract: DataFrame) -> DataFrame | None:
    """``(code_commune, median_income_raw)``; the first column that looks like a median counts. ``None`` without the columns."""
    code = resolve_by_pattern(extract.columns, exact=INCOME_CODE_COLUMNS)
    income = resolve_by_pattern(extract.columns, pattern=is_income)
    if code is None or income is None:
        return None
    return _coded(extract, code).select(
        "code_commune", to_number(F.col(f"`{income}`")).alias("median_income_raw")
    ).where(F.col("median_income_raw").isNotNull())


def rents(all_flats: DataFrame, small: DataFrame, large: DataFrame) -> DataFrame:
    """The three predicted-rent files side by side on the commune; decimals have commas."""

    def typed(extract: DataFrame, suffix: str) -> DataFrame:
        rows = _coded(extract, "INSEE_C").select(
            "code_commune", *[to_number(F.col(f"`{c}`")).alias(c) for c in ("loypredm2", "lwr.IPm2", "upr.IPm2", "nbobs_com")], "TYPPRED"
        )
        return suffix_columns(rows, RENT_COLUMNS, suffix, ["code_commune"])

    return merge_rents(typed(all_flats, "app"), typed(small, "app12"), typed(large, "app3"))


def property_tax(rental_values: DataFrame, communes: DataFrame | None = None) -> DataFrame:
    """``(code_commune, vl_m2_commune, taux_tfb_dept)``: median rental value of flats and the department's rate.

    Without a commune table the communes are those with a rental value, and the code's first two places name the department.
    """
    if "code_commune" not in rental_values.columns:
        raise ValueError("code_commune is missing")
    values = aggregates.rental_values(rental_values)
    if communes is None:
        places = values.select("code_commune", F.substring("code_commune", 1, 2).alias("code_departement"))
    else:
        places = _coded(communes, "code_commune")
        if "code_departement" not in communes.columns:
            places = places.withColumn("code_departement", F.substring("code_commune", 1, 2))
        places = first_per_key(places.select("code_commune", "code_departement"), ["code_commune"], [F.col("code_departement").asc_nulls_last()])
    return places.join(values, "code_commune", "left").select(
        "code_commune", "vl_m2_commune", property_tax_rate(F.col("code_departement")).alias("taux_tfb_dept")
    )


def stops(extract: DataFrame, communes: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Stops per commune with mode flags: by the extract's commune column, else by coordinates rounded to two places."""
    code = resolve_by_pattern(extract.columns, pattern=is_stop_commune)
    if code is not None:
        counts = spatial.code_counts(extract, commune_code(F.col(f"`{code}`")), "stop_count")
    else:
        located = extract.select(to_number(F.col("stop_lat")).alias("lat"), to_number(F.col("stop_lon")).alias("lon"))
        counts = spatial.grid_counts(located, communes, "lat", "lon", "stop_count")
    return aggregates.stop_flags(counts, routes is not None and "route_type" in routes.columns)
