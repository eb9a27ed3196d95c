"""Data-quality gate: every check of a mart from one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle import params as P

REQUIRED = ("code_commune", "avg_price_m2", "transaction_count", "year")


class QualityError(ValueError):
    """A hard check failed."""


def _rows(checks) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), passed.alias("passed"),
                F.lit(severity).alias("severity"), detail.alias("detail"),
            )
            for name, passed, severity, detail in checks
        ]
    )


def gold_checks(gold: DataFrame, year: int) -> DataFrame:
    """(name, passed, severity, detail) rows for the commune price mart.

    Uniqueness is measured on pre-grouped (commune, year) rows: the counts of each
    group are summed first, then one small pass yields all checks.
    """
    if not all(c in gold.columns for c in REQUIRED):
        return gold.agg(F.count(F.lit(1)).alias("rows")).select(
            F.inline(
                _rows(
                    [
                        ("non_empty", F.col("rows") > 0, "hard", F.concat(F.col("rows").cast("string"), F.lit(" rows"))),
                        ("required_columns_present", F.lit(False), "hard", F.lit("")),
                    ]
                )
            )
        )
    has_yoy = "price_m2_yoy_variation" in gold.columns
    price, sales = F.col("avg_price_m2"), F.col("transaction_count")
    usable = price.isNotNull() & sales.isNotNull()
    low, high = P.GOLD_PRICE_M2
    yoy = F.col("price_m2_yoy_variation") if has_yoy else F.lit(None).cast("double")
    per_key = gold.groupBy("code_commune", "year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(price.isNull()).alias("null_price"),
        F.count_if(usable & (price < low)).alias("below"),
        F.count_if(usable & (price > high)).alias("above"),
        F.count_if(usable & (price <= 0)).alias("not_positive"),
        F.count_if(usable & (sales < P.MIN_SALES)).alias("few"),
        F.count(yoy).alias("yoy"),
        F.count_if(F.abs(yoy) > P.EXTREME_YOY).alias("extreme"),
    )
    per_code = per_key.groupBy("code_commune").agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum(F.when(F.col("year") == year, 0).otherwise(F.col("rows"))).alias("wrong_year"),
        *[F.sum(c).alias(c) for c in
          ("rows", "null_price", "below", "above", "not_positive", "few", "yoy", "extreme")],
    )
    names = ("rows", "keys", "wrong_year", "null_price", "below", "above", "not_positive", "few", "yoy", "extreme")
    totals = per_code.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
        F.coalesce(F.sum(F.when(F.col("code_commune").isNull(), F.col("rows"))), F.lit(0)).alias("null_code"),
        F.count(F.lit(1)).alias("communes"),
    )
    null_share = F.coalesce(F.try_divide(F.col("null_price"), F.col("rows")), F.lit(0.0))
    extreme_share = F.coalesce(F.try_divide(F.col("extreme"), F.col("yoy")), F.lit(0.0))

    def text(number, label):
        return F.concat(number.cast("string"), F.lit(f" {label}"))

    checks = [
        ("non_empty", F.col("rows") > 0, "hard", text(F.col("rows"), "rows")),
        ("required_columns_present", F.lit(True), "hard", F.lit("")),
        ("code_commune_not_null", F.col("null_code") == 0, "hard", text(F.col("null_code"), "nulls")),
        ("avg_price_m2_null_ratio_acceptable", null_share <= P.NULL_PRICE_TOLERANCE, "hard",
         text(F.col("null_price"), "communes without price")),
        ("avg_price_m2_above_minimum", F.col("below") == 0, "hard", text(F.col("below"), "communes below")),
        ("avg_price_m2_below_maximum", F.col("above") == 0, "hard", text(F.col("above"), "communes above")),
        ("avg_price_m2_positive", F.col("not_positive") == 0, "hard", text(F.col("not_positive"), "not positive")),
        ("transaction_count_sufficient", F.col("few") == 0, "hard", text(F.col("few"), "communes with few sales")),
        ("no_duplicate_commune_year", F.col("rows") == F.col("keys"), "hard",
         text(F.col("rows") - F.col("keys"), "duplicates")),
        ("year_matches_expected", F.col("wrong_year") == 0, "hard", text(F.col("wrong_year"), "rows of another year")),
        ("commune_coverage_reasonable", F.col("communes") >= P.MIN_COMMUNES, "hard", text(F.col("communes"), "communes")),
    ]
    if has_yoy:
        checks += [
            ("yoy_variation_not_systematic", extreme_share <= P.EXTREME_YOY_SHARE, "hard",
             text(F.col("extreme"), "extreme")),
            ("yoy_variation_realistic", F.col("extreme") == 0, "warn", text(F.col("extreme"), "extreme")),
        ]
    # An empty mart has only its two structural results.
    structural = F.col("name").isin("non_empty", "required_columns_present")
    return totals.select("rows", F.inline(_rows(checks))).where((F.col("rows") > 0) | structural).drop("rows")


def gate(checks: DataFrame) -> list:
    """Runs the checks (a dozen rows) and raises on a hard failure."""
    results = checks.collect()
    failed = [r["name"] for r in results if not r["passed"] and r["severity"] == "hard"]
    if failed:
        raise QualityError("quality checks failed: " + ", ".join(failed))
    return results


def not_null_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"), (F.col(c) == 0).alias("passed")) for c in columns]
    )
    return nulls.select(F.inline(rows))
