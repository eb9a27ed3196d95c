"""Score arithmetic over the columns of one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.params import NEUTRAL_SCORE


def steady_round(c: Column, digits: int) -> Column:
    """Half-up rounding that ignores floating noise beyond nine digits."""
    return F.round(F.round(c, 9), digits)


def steady_round_double(c: Column, digits: int) -> Column:
    """``steady_round`` of a double column with 0 to 6 digits, without decimals for nearly all values.

    A value whose last digit is not near a half has one nearest number of so many digits, and its quotient by the power of
    ten is the double that the decimal would give. Only the others, very large and missing ones take the decimal way.
    """
    scaled = c * F.lit(10.0**digits)
    below = F.floor(scaled)
    rest = scaled - below - 0.5
    nearest = (below + F.when(rest > 0, F.lit(1)).otherwise(F.lit(0))) / F.lit(10.0**digits)
    return F.when((F.abs(scaled) < 1e11) & (F.abs(rest) > 1e-3), nearest).otherwise(steady_round(c, digits))


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bounds a value; a missing value stays missing."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(c.isNotNull(), out)


def present(c: Column) -> Column:
    """NaN counts as missing, like null."""
    number = c.cast("double")
    return F.when(~F.isnan(number), number)


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the non-null values of the row; null when there is none."""
    filled = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in columns])
    known = reduce(add, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(filled, known)


def weighted_score(weights: Mapping[str, float], available: Sequence[str]) -> Column:
    """Weighted mean over the columns that exist; a missing value counts as neutral."""
    used = {name: w for name, w in weights.items() if name in available}
    if not used:
        return F.lit(0.0)
    total = sum(used.values())
    parts = [F.coalesce(F.col(n), F.lit(NEUTRAL_SCORE)) * F.lit(w) for n, w in used.items()]
    return steady_round(reduce(add, parts) / F.lit(total), 2)


def weighted_sum(weights: Mapping[str, float]) -> Column:
    return steady_round(reduce(add, [F.col(n) * F.lit(w) for n, w in weights.items()]), 2)


def quality_score(weights: Mapping[str, float], available: Sequence[str]) -> Column:
    """User-weighted quality: an absent column is neutral, a null stays null."""
    total = sum(weights.values()) or 1
    return reduce(
        add,
        [
            (F.col(n) if n in available else F.lit(NEUTRAL_SCORE)) * F.lit(w / total)
            for n, w in weights.items()
        ],
    )


def density_per_10k(parts: Sequence[Column], population: Column) -> Column:
    """Sum of counts per 10 000 inhabitants, population at least one."""
    counts = reduce(add, [F.coalesce(p, F.lit(0)) for p in parts])
    people = F.coalesce(F.greatest(population, F.lit(1)), F.lit(1))
    return counts / people * F.lit(10_000)
