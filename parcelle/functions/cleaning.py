"""Scalar cleaning: numbers, dates, codes, names (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.functions.scores import steady_round

MISSING_TOKENS = ("", "nan", "None")


def null_if_missing(c: Column) -> Column:
    """Blank, ``nan`` and ``None`` texts become null."""
    text = F.trim(c.cast("string"))
    return F.when(~text.isin(*MISSING_TOKENS), text)


def to_number(c: Column) -> Column:
    """French decimal text to double; anything unparsable is null."""
    text = F.replace(F.replace(c.cast("string"), F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))
    # A number ends in a digit or a dot: keeps out 'nan' and Java's '1d' spelling.
    return F.when(text.rlike(r"[0-9.]\s*$"), text.try_cast("double"))


def to_timestamp(c: Column) -> Column:
    return c.cast("string").try_cast("timestamp")


def to_int(c: Column) -> Column:
    return to_number(c).try_cast("int")


def strip_decimal_suffix(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def pad_code(c: Column, width: int = 5) -> Column:
    """Left-pad with zeros; longer codes stay whole (``lpad`` alone would cut)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def commune_code(c: Column) -> Column:
    return pad_code(strip_decimal_suffix(null_if_missing(c)))


def postal_code(c: Column) -> Column:
    return strip_decimal_suffix(null_if_missing(c))


def title_case(c: Column) -> Column:
    """Capital after every non-letter, so ``SAINT-DENIS`` gives ``Saint-Denis``.

    ``initcap`` starts words at spaces only: a marked space is put after every
    non-letter and taken out again, without arrays or lambdas per row.
    """
    spaced = F.regexp_replace(F.lower(F.trim(c.cast("string"))), r"([^\p{L}])", "$1\u0001 ")
    return F.replace(F.initcap(spaced), F.lit("\u0001 "), F.lit(""))


def unit_price(amount: Column, surface: Column) -> Column:
    return F.try_divide(amount, surface)


def department_of(code: Column, corsica: bool = False) -> Column:
    """Overseas codes carry three characters, all others two."""
    two = F.substring(code, 1, 2)
    if corsica:
        two = F.upper(two)
    return F.when(F.substring(code, 1, 2).isin("97", "98"), F.substring(code, 1, 3)).otherwise(two)


def fallback_postal(department: Column) -> Column:
    return (
        F.when(department.startswith("97"), F.rpad(department, 5, "0"))
        .when(F.upper(department).isin("2A", "2B"), F.lit("20000"))
        .otherwise(F.concat(pad_code(department, 2), F.lit("000")))
    )


def first_postal(codes: Column) -> Column:
    return null_if_missing(F.element_at(F.split(codes, ","), 1))


def slug(c: Column) -> Column:
    dashed = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def first_of_january(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def to_decimal(c: Column, precision: int = 14, scale: int = 2) -> Column:
    return steady_round(c, scale).cast(f"decimal({precision},{scale})")


def like_or_all(c: Column, pattern: str = "%") -> Column:
    return c.like(pattern)
