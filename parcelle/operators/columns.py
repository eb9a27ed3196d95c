"""Header handling: normalise, resolve spellings, rename, keep, ensure."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_name(name: str) -> str:
    plain = unicodedata.normalize("NFKD", str(name)).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"[^a-z0-9]+", "_", plain.lower()).strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def clean_headers(df: DataFrame, case: str = "lower") -> DataFrame:
    """Trims spaces and quotes; ``case`` is lower, upper or keep."""
    turn = {"lower": str.lower, "upper": str.upper, "keep": str}[case]
    return df.toDF(*[turn(c.strip().strip('"')) for c in df.columns])


def first_existing(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def resolve_columns(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """One output per logical column: its first existing spelling, else null."""
    chosen = {out: first_existing(df.columns, names) for out, names in candidates.items()}
    return df.select(
        *[
            (F.col(found) if found else F.lit(None).cast("string")).alias(out)
            for out, found in chosen.items()
        ]
    )


def resolve_by_pattern(
    columns: Sequence[str],
    exact: Sequence[str] = (),
    pattern: Callable[[str], bool] | None = None,
) -> str | None:
    """First column in file order that is in ``exact``; else the first that fits."""
    found = next((c for c in columns if c in exact), None)
    if found is None and pattern is not None:
        found = next((c for c in columns if pattern(c)), None)
    return found


def is_4g(name: str) -> bool:
    return "4g" in name


def is_5g(name: str) -> bool:
    return "5g" in name and not any(w in name for w in ("historique", "date", "m_hz"))


def is_income(name: str) -> bool:
    return any(w in name for w in ("q2", "med", "revenu"))


def is_stop_commune(name: str) -> bool:
    return any(w in name for w in ("insee", "commune", "municipality"))


def suffix_columns(df: DataFrame, renames: Mapping[str, str], suffix: str, keep: Sequence[str]) -> DataFrame:
    """Renames with ``{}`` standing for the suffix and keeps key plus renamed columns."""
    return df.select(*keep, *[F.col(f"`{old}`").alias(new.format(suffix)) for old, new in renames.items()])


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column | object]) -> DataFrame:
    """Adds absent columns with a default; present ones are left alone."""
    missing = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def computed_once(df: DataFrame, cells: Mapping[str, Column]) -> DataFrame:
    """Adds columns that a later filter reads instead of computing them again.

    A filter over a plain projection is pushed below it with the expressions
    copied into every condition. It cannot pass a generator, so costly parsing is
    wrapped in a one-element ``inline``.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cells.items()]))))


def staging_communes(communes: DataFrame) -> DataFrame:
    return communes.select(
        F.col("code_commune").alias("commune_id"),
        *keep_existing(
            communes,
            ["code_commune", "nom_commune", "code_postal", "code_departement",
             "latitude", "longitude", "population"],
        ).columns,
    )


def staging_sales(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("prix_m2").isNotNull())
