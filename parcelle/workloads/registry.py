"""Registration of queries next to the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions.scores import steady_round_double

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def expand_rounding(sql: str) -> str:
    """Expands ``rnd(x, n)`` to half-up rounding on decimals.

    Rounding doubles differs between engines when a value lies half way.
    """
    while (start := sql.find("rnd(")) >= 0:
        depth, comma, end = 0, -1, start + 4
        while depth >= 0:
            char = sql[end]
            depth += (char == "(") - (char == ")")
            if char == "," and depth == 0:
                comma = end
            end += 1
        x, digits = sql[start + 4:comma], sql[comma + 1:end - 1]
        sql = f"{sql[:start]}CAST(round(CAST({x} AS DECIMAL(28, 9)),{digits}) AS DOUBLE){sql[end:]}"
    return sql


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = expand_rounding(oracle)
        return run

    return keep


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Rounds every double column, so both engines agree past floating noise."""
    return df.select(
        *[
            steady_round_double(F.col(f"`{n}`"), special.get(n, digits)).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )
