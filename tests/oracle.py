"""Compares registered queries with their SQL on DuckDB.

Run as a script: ``python tests/oracle.py [folder] [name | @module ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    db.execute("SET threads TO 4")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, db, folder, run, sql):
    """An empty text when both sides agree, else what differs."""
    df = run(spark, folder)
    got_columns, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(sql)
    want_columns, want = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; {got[:2]} | {want[:2]}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        g, w = differing[0]
        cells = [(c, a, b) for c, a, b in zip(got_columns, g, w) if a != b]
        return f"{len(differing)} of {len(got)} rows differ, first: {cells}"
    if not got:
        return "both empty"
    return ""


def main() -> None:
    from parcelle.workloads import load_all
    from parcelle.workloads.registry import ORACLES, QUERIES
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    load_all()
    asked = sys.argv[2:]
    modules = {a[1:] for a in asked if a.startswith("@")}
    names = [n for n, run in QUERIES.items() if not asked or n in asked or run.__module__.split(".")[-1] in modules]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, db, folder, QUERIES[name], ORACLES[name])
            else:
                problem = "" if QUERIES[name](spark, folder).collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
