"""CSV, JSON and Parquet readers. Texts stay texts; typing is the silver job's."""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.operators.columns import clean_headers
from parcelle.sources.records import heads, raw_lines, records

DELIMITERS = ",;\t|"
_OVERFLOW = "_overflow"


def spread(df: DataFrame) -> DataFrame:
    """Evens out an input before costly parsing (a gzip or one-group file is one split).

    The rebalance hint deals rows round-robin into partitions of the advisory size, at any number of cores.
    """
    return df.hint("rebalance")


def sniff_delimiter(header: str) -> str:
    """The most frequent candidate outside quotes in the header line."""
    counts: Counter[str] = Counter()
    quoted = False
    for char in header:
        if char == '"':
            quoted = not quoted
        elif char in DELIMITERS and not quoted:
            counts[char] += 1
    return counts.most_common(1)[0][0] if counts else ","


def _decoded(c: Column) -> Column:
    """UTF-8 if the bytes are valid UTF-8, else Latin-1, value by value.

    The scan reads bytes as Latin-1, which loses nothing, so no trial pass over
    the file is needed.
    """
    as_utf8 = F.encode(c, "ISO-8859-1").cast("string")
    return F.coalesce(F.try_validate_utf8(as_utf8), c)


def _header(text: str, sep: str | None) -> tuple[str, tuple[str, ...]]:
    """Delimiter and column names of a header record, quoted or not."""
    text = text.removeprefix("\ufeff").rstrip("\r\n")
    used = sep or sniff_delimiter(text)
    names = next(csv.reader(io.StringIO(text, newline=""), delimiter=used), [])
    return used, tuple(n.strip().strip('"') for n in names)


def _fields(names: Sequence[str]) -> T.StructType:
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    return schema.add(_OVERFLOW, T.StringType())


def _named(rows: DataFrame, names: Sequence[str], cell) -> DataFrame:
    # the first of equal names counts
    places = {n: i for i, n in reversed(list(enumerate(names)))}
    return rows.select(*[cell(f"c{i}").alias(n) for n, i in sorted(places.items(), key=lambda p: p[1])], "source_file")


def read_csv_flexible(spark: SparkSession, path: str | Sequence[str], sep: str | None = None) -> DataFrame:
    """CSV files of any delimiter and header, UTF-8 or Latin-1, gzip or plain, joined by column name.

    Each file has its own header and delimiter; columns come in the order of their first file, and a file without a column
    has nulls there. Quoted fields, headers included, may hold delimiters and line breaks. Over-long records and blank lines
    are skipped. All columns are texts; ``source_file`` names the file.

    One pass over the lines finds headers and quoted line breaks; only a header for each file comes to the driver. Files of one
    layout are one scan, splittable unless compressed; files with quoted line breaks go through ``records``.
    A gzip file is one split: ``spread`` it before wide work.
    """
    paths = [path] if isinstance(path, str) else list(path)
    found = heads(raw_lines(spark, paths)).orderBy("source_file").collect()
    if not found:
        raise ValueError(f"no rows found in {path}")
    broken = [r.source_file for r in found if r.broken]
    first = {r.source_file: r.head for r in found}
    whole = None
    if broken:
        whole = records(raw_lines(spark, [unquote(f) for f in broken]))
        first |= {r.source_file: r.record for r in whole.where("number = 1").collect()}
    layouts: dict[tuple, list[str]] = {}
    for r in found:
        layouts.setdefault((*_header(first[r.source_file], sep), r.broken), []).append(r.source_file)
    parts = []
    for (used, names, in_records), members in layouts.items():
        if in_records:
            cells = F.from_csv("record", F.lit(_fields(names).simpleString()[7:-1].replace(":", " ")), {"sep": used, "mode": "PERMISSIVE", "escape": "\""})
            rows = whole.where((F.col("number") > 1) & F.col("source_file").isin(members) & (F.trim("record") != "")).select(
                cells.alias("c"), "source_file"
            ).select("c.*", "source_file")
            parts.append(_named(rows.where(F.col(_OVERFLOW).isNull()), names, F.col))
        else:
            # bytes are read as Latin-1, which loses nothing, and decoded value by value
            rows = (
                spark.read.schema(_fields(names))
                .options(sep=used, header=True, encoding="ISO-8859-1", mode="PERMISSIVE", enforceSchema=True, escape="\"")
                .csv([unquote(f) for f in members])
            ).select("*", F.col("_metadata.file_path").alias("source_file"))
            parts.append(_named(rows.where(F.col(_OVERFLOW).isNull()), names, lambda c: _decoded(F.col(c))))
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part, allowMissingColumns=True)
    names = [c for c in joined.columns if c != "source_file"]
    return joined.select(*[F.col("`" + c.replace("`", "``") + "`") for c in names], "source_file")


def read_csv_strings(spark: SparkSession, path: str, sep: str = ";", case: str = "lower") -> DataFrame:
    """Open-data extract with a known delimiter; headers trimmed and unquoted."""
    return clean_headers(read_csv_flexible(spark, path, sep).drop("source_file"), case)


_COMMUNES = (
    "code string, nom string, codeDepartement string, codeRegion string, "
    "centre struct<coordinates: array<double>>, population int, codesPostaux array<string>"
)
_REGIONS = "code string, nom string"
_DEPARTMENTS = "code string, nom string, codeRegion string"


def flatten_communes(df: DataFrame) -> DataFrame:
    centre = F.col("centre.coordinates")
    return df.select(
        F.col("code").alias("code_commune"), F.col("nom").alias("nom_commune"),
        F.col("codeDepartement").alias("code_departement"), F.col("codeRegion").alias("code_region"),
        F.get(centre, F.lit(0)).alias("longitude"), F.get(centre, F.lit(1)).alias("latitude"),
        "population",
        F.array_join(F.coalesce("codesPostaux", F.array().cast("array<string>")), ",").alias("codes_postaux"),
    )


def read_communes(spark: SparkSession, path: str) -> DataFrame:
    return flatten_communes(spark.read.schema(_COMMUNES).option("multiLine", True).json(path))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(_REGIONS).option("multiLine", True).json(path)
    return rows.select(F.col("code").alias("code_region"), F.col("nom").alias("nom_region"))


def read_departments(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(_DEPARTMENTS).option("multiLine", True).json(path)
    return rows.select(
        F.col("code").alias("code_departement"), F.col("nom").alias("nom_departement"),
        F.col("codeRegion").alias("code_region"),
    )


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def load_history(spark: SparkSession, root: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All yearly marts under ``root``; ``data_year`` comes from the path.

    Reads ``annee=2023/`` partitions or ``2023/real_estate_commune_2023.parquet``
    files; paths that name no year contribute nothing.
    """
    rows = spark.read.options(mergeSchema=True, recursiveFileLookup=True).parquet(root)
    path = F.col("_metadata.file_path")
    named = F.regexp_extract(path, r"real_estate_commune_(\d{4})\.parquet", 1)
    partition = F.regexp_extract(path, r"annee=(\d{4})/", 1)
    year = F.when(partition != "", partition).when(named != "", named).cast("int")
    kept = [c for c in (columns or rows.columns)]
    return rows.select(*kept, year.alias("data_year")).where(F.col("data_year").isNotNull())
