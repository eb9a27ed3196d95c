"""Line dedup, in DataFrame functions only: later copies of runs of ``MIN_LINES`` lines, or of fewer with ``MIN_WORDS`` words, are deleted.

Each text is a sequence of line names over its lines with a word (lines without one are left alone). Hashed windows of up to
``MIN_LINES`` lines replace a suffix array: whether a run of that many lines occurred before is all the rule asks, so
neither suffix order nor common prefixes nor maximal runs are computed. Windows are named within their row by
combining shorter ones, without a shuffle, and grouped by length and name; the first occurrence (by id, then place) stays, and every
line of a later one is deleted. Shorter windows count where they hold ``MIN_WORDS`` words or more.

Names are 128-bit codes and need no global numbering. Groups are added up with map-side combination, so a hot run costs
one row per task, and its occurrences come back by a join whose hot keys adaptive execution splits.

Nulls are empty texts; null ids come last. Repeated rows are later copies of each other. A run may overlap
itself: each occurrence but the first is deleted. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import BLANKS, kept_table, keyed

MIN_LINES = 3
# Runs of fewer lines count as well where they are as long as a passage.
MIN_WORDS = 50


def _longer(name: str, line: str, join) -> Column:
    """Runs longer by one line: each run of ``name`` with the line of ``line`` after it."""
    size = F.greatest(F.size(name) - 1, F.lit(0))
    left = F.slice(name, F.lit(1), size)
    right = F.slice(line, F.size(line) - size + 1, size)
    return F.zip_with(left, right, join)


def _counting(n: int, min_words: int) -> Column:
    """The runs of ``n`` lines that hold ``min_words`` words."""
    named = F.arrays_zip(F.col(f"a{n}").alias("a"), F.col(f"b{n}").alias("b"), F.col(f"w{n}").alias("w"))
    placed = F.transform(
        named, lambda x, j: F.struct(x.a.alias("a"), x.b.alias("b"), F.slice("at", j + 1, n).alias("at"), F.lit(n).alias("lines"), x.w.alias("w"))
    )
    return F.filter(placed, lambda x: x.w >= min_words)


def _windows(texts: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """``(key, place, at, a, b, lines)``: names of the runs that start at each line and count, with their places and length."""
    lines = texts.select("key", "place", F.split("text", "\n").alias("lines"))
    worded = lines.withColumn(
        "rows",
        F.expr("filter(transform(lines, (l, i) -> named_struct('l', l, 'i', i)), x -> x.l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"),
    ).select("key", "place", "rows")
    name = lambda *salt: F.transform("rows", lambda x: F.xxhash64(*salt, x.l))
    words = f"transform(rows, x -> cast(size(filter(split(x.l, '{BLANKS}'), w -> w <> '')) as long))".replace("\\", "\\\\")
    one = worded.select(
        "key", "place", F.col("rows.i").alias("at"),
        name().alias("a1"), name(F.lit("second")).alias("b1"), F.expr(words).alias("w1"),
    )
    # all lengths of a text are named in its row, so that the lines are split once
    for n in range(2, min_lines + 1):
        mixed, added = lambda x, y: F.xxhash64(x, y), lambda x, y: x + y
        one = one.select(
            "*", _longer(f"a{n - 1}", "a1", mixed).alias(f"a{n}"), _longer(f"b{n - 1}", "b1", mixed).alias(f"b{n}"),
            _longer(f"w{n - 1}", "w1", added).alias(f"w{n}"),
        )
    runs = F.concat(*[_counting(n, 0 if n == min_lines else min_words) for n in range(1, min_lines + 1)])
    return one.select("key", "place", F.explode(runs).alias("n")).select("key", "place", "n.at", "n.a", "n.b", "n.lines")


def repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_lines: int = MIN_LINES,
    carry: list[str] | None = None, min_words: int = MIN_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The keyed texts and ``(key, gone)``, the sorted places of the lines to delete."""
    texts = keyed(docs, id_column, text_column, carry)
    windows = kept_table(_windows(texts, min_lines, min_words), "line-runs")
    intervals = (
        windows.groupBy("lines", "a", "b").agg(F.min(F.struct("place", "key", "at")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("lines", "a", "b", "first")
    )
    later = windows.join(intervals, ["lines", "a", "b"]).where(F.struct("place", "key", "at") != F.col("first"))
    gone = later.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("gone"))
    return texts, gone


def line_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_lines: int = MIN_LINES,
    carry: list[str] | None = None, min_words: int = MIN_WORDS,
) -> DataFrame:
    """``(doc_id, n_lines, n_removed, gone, kept_text)`` for each document, with the columns ``carry`` in ``carried``."""
    texts, gone = repeated_lines(docs, id_column, text_column, min_lines, carry, min_words)
    carried = ["carried"] if carry else []
    lines = F.split("text", "\n")
    cut = texts.join(gone, "key", "left").withColumn("lines", lines)
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = cut.select(
        *carried, "doc_id", "text", "gone", "lines", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNotNull(), stays).alias("stays"),
    )
    return kept.select(
        *carried, "doc_id", "n_lines", "n_removed", "gone",
        F.when(F.col("gone").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform("stays", lambda i: F.element_at("lines", i + 1)), "\n")).alias("kept_text"),
    )
