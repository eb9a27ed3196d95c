"""CSV records whose quoted fields may hold line breaks, from files that stay splittable.

A line break ends a record if the quotes before it are even in number. Each split counts its own quotes; the running sum over the
splits of a file tells whether a split begins inside quotes, and a running sum inside the split does the same for its lines. Both
ways a split may begin are counted at once, so records are numbered across splits without reading a file in one task. Only the
lines of records that span several are brought together.

A file with an odd number of quotes has a stray one; its lines are records. A stray pair joins what lies between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(line, source_file, block, at)``: lines in the order of ``at`` within a split that begins at byte ``block``.

    Lines are UTF-8 where their bytes are, else Latin-1.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block")
    ).withColumn("at", F.monotonically_increasing_id())
    text = F.coalesce(F.try_validate_utf8("value"), F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    return lines.select(text.alias("line"), "source_file", "block", "at", _quotes(F.col("value")).alias("quotes"))


def _quotes(line):
    return F.octet_length(line) - F.octet_length(F.translate(line, '"', ""))


def heads(lines: DataFrame) -> DataFrame:
    """``(source_file, head, broken)``: the first line of each file and whether some record may span lines."""
    # numbers only, so that no task sorts its lines; the first lines are taken in a second reading
    splits = lines.groupBy("source_file", "block").agg(
        F.min("at").alias("at"), F.sum("quotes").alias("quotes"), F.sum(F.col("quotes") % 2).alias("odd")
    )
    files = splits.groupBy("source_file").agg(
        F.min_by("at", "block").alias("at"), ((F.sum("quotes") % 2 == 0) & (F.sum("odd") > 0)).alias("broken")
    )
    return lines.select("at", F.col("line").alias("head")).join(F.broadcast(files), "at").select("source_file", "head", "broken")


def records(lines: DataFrame) -> DataFrame:
    """``(source_file, number, record)``: the records of each file, numbered from 1."""
    split = Window.partitionBy("source_file", "block")
    earlier = split.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    seen = lines.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    begins = lambda parity: F.count_if(F.col("inside") == parity)
    splits = seen.groupBy("source_file", "block").agg(
        F.sum("quotes").alias("all"), begins(0).alias("from_outside"), begins(1).alias("from_inside")
    )
    # a row for each split, so a file's rows are few
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("start", F.coalesce(F.sum("all").over(before), F.lit(0)) % 2).withColumn(
        "begun", F.when(F.col("start") == 0, F.col("from_outside")).otherwise(F.col("from_inside"))
    ).select("source_file", "block", "start", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("known"))
    is_begin = F.col("inside") == F.col("start")
    up_to = split.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = seen.join(placed, ["source_file", "block"]).select(
        "source_file", "block", "at", "line", (is_begin & (F.col("quotes") % 2 == 0)).alias("whole"),
        (F.col("known") + F.sum(is_begin.cast("long")).over(up_to)).alias("number"),
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "line")))
    several = numbered.where("not whole").groupBy("source_file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p.line), "\n").alias("record")
    )
    return numbered.where("whole").select("source_file", "number", F.col("line").alias("record")).unionByName(several)
