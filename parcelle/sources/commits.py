"""Tables of batch folders with a commit log.

Layout: ``<table>/<partition>=.../batch_id=N/part-*.parquet`` and a log ``<table>/_commits`` of small JSON files, one for each
commit, that says which folders a commit adds and which it replaces. A file of the log appears as a whole or not at all, so a
commit does too; folders that no commit names are left-overs of failed attempts and never read. Writer, reader, compaction
and table registration share the log: an earlier batch is recognised by its id and not written twice, compaction swaps many
small folders of a partition for one in place, and ``sync_partitions`` gives a registered table exactly the live folders.

The log grows by a row for each folder; it is read and reduced by Spark. Only the list of folders to read or register comes
to the driver, as with any partition listing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_commits"
_LOG_SCHEMA = "version bigint, batch_id bigint, writer string, add array<string>, remove array<string>, entries bigint"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def by_commits(spark: SparkSession, path: str) -> bool:
    """Whether the table has a commit log."""
    return _exists(spark, f"{path}/{LOG}")


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The log: a row for each commit."""
    if not by_commits(spark, path):
        return spark.createDataFrame([], _LOG_SCHEMA)
    return spark.read.schema(_LOG_SCHEMA).json(f"{path}/{LOG}")


def live_folders(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, version)`` added by a commit and replaced by none."""
    log = commits(spark, path)
    added = log.select(F.explode("add").alias("folder"), "version")
    return added.join(log.select(F.explode("remove").alias("folder")), "folder", "left_anti")


def _known(spark: SparkSession, path: str, batch_id: int, writer: str) -> tuple[bool, int]:
    """Whether a batch is in the table, and the last version, by one look at the log."""
    mine = (F.col("batch_id") == batch_id) & (F.col("writer") == writer)
    found = commits(spark, path).agg(F.max(mine), F.max("version")).first()
    return bool(found[0]), found[1] or 0


def commit(spark: SparkSession, path: str, batch_id: int, add: Sequence[str], remove: Sequence[str] = (), writer: str = "stream",
           entries: int = 0, last: int | None = None) -> None:
    """Adds a file to the log: written aside under a name that no reader lists, then renamed. ``last`` spares a look at the log."""
    if last is None:
        last = commits(spark, path).agg(F.max("version")).first()[0] or 0
    row = {"version": last + 1, "batch_id": batch_id, "writer": writer, "add": list(add), "remove": list(remove), "entries": entries}
    place = spark._jvm.org.apache.hadoop.fs.Path
    files, name = place(path).getFileSystem(spark._jsc.hadoopConfiguration()), uuid.uuid4().hex
    aside, seen = place(f"{path}/{LOG}/.{name}.tmp"), place(f"{path}/{LOG}/part-{name}.json")
    out = files.create(aside, False)
    try:
        out.write(bytearray((json.dumps(row) + "\n").encode()))
    finally:
        out.close()
    if not files.rename(aside, seen):
        raise OSError(f"no commit of batch {batch_id} under {path}")


def _write(df: DataFrame, path: str, by: Sequence[str], folder_id: int) -> list[str]:
    """Writes the folders of a batch, replacing those of a failed attempt, and returns their names.

    The rebalance hint brings a partition's rows into few files and, with adaptive execution, splits a large one.
    """
    (
        df.hint("rebalance", *by).withColumn("batch_id", F.lit(folder_id).cast("bigint")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch_id").parquet(path)
    )
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{'*/' * len(by)}batch_id={folder_id}")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted("/".join(f.getPath().toString().split("/")[-len(by) - 1 :]) for f in found or ())


def append_batch(df: DataFrame, path: str, by: Sequence[str], batch_id: int, writer: str = "stream") -> bool:
    """Adds a batch; ``False`` if a batch of this id is in the table already."""
    spark = df.sparkSession
    known, last = _known(spark, path, batch_id, writer)
    if known:
        return False
    commit(spark, path, batch_id, _write(df, path, by, batch_id), writer=writer, last=last)
    return True


def read_committed(spark: SparkSession, path: str, schema: str, folders: Sequence[str] | None = None) -> DataFrame:
    """Rows of the live folders, or of those named, with their ``batch_id``. ``schema`` holds the columns with the partitions."""
    names = folders if folders is not None else [r.folder for r in live_folders(spark, path).select("folder").collect()]
    whole = f"{schema}, batch_id bigint"
    if not names:
        return spark.createDataFrame([], whole)
    columns = spark.createDataFrame([], whole).columns
    rows = spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/{n}" for n in sorted(names)])
    return rows.select(*columns)


def compact(spark: SparkSession, path: str, schema: str, by: Sequence[str], most: int = 1,
            merge: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Swaps the folders of each partition that holds more than ``most`` for one; returns how many went.

    ``merge`` may bring the rows of a partition together, such as sums; without it they stay as they are.

    Readers see the table before or after, never in between: the new folders are unknown until the commit. Replaced folders
    stay for readers that still list them until ``vacuum``.
    """
    partition = F.regexp_replace("folder", "/?batch_id=-?[0-9]+$", "")
    many = live_folders(spark, path).groupBy(partition.alias("p")).agg(F.collect_list("folder").alias("folders")).where(
        F.size("folders") > most
    )
    old = [f for r in many.collect() for f in r.folders]
    if not old:
        return 0
    folder_id = -(uuid.uuid4().int >> 66)
    rows = read_committed(spark, path, schema, old)
    new = _write(merge(rows) if merge else rows.drop("batch_id"), path, by, folder_id)
    commit(spark, path, folder_id, new, old, writer="compaction")
    return len(old)


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes replaced folders; only when no reader uses an older listing any more."""
    log = commits(spark, path)
    gone = [r.folder for r in log.select(F.explode("remove").alias("folder")).distinct().collect()]
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{f}"), True) for f in gone)


def sync_partitions(spark: SparkSession, name: str, path: str) -> None:
    """Gives the registered table ``name`` exactly the live folders as partitions."""
    registered = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    live = {r.folder for r in live_folders(spark, path).select("folder").collect()}
    spec = lambda folder: ", ".join(
        "{}='{}'".format(k, v.replace("'", "\\'")) for k, v in (unquote(p).split("=", 1) for p in folder.split("/"))
    )
    for folder in sorted(registered - live):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec(folder)})")
    for folder in sorted(live - registered):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec(folder)}) LOCATION '{path}/{folder}'")
    spark.catalog.refreshTable(name)
