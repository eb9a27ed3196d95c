"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning carries most of the scale story: it measures shuffle
# output, so joins are broadcast only after their real size is known and
# over-full partitions of a skewed join are split.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "parcelle", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; keyword settings use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in ADAPTIVE_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the session names none and runs in one local process (tests) is a
    temporary folder made; a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="parcelle-")


def fan_out(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitions by ``keys`` with the session's full partition count.

    For rows that are few in bytes but fan out to much work: adaptive execution
    would merge their small partitions, which it leaves alone after an explicit count.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once under the shared folder and reads it back.

    Used where several later steps start from one expensive table: it is computed
    once, its lineage ends in storage (a lost executor re-reads files) and, unlike
    a checkpoint, the scan still prunes columns and knows its size.
    """
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
