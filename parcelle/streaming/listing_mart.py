"""Listing figures kept up to date by the stream.

Keyed state holds the latest snapshot of each listing. A newer snapshot takes the older one back: the state emits the old
row with weight -1 and the new one with weight +1, also when the listing moved to another commune; late or repeated
snapshots emit nothing. Rows without an id are all distinct and pass with +1.

A batch adds its weighted prices to a table in buckets of (source, commune), and then the figures of the touched groups, from
the live rows of their buckets only. Both tables are committed per batch (``sources.commits``), so a batch that runs again after
a failure finds what it has done. Buckets of many batches are compacted in place by adding up equal prices.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from parcelle.operators.aggregates import listing_stats
from parcelle.operators.dedup import top_per_key
from parcelle.session import stored
from parcelle.sources.commits import append_batch, compact, live_folders, read_committed

BUCKETS = 16
MOST_FOLDERS = 16
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SNAPSHOT = T.StructType([
    T.StructField("commune_code", T.StringType()), T.StructField("price_m2", T.DoubleType()), T.StructField("scraped_at", T.StringType()),
])
CHANGE = "source string, commune_code string, price_m2 double, scraped_at string, weight bigint"
PRICES = "source string, commune_code string, price_m2 double, scraped_at string, weight bigint, bucket int"
FIGURES = (
    "source_name string, code_commune string, listing_count bigint, avg_listing_price_m2 double, median_listing_price_m2 double, "
    "min_listing_price_m2 double, max_listing_price_m2 double, last_updated string, bucket int"
)


def _age(snapshot: tuple) -> tuple:
    """Order of snapshots: by time, missing ones first, then by price."""
    _, price, time = snapshot
    return (time is not None, time or "", price)


def _newest(frame: pd.DataFrame) -> tuple:
    """The first of the latest rows by ``_age``, whole columns at a time: a listing may hold a large share of a batch."""
    timed = frame[frame["scraped_at"].notna()]
    if len(timed):
        frame = timed[timed["scraped_at"] == timed["scraped_at"].max()]
    row = frame.iloc[int(frame["price_m2"].to_numpy().argmax())]
    return (row.commune_code, float(row.price_m2), row.scraped_at if len(timed) else None)


class LatestSnapshot(StatefulProcessor):
    """Keeps the latest snapshot of a listing and emits what changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._latest = handle.getValueState("latest", _SNAPSHOT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(self._latest.get()) if self._latest.exists() else None
        latest = before
        for frame in rows:
            snapshot = _newest(frame)
            if latest is None or _age(snapshot) > _age(latest):
                latest = snapshot
        if latest == before:
            return
        self._latest.update(latest)
        changes = [(key[0], *latest, 1)] + ([(key[0], *before, -1)] if before else [])
        yield pd.DataFrame(changes, columns=["source", "commune_code", "price_m2", "scraped_at", "weight"])

    def close(self) -> None:
        pass


def changes(listings: DataFrame) -> DataFrame:
    """Weighted changes of a stream of valid listings; needs ``STATE_STORE`` as the session's state store."""
    has_id = F.coalesce(F.col("listing_id"), F.lit("")) != ""
    row = listings.select(
        "source", "listing_id", "commune_code", F.col("price_m2").cast("double").alias("price_m2"), F.col("scraped_at").cast("string").alias("scraped_at")
    ).where(F.col("source").isNotNull())
    kept = row.where(has_id).groupBy("source", "listing_id").transformWithStateInPandas(
        LatestSnapshot(), outputStructType=CHANGE, outputMode="Append", timeMode="None"
    )
    return kept.unionByName(row.where(~has_id).drop("listing_id").withColumn("weight", F.lit(1).cast("bigint")))


def _bucket(source: str, commune: str):
    return F.pmod(F.xxhash64(source, commune), F.lit(BUCKETS)).cast("int")


def _added(rows: DataFrame) -> DataFrame:
    """Equal prices of a group with their weights added up; those taken back in full are gone."""
    return rows.groupBy("source", "commune_code", "price_m2", "scraped_at", "bucket").agg(F.sum("weight").alias("weight")).where(
        F.col("weight") != 0
    )


def _refresh(batch: DataFrame, batch_id: int, root: str, most: int) -> None:
    spark = batch.sparkSession
    # written first: a second pass over the batch would run the state again
    new = stored(batch.withColumn("bucket", _bucket("source", "commune_code")), "listing-changes")
    append_batch(_added(new), f"{root}/prices", ["bucket"], batch_id)
    groups = new.select("source", "commune_code", "bucket").distinct()
    touched = {r.bucket for r in groups.select("bucket").distinct().collect()}
    live = [r.folder for r in live_folders(spark, f"{root}/prices").collect()]
    mine = [f for f in live if int(f.split("/")[0].split("=")[1]) in touched]
    rows = _added(read_committed(spark, f"{root}/prices", PRICES, mine).join(groups.drop("bucket"), ["source", "commune_code"], "left_semi"))
    single = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("weight").cast("int"))))
    figures = groups.select(F.col("source").alias("source_name"), F.col("commune_code").alias("code_commune"), "bucket").join(
        listing_stats(single), ["source_name", "code_commune"], "left"
    )
    # a group that lost its last listing counts none from here on
    append_batch(figures.withColumn("listing_count", F.coalesce("listing_count", F.lit(0).cast("bigint"))), f"{root}/figures", ["bucket"], batch_id)
    if len(mine) > most * len(touched):
        compact(spark, f"{root}/prices", PRICES, ["bucket"], merge=_added)
        compact(spark, f"{root}/figures", FIGURES, ["bucket"], merge=lambda df: _latest(df).drop("batch_id"))


def start_mart(listings: DataFrame, root: str, checkpoint: str, drain: bool = False, most: int = MOST_FOLDERS):
    """Keeps ``<root>/prices`` and ``<root>/figures`` up to date with a stream of valid listings."""
    spark = listings.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, STATE_STORE)
    try:
        writer = changes(listings).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, batch_id: _refresh(batch, batch_id, root, most)
        )
        return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime="1 second")).start()
    finally:
        spark.conf.set(setting, before)


def _latest(figures: DataFrame) -> DataFrame:
    # compacted folders have negative ids and hold what was latest at their time
    return top_per_key(figures, ["source_name", "code_commune"], [F.col("batch_id").desc()])


def current_figures(spark: SparkSession, root: str) -> DataFrame:
    """Figures per source and commune as of the last committed batch."""
    rows = read_committed(spark, f"{root}/figures", FIGURES)
    return _latest(rows).where("listing_count > 0").drop("batch_id", "bucket")
