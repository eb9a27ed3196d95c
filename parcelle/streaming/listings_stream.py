"""Listing messages to bronze tables and to a keep-latest change table."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from parcelle import params as P
from parcelle.operators.aggregates import listing_stats
from parcelle.operators.columns import computed_once
from parcelle.operators.dedup import latest_snapshot
from parcelle.operators.filters import valid_listings
from parcelle.operators.joins import translate_codes
from parcelle.sources.commits import append_batch
from parcelle.sources.commits import compact as compact_folders
from parcelle.sources.tables import as_declared, write_partitioned

log = logging.getLogger(__name__)
MESSAGE = (
    "listing_id string, source string, commune_code string, city string, price double, "
    "surface_m2 double, price_m2 double, rooms string, postal_code string, property_type string, "
    "energy_class string, url string, title string, description string, latitude double, "
    "longitude double, scraped_at string"
)
BRONZE = MESSAGE.replace("rooms string", "rooms int") + ", source_name string, source_date string"
BRONZE_BY = ["source_name", "source_date"]


def topic_names(sources: Sequence[str] | None = None, prefix: str = "listings") -> list[str]:
    chosen = [s for s in sources if s in P.LISTING_SOURCES] if sources else P.LISTING_SOURCES
    return [f"{prefix}.{s}" for s in chosen]


def kafka_options(servers: str, topics: Sequence[str]) -> dict[str, str]:
    """Options of the Kafka reader: several topics, from the earliest offset.

    A batch starts with 500 messages or after 60 seconds, whichever is first, and takes all there are.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(P.STREAM_BATCH_ROWS),
        "maxTriggerDelay": f"{P.STREAM_BATCH_SECONDS}s",
    }


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str]) -> DataFrame:
    """Messages as ``value`` text; needs the Kafka connector on the cluster."""
    return (
        spark.readStream.format("kafka").options(**kafka_options(servers, topics)).load()
        .select(F.col("value").cast("string").alias("value"))
    )


def decode(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """JSON to listing columns. ``source_name`` defaults to unknown; unreadable
    messages keep their text in ``quarantine``."""
    # only an object is a listing; other valid JSON is kept aside like unreadable text
    readable = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    day = F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd")
    parsed = computed_once(
        messages.select("value"),
        {"m": F.from_json("value", MESSAGE), "quarantine": F.when(~readable, F.col("value"))},
    )
    return parsed.select(
        "m.*",
        F.coalesce(F.nullif(F.col("m.source"), F.lit("")), F.lit("unknown")).alias("source_name"),
        day.alias("source_date"), "quarantine", "value",
    )


def encode(listings: DataFrame) -> DataFrame:
    """Key ``source_id`` (the commune without an id) and JSON value for a topic."""
    ident = F.coalesce(F.col("listing_id"), F.col("commune_code"), F.lit(""))
    return listings.select(
        F.concat_ws("_", "source", ident).alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish(listings: DataFrame, servers: str, topic: str) -> None:
    encode(listings).write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all",
           "kafka.compression.type": "gzip"}
    ).save()


def _trigger(writer: DataStreamWriter, drain: bool) -> DataStreamWriter:
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime="1 second")


def _bronze_rows(batch: DataFrame) -> DataFrame:
    return as_declared(batch.where(F.col("quarantine").isNull()).drop("quarantine", "value"), "bronze_listings")


def start_bronze(decoded: DataFrame, path: str, checkpoint: str, drain: bool = False):
    """Readable messages to Parquet by source and date, each batch committed once (``sources.commits``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(_bronze_rows(batch), path, BRONZE_BY, batch_id)

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, drain).start()


def start_two_sinks(decoded: DataFrame, bronze: str, archive: str, checkpoint: str, drain: bool = False):
    """Bronze plus an archive of the raw texts.

    A batch that was committed is not written again. The archive is best effort: its failure does not stop the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        append_batch(_bronze_rows(held), bronze, BRONZE_BY, batch_id)
        try:
            append_batch(held.select("source_name", "value", "quarantine"), archive, ["source_name"], batch_id)
        except Exception:  # noqa: BLE001
            log.exception("archive of batch %s skipped", batch_id)
        finally:
            held.unpersist()

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, drain).start()


def compact_bronze(spark: SparkSession, path: str, most: int = 8) -> int:
    """Brings the many small folders of a source's day together, in place."""
    return compact_folders(spark, path, BRONZE, BRONZE_BY, most)


def start_changes(listings: DataFrame, path: str, checkpoint: str, drain: bool = False):
    """Keep-latest change table: each batch adds its newest row per listing.

    No state and no rewrite of earlier data: reading takes the latest row over the
    batches, so late or repeated snapshots need no special case. The folder of a
    batch id is replaced on a retry.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_snapshot(batch, ties=["price_m2"])
        write_partitioned(newest.withColumn("batch_id", F.lit(batch_id)), path, ["batch_id"])

    writer = listings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, drain).start()


def current_listings(spark: SparkSession, path: str) -> DataFrame:
    """Newest row per listing over all batches of the change table."""
    return latest_snapshot(spark.read.parquet(path).drop("batch_id"), ties=["price_m2"])


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Rewrites the change table as one batch in a new place (the old one stays)."""
    rows = current_listings(spark, path).withColumn("batch_id", F.lit(-1))
    write_partitioned(rows, target, ["batch_id"])


def silver_listings(listings: DataFrame, communes: DataFrame | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Valid rows, postal codes translated, latest snapshot, figures per source and commune."""
    rows = valid_listings(listings)
    if communes is not None:
        rows = translate_codes(rows, communes)
    return listing_stats(latest_snapshot(rows, ties=ties))
