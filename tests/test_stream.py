import json

from pyspark.sql import functions as F

from parcelle.streaming import listings_stream as stream


def _message(**fields):
    return json.dumps({"commune_code": "1", "price_m2": 10.0, "scraped_at": "2024-01-01"} | fields)


def _source(spark, folder):
    return spark.readStream.schema("value string").text(str(folder))


def _done(handle):
    handle.awaitTermination()
    assert handle.exception() is None


def test_bronze_and_archive(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.txt").write_text("\n".join([_message(source="seloger", listing_id="1"), _message(listing_id="2"), "{broken"]))
    decoded = stream.decode(_source(spark, inbox), now=F.lit("2024-05-01").cast("timestamp"))
    places = [str(tmp_path / p) for p in ("bronze", "archive", "check")]
    _done(stream.start_two_sinks(decoded, *places, drain=True))
    bronze = spark.read.parquet(places[0])
    assert sorted((r.source_name, str(r.source_date)) for r in bronze.collect()) == [("seloger", "2024-05-01"), ("unknown", "2024-05-01")]
    assert spark.read.parquet(places[1]).where("quarantine is not null").count() == 1
    (inbox / "2.txt").write_text(_message(source="seloger", listing_id="3"))
    _done(stream.start_two_sinks(stream.decode(_source(spark, inbox)), *places, drain=True))  # restart
    assert spark.read.parquet(places[0]).count() == 3


def test_changes_keep_latest_over_batches(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    table, check = str(tmp_path / "table"), str(tmp_path / "check")
    steps = [
        [_message(source="s", listing_id="1", price_m2=1.0), _message(source="s", listing_id="", price_m2=5.0)],
        [_message(source="s", listing_id="1", price_m2=2.0, scraped_at="2024-01-03"), _message(source="s", listing_id="", price_m2=5.0)],
        [_message(source="s", listing_id="1", price_m2=3.0, scraped_at="2024-01-02")],  # arrives late
    ]
    for number, messages in enumerate(steps):
        (inbox / f"{number}.txt").write_text("\n".join(messages))
        rows = stream.decode(_source(spark, inbox)).where("quarantine is null").drop("value", "quarantine")
        _done(stream.start_changes(rows, table, check, drain=True))
    current = stream.current_listings(spark, table)
    assert sorted(r.price_m2 for r in current.collect()) == [2.0, 5.0, 5.0]
    stream.compact(spark, table, str(tmp_path / "compact"))
    assert stream.current_listings(spark, str(tmp_path / "compact")).count() == 3
    stats = stream.silver_listings(current).first()
    assert (stats.listing_count, stats.median_listing_price_m2) == (3, 5.0)


def test_topics(spark):
    assert stream.topic_names(["seloger", "other"]) == ["listings.seloger"] and len(stream.topic_names()) == 4
    options = stream.kafka_options("h:1", stream.topic_names())
    assert options["startingOffsets"] == "earliest" and options["minOffsetsPerTrigger"] == "500"
    assert options["maxTriggerDelay"] == "60s" and "maxOffsetsPerTrigger" not in options
    sent = stream.encode(spark.createDataFrame([("s", None, "75056")], "source string, listing_id string, commune_code string")).first()
    assert sent.key == "s_75056" and json.loads(sent.value)["source"] == "s"


def test_only_objects_are_listings(spark):
    messages = spark.createDataFrame([("5",), ('{"source": "s"}',), ("[1]",), ("x{",)], "value string")
    kept = {r.value for r in stream.decode(messages).collect() if r.quarantine is not None}
    assert kept == {"5", "[1]", "x{"}
