"""Web captures: not-modified revisits take their body and headers from the response they confirm.

A record has an id, a type (``response`` or ``revisit``), a url, a time, a status, a map of lower-case header names
and, for responses, a payload. Each revisit is joined as-of with the latest earlier full response (status 200 with a
payload) of its canonical url, in the order of (time, id). Its validators are then checked: an entity tag (compared
weakly) if it has one, else the modification date, else the payload digest. A confirmed revisit gets the
response's payload and headers, with those headers replaced that a not-modified answer may update.

The as-of join has two levels: records are range-partitioned by (url, time, id) into a written table, a
window runs within each url's rows of one partition, and the last response of each partition is carried to the url's later ones.
So a url that holds a third of all rows is spread over as many partitions as its rows fill. Only metadata
is sorted; payloads come back by a join on the record id, whose hot keys adaptive execution splits.

Nulls: a record without url or time matches nothing; null headers are no headers. Repeated records with one id are taken once,
the first by time, kind, url, fullness and payload code, with that row's own payload. A record without an id cannot be
named as a base: each has a row of its own, revisits as ``no-response``. Results per revisit: ``resolved``, ``mismatch``, ``unvalidated`` (no validator) or ``no-response``.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.common import kept_table

# fixed values: header fields that a not-modified answer carries and a stored response takes over
UPDATED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified")
DROPPED_PARAMETERS = "utm_[a-z]+|ref|fbclid|gclid"
ROWS_PER_PART = 200_000


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, fragment, tracking parameters, default page and last slash go; the host is lower-cased."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"(/index\.html?|/)$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({DROPPED_PARAMETERS})(=|$)"))
    )
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _tag(value: Column) -> Column:
    return F.regexp_replace(value, "^W/", "")


def resolve_revisits(records: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """A row for each record id and for each record without one:
    ``record_id, kind, time, resolution, base_id, headers, payload``.

    ``records``: record_id long, kind string, url string, time long, status int, headers map, payload.
    Responses keep their own headers and payload and have no resolution.
    """
    spark = records.sparkSession
    headers = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull()
    named = records.where("record_id is not null").select(
        "record_id", "kind", canonical_url(F.col("url")).alias("key"), "time", full.alias("full"), headers.alias("headers"),
        F.xxhash64("payload").alias("body"), "payload",
    )
    # one row of each id, for its metadata and for its payload alike
    order = F.struct("time", "kind", "key", "full", "body", F.array_sort(F.map_entries("headers")))
    once = named.groupBy("record_id").agg(
        F.min_by(F.struct("kind", "key", "time", "full", "headers"), order).alias("r")
    ).select("record_id", "r.*")
    once = kept_table(once, "records")
    usable = once.where("key is not null and time is not null")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), usable.count() // rows_per_part + 1)
    placed = kept_table(
        usable.repartitionByRange(parts, "key", "time", "record_id").withColumn("part", F.spark_partition_id()), "placed"
    )
    base = F.when(F.col("full"), F.struct(F.col("record_id").alias("id"), F.col("headers").alias("headers")))
    within = Window.partitionBy("key", "part").orderBy("time", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("near", F.last(base, ignorenulls=True).over(within))
    ends = placed.where("full").groupBy("key", "part").agg(
        F.max_by(F.struct(F.col("record_id").alias("id"), F.col("headers").alias("headers")), F.struct("time", "record_id")).alias("end")
    )
    present = placed.select("key", "part").distinct().join(ends, ["key", "part"], "left")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = present.withColumn("carried", F.last("end", ignorenulls=True).over(before)).where("carried is not null")
    matched = (
        local.where("kind = 'revisit'").join(carried.select("key", "part", "carried"), ["key", "part"], "left")
        .select("record_id", F.coalesce("near", "carried").alias("base"))
    )
    revisits = once.where("kind = 'revisit'").select("record_id", "time", F.col("headers").alias("own")).join(
        matched, "record_id", "left"
    )
    old, own = F.col("base.headers"), F.col("own")
    checks = [("etag", _tag), ("last-modified", lambda c: c), ("warc-payload-digest", lambda c: c)]
    agrees = F.lit("unvalidated")
    for name, plain in reversed(checks):
        same = plain(own[name]) == plain(old[name])
        agrees = F.when(own[name].isNotNull(), F.when(same, "resolved").otherwise("mismatch")).otherwise(agrees)
    judged = revisits.withColumn("resolution", F.when(F.col("base").isNull(), "no-response").otherwise(agrees))
    good = F.col("resolution") == "resolved"
    updates = F.map_filter("own", lambda k, _: k.isin(*UPDATED))
    merged = F.map_concat(F.map_filter("base.headers", lambda k, _: ~F.map_contains_key(updates, k)), updates)
    answered = judged.select(
        "record_id", F.lit("revisit").alias("kind"), "time", "resolution", F.when(good, F.col("base.id")).alias("base_id"),
        F.when(good, merged).otherwise(own).alias("headers"),
    )
    bodies = named.groupBy(F.col("record_id").alias("base_id")).agg(F.min_by("payload", order).alias("payload"))
    responses = once.where("not (kind <=> 'revisit')").select(
        "record_id", "kind", "time", F.lit(None).cast("string").alias("resolution"), F.col("record_id").alias("base_id"), "headers"
    )
    revisit = F.col("kind") == "revisit"
    nameless = records.where("record_id is null").select(
        "record_id", "kind", "time", F.when(revisit, F.lit("no-response")).alias("resolution"),
        F.lit(None).cast("long").alias("base_id"), headers.alias("headers"),
        F.when(revisit, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
    )
    return answered.unionByName(responses).join(bodies, "base_id", "left").select(
        "record_id", "kind", "time", "resolution", "base_id", "headers", "payload"
    ).unionByName(nameless)


def captures(pages: DataFrame) -> DataFrame:
    """Records derived from ``pages(page_id, url, html)``: a response for each page and a later revisit of its url.

    Revisits carry an entity tag, a modification date, a tag that has changed, or none, by turns; they lie
    half a day after the page, so that a second capture of the url may come between.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.md5(F.col("html").cast("binary"))
    stamp = F.concat(F.lit("t"), F.col("page_id").cast("string"))
    turn = F.pmod("page_id", F.lit(4))
    response = p.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", (F.col("page_id") * 60).alias("time"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("etag"), F.concat(F.lit("W/"), digest), F.lit("last-modified"), stamp, F.lit("content-type"), F.lit("text/html"),
                     F.lit("date"), stamp).alias("headers"),
        F.col("html").alias("payload"),
    )
    fresh = F.concat(F.lit("r"), F.col("page_id").cast("string"))
    tags = (
        F.when(turn == 0, F.create_map(F.lit("etag"), digest, F.lit("date"), fresh))
        .when(turn == 1, F.create_map(F.lit("last-modified"), stamp, F.lit("content-type"), F.lit("none")))
        .when(turn == 2, F.create_map(F.lit("etag"), F.concat(digest, F.lit("x")), F.lit("date"), fresh))
        .otherwise(F.create_map(F.lit("date"), fresh))
    )
    revisit = p.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url",
        (F.col("page_id") * 60 + 43_200).alias("time"), F.lit(304).alias("status"), tags.alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return response.unionByName(revisit)
