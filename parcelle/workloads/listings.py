"""Listings: extraction from payloads, keep-latest, translation, figures, stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from parcelle.operators import aggregates, columns, dedup, filters, joins
from parcelle.operators import listings as L
from parcelle.plans import serving
from parcelle.session import fan_out, work_folder
from parcelle.sources import tables
from parcelle.streaming import listing_mart
from parcelle.streaming import listings_stream as stream
from parcelle.workloads import standins as S
from parcelle.workloads.registry import ORACLES, query, rounded

BATCH = f"{S.LISTINGS}, {S.VALID}, {S.LATEST}, {S.LISTING_STATS}"
STATS = """SELECT source_name, code_commune, listing_count, rnd(avg_listing_price_m2, 4) AS avg_listing_price_m2,
    rnd(median_listing_price_m2, 4) AS median_listing_price_m2, min_listing_price_m2, max_listing_price_m2, last_updated
    FROM listing_stats"""


@query("latest_snapshot", f"WITH {S.LISTINGS}, {S.VALID}, {S.LATEST} SELECT * FROM latest")
def latest_snapshot(spark, folder):
    return dedup.latest_snapshot(filters.valid_listings(S.listings(spark, folder)), ties=["event_id"])


@query(
    "exact_dedup",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def exact_dedup(spark, folder):
    return dedup.exact_rows(S.table(spark, folder, "events").select("user_id", "event_type"))


@query(
    "first_per_key",
    """SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS p
       FROM documents) WHERE p = 1""",
)
def first_per_key(spark, folder):
    docs = S.table(spark, folder, "documents").select("source", "doc_id", "n_chars")
    return dedup.first_per_key(docs, ["source"], [F.desc("n_chars"), F.col("doc_id")])


POSTAL = """postal AS (
    SELECT code AS lookup_code, max_by(code_commune, (coalesce(population, -1), code_commune)) AS translated
    FROM (SELECT unnest(string_split(codes_postaux, ',')) AS code, code_commune, population FROM communes) GROUP BY 1),
lookup AS (
    SELECT code_commune AS lookup_code, code_commune AS translated FROM communes
    UNION ALL SELECT * FROM postal WHERE lookup_code NOT IN (SELECT code_commune FROM communes))"""


@query(
    "postal_translation",
    f"""WITH {S.LISTINGS}, {S.COMMUNES}, {POSTAL} SELECT event_id, coalesce(translated, commune_code) AS commune_code
        FROM listings LEFT JOIN lookup ON lookup_code = commune_code""",
)
def postal_translation(spark, folder):
    rows = S.listings(spark, folder).select("event_id", "commune_code")
    return joins.translate_codes(rows, S.communes(spark, folder))


@query("postal_lookup", f"WITH {S.COMMUNES}, {POSTAL} SELECT * FROM lookup")
def postal_lookup(spark, folder):
    return joins.postal_lookup(S.communes(spark, folder))


@query("listing_stats", f"WITH {BATCH} {STATS}")
def listing_stats(spark, folder):
    return rounded(S.listing_stats(spark, folder))


@query(
    "listing_stats_translated",
    f"""WITH {S.LISTINGS}, {S.COMMUNES}, {POSTAL}, valid AS (
        SELECT * REPLACE (coalesce(translated, commune_code) AS commune_code) FROM listings LEFT JOIN lookup
        ON lookup_code = commune_code WHERE price_m2 > 0), {S.LATEST}, {S.LISTING_STATS} {STATS}""",
)
def listing_stats_translated(spark, folder):
    return rounded(stream.silver_listings(S.listings(spark, folder), S.communes(spark, folder), ["event_id"]))


@query(
    "listing_weighted_mean",
    f"""WITH {BATCH} SELECT code_commune, CAST(sum(listing_count) AS BIGINT) AS listing_count,
        rnd(sum(avg_listing_price_m2 * listing_count) / sum(listing_count), 4) AS avg_listing_price_m2
        FROM listing_stats GROUP BY 1""",
)
def listing_weighted_mean(spark, folder):
    return rounded(aggregates.weighted_listing_mean(S.listing_stats(spark, folder)))


@query(
    "listing_unweighted",
    f"""WITH {BATCH} SELECT code_commune, rnd(avg(avg_listing_price_m2), 4) AS avg_listing_price_m2,
        CAST(sum(listing_count) AS BIGINT) AS listing_count FROM listing_stats GROUP BY 1""",
)
def listing_unweighted(spark, folder):
    return rounded(aggregates.plain_listing_mean(S.listing_stats(spark, folder)))


_FULL = f"""{S.SALES}, {S.GOLD}, {S.PRICES}, {BATCH}, listed AS (
    SELECT code_commune, avg(avg_listing_price_m2) AS avg_listing_price_m2, sum(listing_count) AS listing_count
    FROM listing_stats GROUP BY 1)"""


@query(
    "commune_full_view",
    f"""WITH {_FULL} SELECT code_commune, transaction_count, rnd(avg_price_m2, 4) AS avg_price_m2,
        rnd(avg_listing_price_m2, 4) AS avg_listing_price_m2, CAST(listing_count AS BIGINT) AS listing_count
        FROM prices LEFT JOIN listed USING (code_commune)""",
)
def commune_full_view(spark, folder):
    prices = S.prices(spark, folder).select("code_commune", "transaction_count", "avg_price_m2")
    return rounded(serving.commune_full(prices, S.listing_stats(spark, folder)))


@query(
    "listing_gap",
    f"""WITH {_FULL}, weighted AS (SELECT code_commune, sum(avg_listing_price_m2 * listing_count) / sum(listing_count)
            AS avg_listing_price_m2 FROM listing_stats GROUP BY 1)
        SELECT code_commune, rnd(avg_price_m2, 4) AS avg_price_m2, rnd(avg_listing_price_m2, 4) AS avg_listing_price_m2,
        rnd((avg_listing_price_m2 - avg_price_m2) / avg_price_m2 * 100, 4) AS ecart_pct
        FROM prices JOIN weighted USING (code_commune)""",
)
def listing_gap(spark, folder):
    prices = S.prices(spark, folder).select("code_commune", "avg_price_m2")
    return rounded(joins.listing_gap(prices, aggregates.weighted_listing_mean(S.listing_stats(spark, folder))))


@query(
    "listings_top",
    f"""WITH {BATCH} {STATS} WHERE source_name = 'click'
        ORDER BY avg_listing_price_m2 DESC NULLS LAST, code_commune LIMIT 100""",
)
def listings_top(spark, folder):
    return serving.listings(rounded(S.listing_stats(spark, folder)), source="click")


@query(
    "listings_up_to",
    """SELECT event_id, price FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 0.0
       ELSE value END AS price FROM events) WHERE price IS NULL OR price <= 40""",
)
def listings_up_to(spark, folder):
    key = F.col("event_id")
    price = F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, 0.0).otherwise(F.col("value"))
    return filters.listings_up_to(S.table(spark, folder, "events").select("event_id", price.alias("price")), 40)


# Payloads are built from the line items, so every portal's parser runs over all of them.
def _envelope():
    return [F.lit("75056").alias("location"), F.lit("2024-01-01T00:00:00+00:00").alias("scraped_at")]


_SHAPE = """listing_id, source, commune_code, city, price, surface_m2, price_m2, rooms, postal_code, property_type,
    energy_class, url, title, photo, latitude, longitude, scraped_at"""
_ABSENT = {
    "text": "CAST(NULL AS VARCHAR)", "double": "CAST(NULL AS DOUBLE)", "int": "CAST(NULL AS INTEGER)",
}


def _oracle(fields: dict[str, str], source: str, where: str, table: str = "lineitem") -> str:
    kinds = {"price": "double", "surface_m2": "double", "price_m2": "double", "latitude": "double",
             "longitude": "double", "rooms": "int"}
    fixed = {"source": f"'{source}'", "commune_code": "'75056'", "scraped_at": "'2024-01-01T00:00:00+00:00'"}
    cells = fixed | fields
    names = [n.strip() for n in _SHAPE.replace("\n", " ").split(",")]
    listed = ", ".join(f"{cells.get(n, _ABSENT[kinds.get(n, 'text')])} AS {n}" for n in names)
    return f"SELECT {listed} FROM {table} WHERE {where}"


def _items(spark, folder):
    return S.wide_work(spark, folder, "lineitem")


_ID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


def _id():
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


@query(
    "normalize_seloger",
    _oracle(
        {
            "listing_id": _ID, "city": "'Ville ' || l_returnflag", "price": "CAST(l_extendedprice AS DOUBLE)",
            "surface_m2": "l_quantity", "price_m2": "rnd(l_extendedprice / l_quantity, 2)", "rooms": "l_linenumber",
            "postal_code": "CAST(l_suppkey AS VARCHAR)", "url": "'/a/' || CAST(l_partkey AS VARCHAR)",
            "property_type": "l_linestatus",
        },
        "seloger", "l_orderkey % 20 <> 0 AND l_quantity <> 0",
    ),
)
def normalize_seloger(spark, folder):
    odd = F.col("l_orderkey") % 2 == 1
    blank = F.col("l_orderkey") % 20 == 0
    price = F.when(blank, F.lit(None)).otherwise(
        F.concat(F.replace(F.format_number("l_extendedprice", 2), F.lit(","), F.lit(" ")), F.lit(" €"))
    )
    surface = F.concat(F.replace(F.col("l_quantity").cast("string"), F.lit("."), F.lit(",")), F.lit(" m²"))
    payload = F.when(
        odd,
        F.to_json(F.struct(
            _id().alias("id"), price.alias("price"), surface.alias("surface"), F.col("l_linenumber").alias("rooms"),
            F.concat(F.lit("Ville "), "l_returnflag").alias("city"), F.col("l_suppkey").alias("postalCode"),
            F.concat(F.lit("/a/"), F.col("l_partkey").cast("string")).alias("url"), F.col("l_linestatus").alias("type"),
        )),
    ).otherwise(
        F.to_json(F.struct(
            _id().alias("idAnnonce"), price.alias("prix"), F.col("l_quantity").alias("surfaceArea"),
            F.col("l_linenumber").cast("string").alias("nombreDePieces"),
            F.struct(F.concat(F.lit("Ville "), "l_returnflag").alias("addressLocality")).alias("address"),
            F.col("l_suppkey").cast("string").alias("codePostal"),
            F.concat(F.lit("/a/"), F.col("l_partkey").cast("string")).alias("lien"), F.col("l_linestatus").alias("typeBien"),
        ))
    )
    return L.normalize_listings(_items(spark, folder).select(payload.alias("payload"), *_envelope()), "seloger")


@query(
    "normalize_leboncoin",
    _oracle(
        {
            "listing_id": _ID, "city": "'Ville ' || l_returnflag", "price": "CAST(l_extendedprice AS DOUBLE)",
            "surface_m2": "l_quantity", "price_m2": "rnd(l_extendedprice / l_quantity, 2)", "rooms": "l_linenumber",
            "postal_code": "CAST(l_suppkey AS VARCHAR)", "url": "'/a/' || CAST(l_partkey AS VARCHAR)",
            "property_type": "l_linestatus", "energy_class": "CASE WHEN l_orderkey % 2 = 1 THEN 'C' END",
        },
        "leboncoin", "l_orderkey % 20 <> 0 AND l_quantity <> 0",
    ),
)
def normalize_leboncoin(spark, folder):
    odd = F.col("l_orderkey") % 2 == 1
    none = F.lit(None).cast("string")

    def attribute(key, label, value):
        return F.struct(F.lit(key).alias("key"), label.alias("value_label"), F.array(value).alias("values"))

    surface = F.replace(F.col("l_quantity").cast("string"), F.lit("."), F.lit(","))
    attributes = F.array(
        attribute("square", F.when(odd, surface), F.when(odd, none).otherwise(surface)),
        attribute("rooms", none, F.col("l_linenumber").cast("string")),
        attribute("real_estate_type", F.col("l_linestatus"), none),
        attribute("energy_rate", F.when(odd, F.lit("C")), none),
    )
    payload = F.to_json(F.struct(
        _id().alias("list_id"),
        F.when(F.col("l_orderkey") % 20 == 0, F.array().cast("array<double>")).otherwise(F.array("l_extendedprice")).alias("price"),
        F.struct(F.concat(F.lit("Ville "), "l_returnflag").alias("city"), F.col("l_suppkey").cast("string").alias("zipcode")).alias("location"),
        F.concat(F.lit("/a/"), F.col("l_partkey").cast("string")).alias("url"), attributes.alias("attributes"),
    ))
    return L.normalize_listings(_items(spark, folder).select(payload.alias("payload"), *_envelope()), "leboncoin")


@query(
    "normalize_bienici",
    _oracle(
        {
            "listing_id": _ID, "title": "'Bien ' || CAST(l_partkey AS VARCHAR)", "city": "''",
            "price": "CAST(l_extendedprice AS DOUBLE)", "surface_m2": "CASE WHEN l_orderkey % 20 <> 0 THEN l_quantity END",
            "price_m2": "CASE WHEN l_orderkey % 20 <> 0 AND l_quantity > 0 THEN rnd(l_extendedprice / l_quantity, 0) END",
            "rooms": "l_linenumber", "url": "'https://www.bienici.com/a/' || CAST(l_partkey AS VARCHAR)",
            "photo": "'p' || CAST(l_suppkey AS VARCHAR)",
        },
        "bienici", "true",
    ),
)
def normalize_bienici(spark, folder):
    photo = F.struct(F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("url_photo"))
    payload = F.to_json(F.struct(
        _id().alias("id"), F.concat(F.lit("Bien "), F.col("l_partkey").cast("string")).alias("title"),
        F.col("l_extendedprice").alias("price"), F.when(F.col("l_orderkey") % 20 != 0, F.col("l_quantity")).alias("surfaceArea"),
        F.col("l_linenumber").alias("roomsQuantity"), F.concat(F.lit("/a/"), F.col("l_partkey").cast("string")).alias("url"),
        F.array(photo).alias("photos"),
    ))
    return L.normalize_listings(_items(spark, folder).select(payload.alias("payload"), *_envelope()), "bienici")


@query(
    "normalize_cdc",
    _oracle(
        {
            "listing_id": "'cdc_' || CAST(o_orderkey AS VARCHAR) || '_A' || CAST(o_orderkey AS VARCHAR)",
            "commune_code": "'94600'", "postal_code": "'94600'",
            "city": "CASE WHEN o_orderkey % 2 = 1 THEN 'Choisy-Le-Roi' ELSE 'Vanves' END",
            "price": "CAST(CAST(floor(o_totalprice) AS INTEGER) AS DOUBLE)",
            "surface_m2": "CASE WHEN o_orderkey % 2 = 1 THEN o_custkey % 90 + 10.5 END",
            "price_m2": "CASE WHEN o_orderkey % 2 = 1 AND CAST(floor(o_totalprice) AS INTEGER) <> 0 THEN rnd(CAST(floor(o_totalprice) AS INTEGER) / (o_custkey % 90 + 10.5), 2) END",
            "rooms": "CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_custkey % 5 + 1 AS INTEGER) END",
            "property_type": "CASE WHEN o_orderkey % 4 = 1 THEN 'maison' ELSE 'appartement' END",
            "url": """CASE WHEN o_orderkey % 2 = 1 THEN 'https://www.cdc-habitat.fr/lot/' || CAST(o_orderkey AS VARCHAR) || '/x'
                      ELSE 'https://www.cdc-habitat.fr/annonces-immobilieres/vente/' || CAST(o_orderkey AS VARCHAR) END""",
            "latitude": "48.5", "scraped_at": "'2024-01-01T00:00:00+00:00'",
        },
        "cdc_habitat", "o_orderkey % 20 <> 0", "orders",
    ),
)
def normalize_cdc(spark, folder):
    """Search page with a script of lots and cards: one lot with, or without, its card."""
    key, odd = F.col("o_orderkey"), F.col("o_orderkey") % 2 == 1
    price = F.when(key % 20 == 0, "").otherwise(
        F.replace(F.format_number(F.col("o_totalprice").cast("int"), 0), F.lit(","), F.lit(" "))
    )
    lot = F.to_json(F.struct(
        F.struct(F.lit(1)).alias("search"),
        F.array(F.struct(
            key.cast("string").alias("id_lot"), F.concat(F.lit("A"), key.cast("string")).alias("id_article"),
            price.alias("nb_prix"), F.lit("48.5").alias("latitude"),
        )).alias("lots"),
    ))
    card = F.format_string(
        '<div class="residenceCard big"><a href="/lot/%s/x">%s</a><p>%s&nbsp;m&sup2; - %s pi&egrave;ces</p>CHOISY-LE-ROI (94600)</div>',
        key, F.when(key % 4 == 1, "Maison neuve").otherwise("Bel appartement"),
        F.replace((F.col("o_custkey") % 90 + 10.5).cast("string"), F.lit("."), F.lit(",")), F.col("o_custkey") % 5 + 1,
    )
    other = F.lit('<div class="residenceCard"><a href="/lot/none/x">Autre</a> 10 m2</div>')
    html = F.concat(
        F.lit("<html><script>var searchBootstrap = "), lot, F.lit(";</script>"), other,
        F.when(odd, card).otherwise(""), F.lit("</html>"),
    )
    pages = S.wide_work(spark, folder, "orders").select(
        html.alias("html"), F.lit("Vanves").alias("location"), F.lit("94600").alias("postal_code"), _envelope()[1]
    )
    return L.normalize_listings(L.extract_lots(pages), "cdc_habitat")


@query(
    "embedded_json",
    """WITH p AS (SELECT page_id, url, unnest(CASE page_id % 4 WHEN 0 THEN ['a', 'b'] WHEN 1 THEN ['c', 'd', 'e']
                  WHEN 2 THEN ['f'] ELSE CAST([] AS VARCHAR[]) END) AS id FROM pages)
       SELECT page_id, id, url FROM p""",
)
def embedded_json(spark, folder):
    """Page data, linked data and broken scripts added to every stored page."""
    kind = F.col("page_id") % 4
    item = lambda i: F.format_string('{"id":"%s","url":%s}', F.lit(i), F.to_json(F.array("url")))
    next_data = F.format_string(
        '<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"%s":[%s,%s]}}}</script>',
        F.when(F.col("page_id") % 8 == 0, "listings").otherwise("results"), item("a"), item("b"),
    )
    linked = F.format_string(
        '<script type="application/ld+json">[%s,%s]</script><script type="application/ld+json">{bad</script>'
        '<script type="application/ld+json"> %s </script>', item("c"), item("d"), item("e"),
    )
    single = F.format_string('<script type="application/ld+json">%s</script>', item("f"))
    html = F.concat("html", F.when(kind == 0, next_data).when(kind == 1, linked).when(kind == 2, single).otherwise(""))
    found = L.extract_embedded_json(S.wide_work(spark, folder, "pages").withColumn("html", html))
    return found.select(
        "page_id", F.get_json_object("payload", "$.id").alias("id"), F.get_json_object("payload", "$.url[0]").alias("url")
    )


_RENT = """SELECT code_commune, loyer_m2_app, loyer_m2_app_min, loyer_m2_app_max, nb_annonces_app, qualite_app,
    loyer_m2_app12, nb_annonces_app12, loyer_m2_app3, nb_annonces_app3, coalesce(nb_annonces_app, 0) > 0 AS marche_locatif_actif"""


@query(
    "rents_merge",
    f"""WITH a AS (SELECT {S.CODE_SQL.format('p_partkey')} AS code_commune, p_size * 1.0 AS loyer_m2_app, p_size * 0.5 AS loyer_m2_app_min,
            p_size * 2.0 AS loyer_m2_app_max, CAST(p_partkey % 4 AS BIGINT) AS nb_annonces_app, p_type AS qualite_app FROM part),
        b AS (SELECT {S.CODE_SQL.format('c_custkey')} AS code_commune, c_acctbal AS loyer_m2_app12, CAST(c_nationkey AS BIGINT) AS nb_annonces_app12 FROM customer),
        c AS (SELECT {S.CODE_SQL.format('s_suppkey')} AS code_commune, s_acctbal AS loyer_m2_app3, CAST(s_nationkey AS BIGINT) AS nb_annonces_app3 FROM supplier)
        {_RENT} FROM a LEFT JOIN b USING (code_commune) LEFT JOIN c USING (code_commune)""",
)
def rents_merge(spark, folder):
    """Part, customer and supplier as the three rent files."""
    def source(df, key, price, ads, quality):
        return df.select(
            S.code_of(key).alias("code_commune"), price.alias("loypredm2"), (price * 0.5).alias("lwr.IPm2"),
            (price * 2).alias("upr.IPm2"), ads.cast("bigint").alias("nbobs_com"), quality.alias("TYPPRED"),
        )

    renames = {"loypredm2": "loyer_m2_{}", "lwr.IPm2": "loyer_m2_{}_min", "upr.IPm2": "loyer_m2_{}_max",
               "nbobs_com": "nb_annonces_{}", "TYPPRED": "qualite_{}"}
    parts = S.table(spark, folder, "part"), S.table(spark, folder, "customer"), S.table(spark, folder, "supplier")
    all_flats = source(parts[0], "p_partkey", F.col("p_size") * 1.0, F.col("p_partkey") % 4, F.col("p_type"))
    small = source(parts[1], "c_custkey", F.col("c_acctbal"), F.col("c_nationkey"), F.lit("x"))
    large = source(parts[2], "s_suppkey", F.col("s_acctbal"), F.col("s_nationkey"), F.lit("x"))
    merged = joins.merge_rents(*[
        columns.suffix_columns(df, renames, suffix, ["code_commune"])
        for df, suffix in ((all_flats, "app"), (small, "app12"), (large, "app3"))
    ])
    return merged.select(
        "code_commune", "loyer_m2_app", "loyer_m2_app_min", "loyer_m2_app_max", "nb_annonces_app", "qualite_app",
        "loyer_m2_app12", "nb_annonces_app12", "loyer_m2_app3", "nb_annonces_app3", "marche_locatif_actif",
    )


def _event_stream(spark, folder):
    """The events table as a stream of JSON messages, some broken or without source."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return events.select(_message(F.col("event_id")).alias("value"))


def _message(key):
    message = F.to_json(F.struct(
        F.when(key % 13 == 0, F.lit("")).otherwise(F.get_json_object("props", "$.k")).alias("listing_id"),
        F.when(key % 29 != 0, F.col("event_type")).alias("source"),
        S.code_of("user_id").alias("commune_code"),
        F.col("value").alias("price_m2"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
    ))
    return F.when(key % 31 == 0, F.lit("{broken")).otherwise(message)


def _drained(query_handle):
    query_handle.awaitTermination()
    if query_handle.exception():
        raise query_handle.exception()


@query(
    "stream_routing",
    """SELECT CASE WHEN event_id % 29 = 0 THEN 'unknown' ELSE event_type END AS source_name, count(*) AS messages,
       rnd(sum(value), 2) AS total FROM events WHERE event_id % 31 <> 0 GROUP BY 1""",
)
def stream_routing(spark, folder):
    """Messages decoded and routed by source into the bronze table."""
    place = f"{work_folder(spark)}/bronze-{uuid.uuid4().hex}"
    decoded = stream.decode(_event_stream(spark, folder))
    _drained(stream.start_bronze(decoded, f"{place}/table", f"{place}/checkpoint", drain=True))
    bronze = spark.read.parquet(f"{place}/table")
    return rounded(bronze.groupBy("source_name").agg(F.count(F.lit(1)).alias("messages"), F.sum("price_m2").alias("total")), 2)


@query(
    "stream_listing_stats",
    f"""WITH listings AS (
        SELECT CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(json_extract_string(props, '$.k') AS VARCHAR) END AS listing_id,
               CASE WHEN event_id % 29 = 0 THEN 'unknown' ELSE event_type END AS source,
               {S.CODE_SQL.format('user_id')} AS commune_code, value AS price_m2,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS scraped_at, value AS event_id
        FROM events WHERE event_id % 31 <> 0), {S.VALID}, {S.LATEST}, {S.LISTING_STATS} {STATS}""",
)
def stream_listing_stats(spark, folder):
    """Stream into the keep-latest change table, then figures per source and commune."""
    place = f"{work_folder(spark)}/changes-{uuid.uuid4().hex}"
    decoded = stream.decode(_event_stream(spark, folder)).where(F.col("quarantine").isNull())
    listings = filters.valid_listings(decoded.withColumn("source", F.col("source_name")).select(
        "listing_id", "source", "commune_code", "price_m2", "scraped_at"
    ))
    _drained(stream.start_changes(listings, f"{place}/table", f"{place}/checkpoint", drain=True))
    return rounded(aggregates.listing_stats(stream.current_listings(spark, f"{place}/table")))


@query("stream_listing_refresh", ORACLES["stream_listing_stats"])
def stream_listing_refresh(spark, folder):
    """Figures kept by the stream over five arrivals: four shares of the messages in no order of time, then a replay."""
    place = f"{work_folder(spark)}/mart-{uuid.uuid4().hex}"
    key = F.col("event_id")
    events = S.table(spark, folder, "events")
    for share in [key % 4 == k for k in (2, 0, 3, 1)] + [(key % 10 < 3) & (key % 13 != 0)]:
        # each share arrives as the files its tasks write, and the stream goes on where it stopped
        fan_out(events.where(share)).select(_message(key).alias("value")).write.mode("append").text(f"{place}/inbox")
        decoded = stream.decode(spark.readStream.schema("value string").text(f"{place}/inbox")).where(F.col("quarantine").isNull())
        listings = filters.valid_listings(decoded.withColumn("source", F.col("source_name")).select(
            "listing_id", "source", "commune_code", "price_m2", "scraped_at"
        ))
        _drained(listing_mart.start_mart(listings, f"{place}/table", f"{place}/checkpoint", drain=True, most=2))
    return rounded(listing_mart.current_figures(spark, f"{place}/table"))


@query(
    "bronze_table_counts",
    """SELECT CASE WHEN event_id % 29 = 0 THEN 'unknown' ELSE event_type END AS source_name, count(*) AS messages,
       count(DISTINCT user_id) AS communes, rnd(sum(value), 2) AS total FROM events WHERE event_id % 31 <> 0 GROUP BY 1""",
)
def bronze_table_counts(spark, folder):
    """The registered table over what the stream wrote, before and after a compaction in place."""
    name = uuid.uuid4().hex
    place = f"{work_folder(spark)}/bronze-{name}"
    path, database = f"{place}/bronze_listings", f"bronze_{name}"
    decoded = stream.decode(_event_stream(spark, folder))
    _drained(stream.start_bronze(decoded, path, f"{place}/checkpoint", drain=True))
    tables.register_tables(spark, place, ["bronze_listings"], database)
    stream.compact_bronze(spark, path, most=0)
    tables.repair(spark, f"{database}.bronze_listings", path)
    rows = spark.table(f"{database}.bronze_listings")
    return rounded(rows.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("commune_code").alias("communes"), F.sum("price_m2").alias("total")
    ), 2)


@query(
    "topic_messages",
    f"""SELECT event_type || '_' || CAST(json_extract_string(props, '$.k') AS VARCHAR) AS key, count(*) AS n,
        min(value) AS cheapest FROM events GROUP BY 1""",
)
def topic_messages(spark, folder):
    """Keyed JSON messages as they would be published, read back."""
    rows = S.table(spark, folder, "events").select(
        F.get_json_object("props", "$.k").alias("listing_id"), F.col("event_type").alias("source"),
        S.code_of("user_id").alias("commune_code"), "value",
    )
    sent = stream.encode(rows)
    return sent.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.get_json_object("value", "$.value").cast("double")).alias("cheapest")
    )
