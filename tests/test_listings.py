import json

from pyspark.sql import functions as F

from parcelle.operators import listings as L

PAGE = '<html><script id="__NEXT_DATA__" type="application/json">{}</script><script type="application/ld+json">{}</script></html>'


def _pages(spark, *html):
    rows = [(i, h, "75056", "94600", "t") for i, h in enumerate(html)]
    return spark.createDataFrame(rows, "i int, html string, location string, postal_code string, scraped_at string")


def test_embedded_json(spark):
    listed = json.dumps({"props": {"pageProps": {"listings": [{"id": 1}, {"id": 2}]}}})
    pages = _pages(
        spark,
        PAGE.format(listed, json.dumps({"id": 9})),
        PAGE.format("{}", json.dumps([{"id": 3}, {"id": 4}])),
        PAGE.format("{bad", json.dumps({"id": 5})),
        PAGE.format('{"props":{"pageProps":{"listings":"none"}}}', "{bad"),
    )
    got = L.extract_embedded_json(pages).select("i", F.get_json_object("payload", "$.id").alias("id")).collect()
    assert sorted((r.i, r.id) for r in got) == [(0, "1"), (0, "2"), (1, "3"), (1, "4"), (2, "5")]


def test_seloger(spark):
    payloads = [
        {"id": "a", "prix": "250 000 €", "surface": "50,5 m²", "rooms": "3", "ville": "Paris", "codePostal": 75001},
        {"id": "b", "price": None, "surface": "50"}, {"id": "c", "price": 100000, "surface": "0"},
    ]
    raw = spark.createDataFrame([(json.dumps(p), "75056", "t") for p in payloads], "payload string, location string, scraped_at string")
    rows = L.normalize_listings(raw, "seloger").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.listing_id, r.price, r.surface_m2, r.price_m2, r.rooms, r.city, r.postal_code) == (
        "a", 250000.0, 50.5, 4950.5, 3, "Paris", "75001",
    )
    assert r.source == "seloger" and r.commune_code == "75056"


def test_cdc_cards(spark):
    lots = {"lots": [{"id_lot": "L1", "id_article": "A1", "nb_prix": "150 000", "latitude": "48.1"},
                     {"id_lot": "L2", "nb_prix": "90 000"}, {"id_lot": "L3", "nb_prix": ""}]}
    html = (
        f"<script>var searchBootstrap = {json.dumps(lots)};</script>"
        '<div class="residenceCard"><a href="/x/zzz">Studio</a> 20 m2</div>'
        '<div class="residenceCard"><a href="/x/A1">Maison</a> 62,5 m&sup2; 3 pi&egrave;ces CHOISY-LE-ROI (94600)</div>'
    )
    rows = {r.listing_id: r for r in L.normalize_listings(L.extract_lots(_pages(spark, html)), "cdc_habitat").collect()}
    assert set(rows) == {"cdc_L1_A1", "cdc_L2_"}
    first, second = rows["cdc_L1_A1"], rows["cdc_L2_"]
    assert (first.price, first.surface_m2, first.price_m2, first.rooms) == (150000.0, 62.5, 2400.0, 3)
    assert (first.property_type, first.city, first.url) == ("maison", "Choisy-Le-Roi", L.CDC_BASE + "/x/A1")
    assert (second.surface_m2, second.property_type, second.city) == (None, "appartement", "75056")


def test_leboncoin_last_attribute_wins(spark):
    ad = {"list_id": 7, "price": [100], "attributes": [{"key": "square", "values": ["40"]}, {"key": "square", "value_label": "50,0"}]}
    raw = spark.createDataFrame([(json.dumps(ad), "p", "t"), ("{bad", "p", "t")], "payload string, location string, scraped_at string")
    rows = L.normalize_listings(raw, "leboncoin").collect()
    assert [(r.listing_id, r.surface_m2, r.price_m2) for r in rows] == [("7", 50.0, 2.0)]


def test_leboncoin_looks_each_attribute_up_once(spark):
    payloads = [
        '{"list_id": 1, "price": [100], "attributes": [{"key": "square", "values": ["20"]}, {"key": "square", "value_label": "50,5"}, null]}',
        '{"list_id": 2, "price": [100], "attributes": [{"key": "rooms_surface_area", "values": ["40"]}, {"value_label": "x"}, {"key": "square"}]}',
        '{"list_id": 3, "price": [100], "attributes": null}', '{"list_id": 4, "price": [100]', "",
        '{"list_id": 5, "price": [90], "attributes": [{"key": "square", "values": []}, {"key": "square", "values": ["9"]}, {"key": "rooms", "values": ["2"]}]}',
    ]
    raw = spark.createDataFrame([(p, "75056", "t") for p in payloads], "payload string, location string, scraped_at string")
    rows = L.normalize_listings(raw, "leboncoin")
    assert {(r.listing_id, r.surface_m2, r.price_m2, r.rooms) for r in rows.collect()} == {
        ("1", 50.5, 1.98, None), ("2", 40.0, 2.5, None), ("5", 9.0, 10.0, 2),
    }
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position") == 5 and "lambdafunction" not in plan and plan.count("from_json") == 1
