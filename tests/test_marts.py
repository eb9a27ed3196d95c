import pytest

from parcelle.operators import aggregates, filters, joins, quality
from parcelle.operators.dedup import latest_snapshot
from parcelle.operators.scoring import min_max_scores, persona_scores
from parcelle.plans import gold as G
from parcelle.plans import serving
from parcelle.plans.territory import territory_scores

SALES = "code_commune string, nom_commune string, year int, valeur_fonciere double, surface_reelle_bati double, prix_m2 double"


def _sales(spark):
    rows = []
    for year, price in ((2020, 1000.0), (2021, 1500.0), (2023, 3000.0)):
        rows += [("00001", "A", year, price * 10, 10.0, price)] * 3
    rows += [("00002", "B", 2021, 1.0, 1.0, p) for p in (200.0, 30000.0, 30000.5, 199.9)]  # two stay
    rows += [("00003", "C", 2020, 1.0, 1.0, 500.0)] * 3 + [("00003", "c", 2020, 1.0, 1.0, 800.0)] * 6
    rows += [("00003", "C", 2021, 1.0, 1.0, 1400.0)] * 3
    return spark.createDataFrame(rows, SALES)


def test_gold_support_and_yoy(spark):
    gold = G.with_yoy(G.commune_prices(_sales(spark)))
    got = {(r.code_commune, r.nom_commune, r.year): r.price_m2_yoy_variation for r in gold.collect()}
    assert got[("00001", "A", 2020)] is None and got[("00001", "A", 2021)] == 0.5
    assert got[("00001", "A", 2023)] is None  # the year before is missing
    assert not any(k[0] == "00002" for k in got)
    assert got[("00003", "C", 2021)] == 1.0  # against 700, the two spellings weighted by sales
    assert gold.columns == G.GOLD_COLUMNS


def test_gold_against_stored_previous_year(spark):
    sales = _sales(spark)
    previous = G.with_previous(G.commune_prices(sales.where("year = 2020")), None)
    current = G.with_previous(G.commune_prices(sales.where("year = 2021")), previous)
    assert {r.code_commune: r.price_m2_yoy_variation for r in current.collect()} == {"00001": 0.5, "00003": 1.0}


def test_quality_gate(spark):
    rows = [(f"{i:05d}", 1000.0 + i, 5, 2021, 0.1) for i in range(120)]
    ddl = "code_commune string, avg_price_m2 double, transaction_count long, year int, price_m2_yoy_variation double"
    good = spark.createDataFrame(rows, ddl)
    assert all(r["passed"] for r in quality.gate(quality.gold_checks(good, 2021)))
    warned = spark.createDataFrame(rows[1:] + [("00000", 1000.0, 5, 2021, 1.4)], ddl)
    assert [r["name"] for r in quality.gate(quality.gold_checks(warned, 2021)) if not r["passed"]] == ["yoy_variation_realistic"]
    bad = spark.createDataFrame(rows + [("00001", 100.0, 2, 2020, None), ("00001", None, 2, 2020, None), (None, 40000.0, 9, 2021, 2.0)], ddl)
    with pytest.raises(quality.QualityError) as error:
        quality.gate(quality.gold_checks(bad, 2021))
    for name in ("not_null", "minimum", "maximum", "sufficient", "duplicate", "year_matches"):
        assert name in str(error.value)
    empty = {r["name"]: r["passed"] for r in quality.gold_checks(good.limit(0), 2021).collect()}
    assert empty == {"non_empty": False, "required_columns_present": True}
    assert quality.gold_checks(good.drop("year"), 2021).count() == 2


def test_latest_snapshot_and_blank_ids(spark):
    df = spark.createDataFrame(
        [("s", "1", "2024-01-01", 1.0), ("s", "1", "2024-01-02", 2.0), ("t", "1", "2024-01-01", 3.0),
         ("s", "", "2024-01-01", 4.0), ("s", "", "2024-01-01", 5.0), ("s", None, "2024-01-01", 6.0)],
        "source string, listing_id string, scraped_at string, v double",
    )
    assert sorted(r.v for r in latest_snapshot(df).collect()) == [2.0, 3.0, 4.0, 5.0, 6.0]
    plan = latest_snapshot(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # the map side already cuts each key


def test_postal_translation(spark):
    communes = spark.createDataFrame(
        [("01001", "01000, 01100", 10), ("01002", "01100", 90), ("01100", "", 5), ("01003", "01000", None)],
        "code_commune string, codes_postaux string, population int",
    )
    rows = spark.createDataFrame([("01000",), ("01100",), ("01002",), ("99999",)], "commune_code string")
    got = sorted(r[0] for r in joins.translate_codes(rows, communes).collect())
    assert got == ["01001", "01002", "01100", "99999"]  # 01100 is a valid code itself
    blank = spark.createDataFrame([(" ", 5.0), (None, 5.0), ("1", 0.0), ("1", None), ("1", 2.0)], "commune_code string, price_m2 double")
    assert filters.valid_listings(blank).count() == 1


def test_network_and_rental_values(spark):
    sites = spark.createDataFrame([("1001", "1,5", None), ("1001", "2,5", "4"), ("2", None, None)], "insee_com string, nb_4g string, nb_5g string")
    assert {r[0]: r[1] for r in aggregates.network_coverage(sites).collect()} == {"01001": 3.0, "00002": None}
    assert aggregates.network_coverage(sites.select("nb_4g")) is None
    rents = spark.createDataFrame([("D ", "1", "5"), ("D", "1", "7"), ("M", "1", "99"), ("D", "2", "x")], "nature_locaux string, code_commune string, vl_au_m2 string")
    assert [tuple(r) for r in aggregates.rental_values(rents).collect()] == [("00001", 6.0)]


def test_min_max_constant(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "k string, x double")
    assert {r.s for r in min_max_scores(df, {"s": "x"}).collect()} == {100.0}


def test_territory_without_optional_sources(spark):
    communes = spark.createDataFrame(
        [("1", "A", "01", "1", 45.0, 5.0, 100), ("2", "B", "01", "1", 46.0, 5.0, 900), ("3", "C", "01", "1", None, None, 5)],
        "code_commune string, nom_commune string, code_departement string, code_region string, latitude double, longitude double, population int",
    )
    gold = spark.createDataFrame(
        [("1", "x", 1000.0, 5), ("2", "x", 2000.0, 5), ("3", "x", 3000.0, 5)],
        "code_commune string, nom_commune string, avg_price_m2 double, transaction_count long",
    )
    got = {r.code_commune: r for r in territory_scores(communes, gold).collect()}
    assert set(got) == {"1", "2"} and got["1"].nom_commune == "A"
    assert got["1"].green_score == 50.0 and got["1"].network_score == 50.0
    assert got["1"].affordability_score == 66.67 and got["2"].transport_score == 100.0
    assert got["1"].investment_potential_score == 66.67 and got["1"].marche_locatif_actif is False
    scored = persona_scores(spark.createDataFrame([(100.0,)], "affordability_score double"))
    assert scored.first().score_etudiant == 100.0  # renormalised over the columns that exist


def test_serving_errors(spark):
    df = spark.createDataFrame([("1", "A")], "code_commune string, nom_commune string")
    with pytest.raises(ValueError):
        serving.ranking(df, "robot")
    with pytest.raises(ValueError):
        serving.compare(df, " , ")
    with pytest.raises(ValueError):
        serving.communes(df, limit=5_001)
    with pytest.raises(serving.NotFound):
        serving.commune(df, "9")
    assert serving.commune(df, "1").first().nom_commune == "A"
    assert G.price_history(df.selectExpr("code_commune", "2020 year", "1.0D avg_price_m2"), None, "1").count() == 1
