import math

from pyspark.sql import functions as F

from parcelle import params as P
from parcelle.functions import finance as fin
from parcelle.operators import invest


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_annuity_and_debt_equal_the_monthly_loop(spark):
    for rate, years in ((3.65, 20), (0.0, 10)):
        t, n = rate / 1200, years * 12
        pay = 100_000 / n if t == 0 else 100_000 * t / (1 - (1 + t) ** -n)
        assert math.isclose(value(spark, fin.annuity(F.lit(100_000.0), rate, years)), pay)
        left = 100_000.0
        for month in range(1, n + 1):
            left = max(left - (pay - left * t), 0)
            if month in (1, 77, n):
                assert abs(value(spark, fin.remaining_debt(F.lit(100_000.0), rate, years, month)) - left) < 1e-4


def test_brackets(spark):
    assert [value(spark, fin.insurance_rate(a)) for a in (34, 35, 45, 54, 55)] == [0.10, 0.20, 0.35, 0.35, 0.50]
    assert [value(spark, fin.gross_yield(p)) for p in (1499, 1500, 2500, 7999, 8000)] == [7.0, 6.0, 5.0, 3.5, 3.0]
    assert value(spark, fin.market_rate(20)) == 3.65 and value(spark, fin.market_rate(22)) == P.MARKET_RATE_DEFAULT
    assert math.isclose(value(spark, fin.estimated_rent(F.lit(2000.0), 50, F.lit(0.0), True)), 2000 * 50 * 6 / 1200 * 1.15)


def _communes(spark):
    return spark.createDataFrame(
        [("1", 2000.0, 400, 2, None, None), ("2", 3000.0, 50_000, 100, 12.0, 18.0), ("3", 1000.0, None, None, 0.0, None)],
        "code_commune string, avg_price_m2 double, population int, transaction_count long, loyer_m2_app double, taux_tfb_dept double",
    )


def test_vacancy_levels(spark):
    got = {r.code_commune: r for r in invest.vacancy_risk(_communes(spark)).collect()}
    assert [got[k].risque_vacance for k in "123"] == [3, 0, 3]
    assert got["2"].detail_vacance == "Indicateurs favorables" and got["1"].mois_vacance == 4.8
    assert "400 hab." in got["1"].detail_vacance


def test_metrics_identities(spark):
    rows = invest.rental_metrics(_communes(spark)).collect()
    for r in rows:
        assert r.cashflow_net_fiscal <= r.cashflow_mensuel + 1e-9
        assert math.isclose(r.cout_acquisition_total, r.prix_bien_possible * 1.075 + 6_500)
    flat = invest.rental_metrics(_communes(spark).withColumn("taux_tfb_dept", F.lit(None).cast("double"))).first()
    assert flat.taxe_fonciere_estimee == 700.0  # no rate anywhere


def test_projection(spark):
    metrics = invest.vacancy_risk(invest.rental_metrics(_communes(spark)))
    rows = invest.project(metrics, horizon=5).where("code_commune = '2' and scenario = 'Neutre'").orderBy("annee").collect()
    assert [r.annee for r in rows] == [1, 2, 3, 4, 5]
    total = 0.0
    for r in rows:
        total += r.cashflow
        assert math.isclose(r.cashflow_cumule, total) and math.isclose(r.patrimoine_net, r.valeur - r.dette + total)
    assert invest.project(metrics, horizon=5).count() == 3 * 3 * 5
