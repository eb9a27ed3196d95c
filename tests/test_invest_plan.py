from parcelle.operators import invest


def test_projection_shuffles_nothing(spark):
    row = (["1"], [100_000.0, 80_000.0, 450.0, 600.0, 2_000.0, 0.05])
    columns = "code_commune string, prix_bien_possible double, montant_emprunte double, mensualite_commune double, loyer_estime double, charges_tot_annuelles double, taux_vacance double"
    df = spark.createDataFrame([(*row[0], *row[1]), ("2", *[None] * 6)], columns)
    years = invest.project(df, horizon=25)
    plan = years._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    rows = [r for r in years.where("code_commune = '1'").collect()]
    for scenario in {r.scenario for r in rows}:
        total = 0.0
        for r in sorted((r for r in rows if r.scenario == scenario), key=lambda r: r.annee):
            total += r.cashflow
            assert abs(r.cashflow_cumule - total) < 1e-6
        assert r.annee == 25 and r.credit == 0.0
    assert {r.cashflow_cumule for r in years.where("code_commune = '2'").collect()} == {None}
