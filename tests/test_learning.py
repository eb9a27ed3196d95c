import random

import pytest
from pyspark.sql import functions as F

from parcelle.operators import forecast, similarity
from parcelle.plans import star


def _history(spark, years=(2018, 2019, 2020, 2021)):
    rows = [
        (f"{i:04d}", f"C{i}", y, 1000.0 + 20 * i + 50 * (y - 2018), 900.0, 90_000.0, 60.0, 5 + i % 7, None if y == 2018 else 0.05)
        for i in range(60) for y in years
    ]
    return spark.createDataFrame(
        rows, "code_commune string, nom_commune string, year int, avg_price_m2 double, median_price_m2 double, "
        "avg_price double, avg_surface double, transaction_count long, price_m2_yoy_variation double",
    )


def test_forecast_invariants(spark):
    history = _history(spark)
    pairs = forecast.training_set(history).cache()
    assert pairs.count() == 180
    naive = pairs.where("year = 2020").agg(F.avg(F.abs(F.col("target_price_m2") - F.col("avg_price_m2")))).first()[0]
    assert forecast.holdout_error(pairs, trees=10, depth=6) <= naive * 1.2
    got = forecast.forecast(history, 2023, trees=5, depth=5)
    rows = got.collect()
    assert len(rows) == 60 and all(r.predicted_avg_price_m2 > 0 and r.target_year == 2023 for r in rows)
    r = rows[0]
    assert abs(r.predicted_growth_pct - round((r.predicted_avg_price_m2 / r.last_avg_price_m2 - 1) * 100, 1)) <= 0.1
    with pytest.raises(ValueError):
        forecast.forecast(history, 2021)
    assert forecast.forecast(_history(spark, (2020,)), 2022) is None
    marts = star.export_marts(history, got, None)
    assert set(marts) == {"mart_commune_real_estate", "price_predictions"} and marts["price_predictions"].count() == 60


def test_similar(spark):
    rows = [("1", 0.0, 0.0, 7.0), ("2", 1.0, 0.0, 7.0), ("3", 5.0, 5.0, 7.0), ("4", None, None, 7.0), ("5", 0.5, None, 7.0)]
    df = spark.createDataFrame(rows, "code_commune string, transport_score double, green_score double, health_score double")
    got = similarity.similar(df, "1", top=2).collect()
    assert [r.code_commune for r in got] and got[-1].similarity == 0.0 and "1" not in [r.code_commune for r in got]
    assert similarity.similar(df, "x").count() == 0
    assert similarity.similar(df.select("code_commune", "green_score"), "1").count() == 0


def test_registered_forest_is_whole(spark, monkeypatch):
    """Both queries ask for the whole forest; a small one is fitted in its place to see them run to the end."""
    from parcelle.workloads import learning

    asked = []
    fit = forecast.RandomForestRegressor.fit

    def small(self, table):
        asked.append((self.getNumTrees(), self.getMaxDepth(), self.getCacheNodeIds()))
        return fit(self.setNumTrees(4).setMaxDepth(4), table)

    monkeypatch.setattr(learning.S, "gold", lambda *_: _history(spark))
    monkeypatch.setattr(forecast.RandomForestRegressor, "fit", small)
    rows = learning.rf_forecast(spark, "").collect()
    assert len(rows) == 60 and all(r.growth_follows and r.in_range and r.target_year == 2023 for r in rows)
    assert learning.forecast_holdout(spark, "").first().communes == 60
    assert asked == [(200, 30, True)] * 2


def test_similar_all_equals_brute_force(spark):
    rng = random.Random(11)
    centres = [[rng.uniform(0, 100) for _ in range(3)] for _ in range(8)]
    rows = [(f"k{i:03d}", *[x + rng.gauss(0, 3) for x in rng.choice(centres)]) for i in range(260)]
    rows += [(f"e{i:02d}", 50.0, 50.0, 50.0) for i in range(20)] + [("gap", 10.0, None, 20.0), ("none", None, None, None)]
    df = spark.createDataFrame(rows, "code_commune string, a double, b double, c double")
    got = {}
    for r in similarity.similar_all(df, top=4, columns=["a", "b", "c"]).collect():
        got.setdefault(r.code_commune, []).append((r.place, r.neighbour, r.similarity, round(r.distance, 9)))
    assert len(got) == len(rows) - 1
    for code in ("k000", "k100", "e00", "e19", "gap"):
        want = similarity.similar(df, code, top=4, columns=["a", "b", "c"]).collect()
        assert sorted(got[code]) == [(k + 1, r.code_commune, r.similarity, round(r.distance, 9)) for k, r in enumerate(want)]
    pool = {r.code_commune: (r.a, r.b, r.c) for r in similarity.standardise(
        similarity._known(df, ["a", "b", "c"], [], "code_commune"), ["a", "b", "c"]).collect()}
    for code, v in pool.items():
        near = sorted((sum((x - y) ** 2 for x, y in zip(v, w)), k) for k, w in pool.items())[:5]
        assert [n for _, n, _, _ in sorted(got[code])] == [k for _, k in near if k != code][:4]


def test_similar_all_compares_blocks(spark, monkeypatch):
    """Cells and queries are cut into blocks, and a block leaves each query no more rows than it can need."""
    monkeypatch.setattr(similarity, "BLOCK", 16)
    met, left = similarity._met, []
    monkeypatch.setattr(similarity, "_met", lambda count: left.append(count) or met(count))
    rng = random.Random(12)
    rows = [(f"k{i:03d}", *[rng.gauss(0, 1) for _ in range(6)]) for i in range(150)] + [(f"e{i}", *[0.5] * 6) for i in range(9)]
    columns = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame(rows, "code_commune string, " + ", ".join(f"{c} double" for c in columns))
    got = {}
    for r in similarity.similar_all(df, top=3, columns=columns).collect():
        got.setdefault(r.code_commune, []).append((r.place, r.neighbour))
    pool = {r.code_commune: r[1:] for r in similarity.standardise(df, columns).select("code_commune", *columns).collect()}
    for code, v in pool.items():
        near = sorted((sum((x - y) ** 2 for x, y in zip(v, w)), k) for k, w in pool.items())[:4]
        assert [n for _, n in sorted(got[code])] == [k for _, k in near if k != code][:3]
    assert left == [4, 4]
    import pyarrow as pa

    vectors = [[float(i), 0.0] for i in range(200)]
    asked = pa.table({"query": ["a", "b"], "v": [[0.0, 0.0], [50.2, 0.0]], "bound": [100.0, 0.5]})
    found = met(4)(asked, pa.table({"neighbour": [str(i) for i in range(200)], "w": vectors})).to_pydict()
    assert list(zip(found["query"], found["neighbour"])) == [("a", "0"), ("a", "1"), ("a", "2"), ("a", "3"), ("b", "50")]
