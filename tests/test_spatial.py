import random

from parcelle.operators import spatial


def _brute(points, centroids):
    best = {}
    for i, g, lat, lon in points:
        found = [((lat - a) ** 2 + (lon - b) ** 2, code) for code, h, a, b in centroids if h == g and a is not None]
        if found:
            best[i] = min(found)[1]
    return best


def _run(spark, points, centroids):
    p = spark.createDataFrame(points, "i int, dept string, lat double, lon double")
    c = spark.createDataFrame(centroids, "code_commune string, dept string, latitude double, longitude double")
    return {r.i: r.code_commune for r in spatial.nearest(p, c, ["i"], within="dept").collect()}


def test_nearest_equals_brute_force(spark):
    rng = random.Random(3)
    # a dense cluster, a sparse field, far points, equal coordinates, an unknown place
    centroids = [(f"d{i:03d}", "01", 45 + rng.random() / 500, 5 + rng.random() / 500) for i in range(150)]
    centroids += [(f"s{i:03d}", "01", rng.uniform(41, 51), rng.uniform(-5, 9)) for i in range(60)]
    centroids += [("b", "02", 48.0, 2.0), ("a", "02", 48.0, 2.0), ("n", "02", None, None)]
    points = [(i, "01", rng.uniform(40, 52), rng.uniform(-6, 10)) for i in range(250)]
    points += [(300 + i, "01", 45 + rng.random() / 400, 5 + rng.random() / 400) for i in range(250)]
    points += [(900, "02", -60.0, 170.0), (901, "02", 48.0, 2.0), (902, "03", 45.0, 5.0), (903, "01", -89.0, -179.0)]
    assert _run(spark, points, centroids) == _brute(points, centroids)


def test_hot_cell_is_salted(spark, monkeypatch):
    monkeypatch.setattr(spatial, "HOT_CELL", 10)
    rng = random.Random(4)
    centroids = [(f"c{i}", "01", rng.uniform(44, 46), rng.uniform(4, 6)) for i in range(40)]
    points = [(i, "01", 45.0 + rng.random() / 1e4, 5.0) for i in range(200)] + [(500, "01", 44.2, 4.1)]
    assert _run(spark, points, centroids) == _brute(points, centroids)


def test_grid_counts_fan_out(spark):
    points = spark.createDataFrame([(45.001, 5.001), (45.002, 5.004), (None, 5.0), (48.0, 2.0)], "lat double, lon double")
    communes = spark.createDataFrame([("a", 45.0, 5.0), ("b", 45.004, 5.0), ("c", 10.0, 10.0)], "code_commune string, latitude double, longitude double")
    got = {r[0]: r[1] for r in spatial.grid_counts(points, communes, "lat", "lon", "n").collect()}
    assert got == {"a": 2, "b": 2}


def test_far_points_meet_few_centroids(spark):
    rng = random.Random(5)
    centroids = [(f"c{i}", "01", rng.uniform(42, 51), rng.uniform(-5, 8)) for i in range(1000)]
    points = [(i, "01", rng.uniform(-80, -60), rng.uniform(100, 170)) for i in range(200)]
    assert _run(spark, points, centroids) == _brute(points, centroids)
    places = spark.createDataFrame([p[1:] for p in points], "_g string, _lat double, _lon double")
    cents = spark.createDataFrame([c[1:] for c in centroids], "_g string, _clat double, _clon double")
    cells, level = spatial.nearest_cells(places, cents)
    assert cells.join(
        cents.withColumns({"cx": spatial._cell(cents._clon, level), "cy": spatial._cell(cents._clat, level)}), ["_g", "cx", "cy"]
    ).count() < 6 * len(points)


def test_long_lists_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spatial, "LONG_LIST", 3, raising=False)
    monkeypatch.setattr(spatial, "HOT_CELL", 20)
    rng = random.Random(6)
    # a ring around one place, whose centroids are all as near
    centroids = [(f"r{i}", "01", 45.0 + a, 5.0 + b) for i, (a, b) in enumerate([(1, 0), (-1, 0), (0, 1), (0, -1)] * 2)]
    centroids += [(f"c{i}", "01", rng.uniform(44, 46), rng.uniform(4, 6)) for i in range(40)]
    points = [(i, "01", 45.0, 5.0) for i in range(30)] + [(100 + i, "01", rng.uniform(43, 47), rng.uniform(3, 7)) for i in range(100)]
    points += [(300 + i, "01", 45 + rng.random() / 1e4, 5.0) for i in range(30)]
    assert _run(spark, points, centroids) == _brute(points, centroids)


def test_points_are_not_grouped(spark):
    points = spark.createDataFrame([(1, "a", 45.0, 5.0), (1, "b", 48.0, 2.0), (1, "b", 48.0, 2.0)], "i int, kind string, lat double, lon double")
    communes = spark.createDataFrame([("x", 45.0, 5.1), ("y", 48.0, 2.1)], "code_commune string, latitude double, longitude double")
    found = spatial.nearest(points, communes, ["i", "kind"])
    # each row keeps its own answer, without an aggregation over the points
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a", "x"), (1, "b", "y"), (1, "b", "y")]
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_poi_counts_numbers_no_points(spark):
    from parcelle.workloads.spatial import poi_counts

    plan = poi_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [l_orderkey" not in plan and "Aggregate [code_commune" in plan
