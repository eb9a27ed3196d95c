import math
import random
import statistics

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelle.functions import order_stats as o
from parcelle.functions.scores import row_mean, weighted_score


def test_rank_pct_example(spark):
    data = [3.0, 1.0, 1.0, None, 2.0, 5.0]
    df = spark.createDataFrame(list(enumerate(data)), "k int, x double")
    got = {r.k: r.s for r in o.percent_ranks(df, "k", {"s": F.col("x")}).collect()}
    assert got == {0: 0.8, 1: 0.3, 2: 0.3, 4: 0.6, 5: 1.0}
    scored = {r.k: r.s for r in o.rank_scores(df, "k", {"s": F.col("x")}).collect()}
    assert scored[3] == 50.0 and scored[5] == 100.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.sampled_from([0.0, -1.5, 7.0]), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_rank_pct_equals_pandas(spark, data):
    df = spark.createDataFrame(list(enumerate(data)), "k int, x double")
    got = {r.k: r.s for r in o.percent_ranks(df, "k", {"s": F.col("x")}).collect()}
    want = pd.Series(data, dtype="float64").rank(pct=True)
    for k, share in want.items():
        assert (k not in got or got[k] is None) if math.isnan(share) else abs(got[k] - share) < 1e-12


def test_heavy_value_is_salted_and_exact(spark):
    data = [0.0] * 4000 + [float(i % 997) for i in range(8000)]
    df = spark.createDataFrame(list(enumerate(data)), "k int, x double")
    got = o.percent_ranks(df, "k", {"s": F.col("x")}).toPandas().set_index("k").sort_index().s
    assert (got - pd.Series(data).rank(pct=True)).abs().max() < 1e-12


def _median_frame(spark):
    rng = random.Random(7)
    rows = [(k, rng.choice([rng.uniform(-5, 30_000), 100.0, 2.5])) for k in ["a", "b", None] for _ in range(rng.randint(20, 300))]
    rows += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("null", None)]
    return rows, spark.createDataFrame(rows, "k string, x double")


def test_grouped_median_hot_and_ordinary_agree(spark):
    rows, df = _median_frame(spark)
    groups = {}
    for k, x in rows:
        groups.setdefault(k, []).append(x)
    want = {k: statistics.median([x for x in v if x is not None]) if any(x is not None for x in v) else None for k, v in groups.items()}
    for hot_rows in (10**6, 50, 0):
        got = o.grouped_stats(df, ["k"], [F.count(F.lit(1)).alias("n")], {"m": "x"}, hot_rows=hot_rows).collect()
        assert {r.k: r.n for r in got} == {k: len(v) for k, v in groups.items()}
        for r in got:
            assert r.m == want[r.k] or abs(r.m - want[r.k]) < 1e-9
    assert o.grouped_stats(df, ["k"], [], {"m": "x"}, accuracy=100).count() == len(groups)


def test_fill_with_median(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 4.0, None), (4, 9.0, None)], "k int, x double, y double")
    got = {r.k: (r.x, r.y) for r in o.fill_with_median(df, ["x", "y"]).collect()}
    assert got[2] == (4.0, None)


def test_row_mean_and_weights(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(row_mean([F.col("a"), F.col("b")])).collect()] == [1.0, None, 3.0]
    got = [r[0] for r in df.select(weighted_score({"a": 0.3, "b": 0.1, "absent": 0.6}, df.columns)).collect()]
    assert got == [round((0.3 * 1 + 0.1 * 50) / 0.4, 2), 50.0, 2.5]


def test_parts_are_bounded_for_any_range(spark):
    """Narrow, wide, clustered and mixed ranges: no part above the bound, ranks as pandas has them."""
    rng = random.Random(9)
    ranges = {
        "narrow": [1e9 + k / 1000 for k in range(900)],
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(700)] + [0.0, math.inf, -math.inf],
        "clustered": [2.0**-k + j * 2.0 ** (-k - 45) for k in range(0, 60, 6) for j in range(60)],
        "one": [7.0] * 400,
    }
    rows = [(g, x) for g, values in ranges.items() for x in values for _ in range(rng.choice([1, 1, 3]))]
    df = spark.createDataFrame(rows, "g string, x double")
    counts = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    parts = o._cut(counts, ["g"], "x", 20)
    assert parts.groupBy("g", "_path").count().where("count > 20").count() == 0
    bounds = parts.groupBy("g", "_path").agg(F.min("x").alias("a"), F.max("x").alias("z")).orderBy("g", "_path").collect()
    assert all(p.z < q.a for p, q in zip(bounds, bounds[1:]) if p.g == q.g)
    got = o.ordered_values(df, ["g"], "x", largest=20).collect()
    for g in ranges:
        all_values = sorted(x for h, x in rows if h == g)
        mine = [r for r in got if r.g == g]
        assert len(mine) == len(set(all_values)) and {r.total for r in mine} == {len(all_values)}
        assert all(all_values.index(r.x) == r.before and all_values.count(r.x) == r.n for r in mine)


def test_keys_are_counted_only_in_crowded_hashes(spark, monkeypatch):
    from parcelle.functions import order_stats

    kept, write = [], order_stats.stored
    monkeypatch.setattr(order_stats, "stored", lambda df, name: kept.append(name) or write(df, name))
    rows = [(f"k{i % 40}" if i % 3 else None, float(i % 17)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v double")

    def medians(**options):
        found = order_stats.grouped_stats(df, ["k"], [F.count(F.lit(1)).alias("n")], {"m": "v"}, **options)
        return sorted((r.k or "", r.n, r.m) for r in found.collect())

    want = medians()
    assert kept == ["crowded-hashes"]
    # all groups in two hashes, one of them large, and then none
    monkeypatch.setattr(order_stats, "HASHES", 2)
    assert medians(hot_rows=100) == want and "large-groups" in kept
    kept.clear()
    assert medians(hot_rows=150) == want and kept == ["crowded-hashes", "large-groups"]
