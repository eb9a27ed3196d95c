"""A choice of scores against the whole territory table."""

import pytest

from parcelle.params import SCORE_COLUMNS
from parcelle.workloads import standins as S
from parcelle.workloads.registry import rounded

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole(spark):
    return {r.code_commune: r for r in S.territory(spark, FOLDER).select("code_commune", *SCORE_COLUMNS).collect()}


@pytest.mark.parametrize("scores", [["transport_score"], ["network_score", "income_score"], ["affordability_score", "health_score"]])
def test_chosen_scores_equal_the_whole_table(spark, whole, scores):
    got = S.territory(spark, FOLDER, scores=scores)
    assert got.columns == ["code_commune", *scores]
    assert {r.code_commune: r[1:] for r in got.collect()} == {k: tuple(r[c] for c in scores) for k, r in whole.items()}


@pytest.mark.parametrize("columns", [
    ["code_departement", "population", "avg_price_m2"], ["region", "annual_price_growth", "score_famille"],
    ["median_price_m2", "loyer_m2_app12", "taux_tfb_dept", "park_count", "income_score"],
])
def test_chosen_columns_equal_the_whole_table(spark, columns):
    got = rounded(S.territory(spark, FOLDER, columns=columns), 6)
    assert got.columns == ["code_commune", *columns]
    # means depend on the order of rows in their last digit
    rows = rounded(S.territory(spark, FOLDER).select("code_commune", *columns), 6).collect()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))


def test_columns_without_scores_rank_nothing(spark):
    plan = S.territory(spark, FOLDER, columns=["population", "avg_price_m2"])._jdf.queryExecution().optimizedPlan().toString()
    assert "median" not in plan and "c_acctbal" not in plan and "o_custkey" not in plan and "metric" not in plan
