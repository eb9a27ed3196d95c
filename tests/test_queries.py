"""A few registered queries against their SQL on the smallest tables."""

import pytest

from parcelle.workloads import load_all
from parcelle.workloads.registry import ORACLES, QUERIES, expand_rounding
from tests import oracle

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["gold_real_estate_yoy", "silver_transactions", "territory_scores", "listing_stats", "nearest_join",
          "rental_metrics", "lexicon_sentiment", "quality_checks", "knn_similar", "rank_pct_narrow", "knn_all", "bronze_table_counts",
          "bronze_union", "region_median_sketch", "extract_rents", "projection_table", "text_analysis"]

load_all()


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.FLAGSHIP in entry.queries()
    assert expand_rounding("rnd(f(a, b), 2)") == "CAST(round(CAST(f(a, b) AS DECIMAL(28, 9)), 2) AS DOUBLE)"


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name]) == ""
