"""Registered queries against their SQL on the smallest test tables (all of them: check_queries.py)."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, duck

SF = "/root/testdata/sf0.001"
SAMPLE = ["transaction_documents", "daily_series", "daily_series_item", "quantile_cascade", "basket_food_semi", "basket_matrix",
          "rule_edges", "corr_ordinal", "seasonal_residuals", "price_ladder", "combo_3", "nps_rollups", "phrase_counts",
          "brand_sheet", "stored_matrix", "finite_prices", "constant_regressor", "ridge_own_price", "complete_regressors"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(SAMPLE) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, duck(SF), SF, name, entry.queries()[name], entry.oracle_sql()[name]).startswith("ok")
