"""Registered queries against their SQL on the smallest sample.

``python check.py`` runs all of them; here the ones that between them cover every operator.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check

FOLDER = "/root/testdata/sf0.001"
COMPARED = [
    "scan_counts", "category_stats", "category_seed_file", "category_insert_if_absent",
    "installment_tier", "order_payment_profile", "latest_review_per_order", "product_avg_review",
    "seller_avg_review", "product_demand", "seller_demand", "order_item_facts",
    "physical_features", "size_category", "date_features", "median_impute", "baseline_clean_rows",
    "baseline_features", "feature_row", "split_counts", "target_roundtrip", "regression_metrics",
    "one_hot_levels", "score_validate", "score_features", "scan_counts_csv", "category_median_sales_csv",
    "top_categories", "bottom_categories", "category_seed_rows", "fit_linear", "fit_tree",
    "model_roundtrip", "score_batch", "score_stream", "score_batch_tree", "csv_multiline_records",
    "reviews_csv", "scan_counts_layout", "job_counts", "order_item_facts_layout",
    "seller_diversity_sketch", "quantile_sketch", "score_stream_sinks",
]


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", COMPARED)
def test_query(spark, con, name):
    assert check.compare(spark, con, name, FOLDER).startswith("match")


def test_registry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 91
