"""Sketches within their stated errors, and merged as if of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pricewright.functions import sketches
from pricewright.functions.quantiles import exact_quantiles
from pricewright.operators import clean


@pytest.fixture(scope="module")
def items(spark):
    return spark.range(60_000).selectExpr(
        "concat('s', id % 3) AS seller_id",
        "concat('p', (id * 7919) % IF(id % 3 = 0, 9000, IF(id % 3 = 1, 400, 7))) AS product_id",
        "exp((id % 1009) / 100D) AS price", "id % 5 AS load",
    )


def test_distinct_counts_within_three_errors(items):
    loads = [sketches.seller_products(items.filter(F.col("load") == i)) for i in range(5)]
    merged = sketches.seller_diversity(sketches.merge_seller_products(*loads)).collect()
    whole = sketches.seller_diversity(sketches.seller_products(items)).collect()
    exact = {
        r.seller_id: r.n
        for r in items.groupBy("seller_id").agg(F.count_distinct("product_id").alias("n")).collect()
    }
    for rows in (merged, whole):
        assert len(rows) == 3
        for r in rows:
            allowed = max(1, 3 * sketches.DISTINCT_ERROR * exact[r.seller_id])
            assert abs(r.seller_product_diversity - exact[r.seller_id]) <= allowed
    # Few values are counted exactly.
    assert {r.seller_id: r.seller_product_diversity for r in whole}["s2"] == exact["s2"]


def test_nulls_have_no_sketch(spark):
    rows = spark.createDataFrame([(None, "p"), ("s", None), ("s", "p")], "seller_id string, product_id string")
    (row,) = sketches.seller_diversity(sketches.seller_products(rows)).collect()
    assert tuple(row) == ("s", 1)


def test_quantiles_within_the_rank_error(items):
    loads = [
        sketches.value_sketches(items.filter(F.col("load") == i), ["price"]) for i in range(5)
    ]
    targets = {f"q{p}": ("price", p / 100) for p in (1, 10, 50, 90, 99)}
    merged = sketches.quantiles_of(sketches.merge_value_sketches(*loads), targets).first()
    single = sketches.sketched_quantiles(items, targets).first()
    prices = sorted(r.price for r in items.select("price").collect())
    for row in (merged, single):
        for name, (_, p) in targets.items():
            below = sum(v < row[name] for v in prices) / len(prices)
            upto = sum(v <= row[name] for v in prices) / len(prices)
            assert below - sketches.RANK_ERROR <= p <= upto + sketches.RANK_ERROR


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),)], "price double")
    assert sketches.sketched_quantiles(rows, clean.OUTLIER_BOUNDS).first().low is None
    assert sketches.sketched_quantiles(rows.limit(0), clean.OUTLIER_BOUNDS).first().high is None


def test_opt_in_for_medians_and_bounds(items):
    facts = items.selectExpr(
        "price", "price AS product_avg_review", "price AS seller_avg_review",
        "CAST(load AS INT) AS max_installments",
    )
    plan = clean.outlier_bounds(facts, sketches.sketched_quantiles)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan") <= 1
    guess = clean.imputation_medians(facts, sketches.sketched_quantiles).first()
    exact = clean.imputation_medians(facts, exact_quantiles).first()
    assert guess.max_installments == exact.max_installments == 2
    assert guess.product_avg_review == pytest.approx(exact.product_avg_review, rel=0.1)
