from __future__ import annotations

import datetime as dt

import pytest

from pricewright.operators import demand, payments, reviews


def by_key(df):
    return {row[0]: tuple(row[1:]) for row in df.collect()}


def test_payment_profile(spark):
    df = spark.createDataFrame(
        [
            ("a", "voucher", 1), ("a", "boleto", 3),  # tie: alphabetical
            ("b", "voucher", 1), ("b", "voucher", 2), ("b", "boleto", 9),
            ("c", None, 4), ("c", "boleto", None),
            ("d", None, None), (None, "boleto", 5),
        ],
        "order_id string, payment_type string, payment_installments int",
    )
    assert by_key(payments.order_payment_profile(df)) == {
        "a": (3, "boleto"), "b": (9, "voucher"), "c": (4, "boleto"), "d": (None, None),
    }


def review_frame(spark):
    day = dt.datetime(2018, 1, 1)
    return spark.createDataFrame(
        [
            ("r1", "a", 1, day), ("r2", "a", 5, day + dt.timedelta(days=1)),
            ("r3", "b", 2, day), ("r4", "b", 4, day),  # same date: larger id
            ("r5", "c", 3, None), ("r6", "c", 5, day),  # no date counts as newest
            ("r7", "d", None, day), ("r8", None, 1, day),
        ],
        "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz",
    )


def test_latest_review(spark):
    df = review_frame(spark)
    expected = {"a": (5,), "b": (4,), "c": (3,), "d": (None,)}
    assert by_key(reviews.latest_review_per_order(df)) == expected
    without_id = reviews.latest_review_per_order(df.drop("review_id"))
    assert by_key(without_id) == expected


def test_mean_review(spark):
    assert by_key(reviews.order_mean_review(review_frame(spark))) == {
        "a": (3.0,), "b": (3.0,), "c": (4.0,), "d": (None,),
    }


def test_activity_and_its_sums(spark):
    items = spark.createDataFrame(
        [
            ("a", "p", "s"), ("a", "p", "s"), ("a", "q", "s"), ("b", "p", "t"),
            ("x", "q", "s"), ("d", "z", "t"), ("a", None, "s"), ("a", "p", None),
        ],
        "order_id string, product_id string, seller_id string",
    )
    pairs = demand.activity(items, reviews.latest_review_per_order(review_frame(spark)))
    assert by_key(demand.product_demand(pairs)) == {"p": (4,), "q": (2,), "z": (1,)}
    assert by_key(demand.seller_demand(pairs)) == {"s": (5, 2), "t": (2, 2)}
    # Order a has score 5, b has 4, x has no review, d has one without a score.
    averages = by_key(reviews.product_avg_review(pairs))
    assert averages["p"] == (pytest.approx(19 / 4),)
    assert averages["q"] == (5.0,) and averages["z"] == (None,)
    assert by_key(reviews.seller_avg_review(pairs)) == {"s": (5.0,), "t": (4.0,)}


def test_hot_keys_keep_whole_results(spark):
    """One product, seller and order hold a third of all rows."""
    n = 30_000
    items = spark.range(n).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('o', id % 5000)) AS order_id",
        "IF(id % 3 = 0, 'hot', concat('p', id % 700)) AS product_id",
        "IF(id % 3 = 0, 'hot', concat('s', id % 50)) AS seller_id",
    )
    scores = spark.range(5000).selectExpr(
        "IF(id = 0, 'hot', concat('o', id)) AS order_id",
        "IF(id = 0, 'hot', concat('o', id)) AS k",
        "CAST(1 + id % 5 AS INT) AS review_score",
    ).drop("k")
    pairs = demand.activity(items, scores)
    frame = items.toPandas()
    sales = frame.groupby("product_id").size()
    assert by_key(demand.product_demand(pairs)) == {k: (v,) for k, v in sales.items()}
    joined = frame.merge(scores.toPandas(), on="order_id")
    expected = joined.groupby("seller_id")["review_score"].mean()
    got = by_key(reviews.seller_avg_review(pairs))
    assert {k: round(v[0], 9) for k, v in got.items()} == {
        k: round(v, 9) for k, v in expected.items()
    }
