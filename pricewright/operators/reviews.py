"""Review scores per order, product and seller."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_review_per_order(reviews: DataFrame) -> DataFrame:
    """The newest review of each order.

    A review without a date counts as newest. Equal dates are decided by the larger
    ``review_id``, or by the larger score where the table has none. An aggregate instead
    of a ranking window: all but one review per order and map task stay out of the shuffle.
    """
    tie = "review_id" if "review_id" in reviews.columns else "review_score"
    date = F.col("review_creation_date")
    newest = F.struct(date.isNull().alias("undated"), date.alias("date"), F.col(tie).alias("tie"))
    return (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.max_by("review_score", newest).alias("review_score"))
    )


def order_mean_review(reviews: DataFrame) -> DataFrame:
    """Mean score of all reviews of each order."""
    return (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.avg("review_score").alias("review_score"))
    )


def _avg_review(activity: DataFrame, key: str, name: str) -> DataFrame:
    return (
        activity.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum("review_rows").alias("review_rows"),
            F.try_divide(F.sum("score_sum"), F.sum("score_rows")).alias(name),
        )
        .filter("review_rows > 0")
        .drop("review_rows")
    )


def product_avg_review(activity: DataFrame) -> DataFrame:
    """Mean score per product, one vote per sold item of a reviewed order.

    ``activity`` is the result of :func:`pricewright.operators.demand.activity`.
    """
    return _avg_review(activity, "product_id", "product_avg_review")


def seller_avg_review(activity: DataFrame) -> DataFrame:
    """Mean score per seller, one vote per sold item of a reviewed order."""
    return _avg_review(activity, "seller_id", "seller_avg_review")
