"""Sales counts per product and seller."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def activity(items: DataFrame, order_reviews: DataFrame | None = None) -> DataFrame:
    """One row per (product, seller) pair: sold items and, when given, review totals.

    Every product and seller aggregate is a sum over this table, which is far smaller than
    the items. It is combined before its shuffle and keyed by the pair, so neither a best-
    selling product nor a giant seller lands in one task as raw rows. Distinct products of a
    seller become a plain count of its pairs. ``order_reviews`` holds one score per order.
    """
    rows = items.select("order_id", "product_id", "seller_id")
    totals = [F.count(F.lit(1)).alias("item_rows")]
    if order_reviews is not None:
        scored = order_reviews.select("order_id", "review_score", F.lit(1).alias("reviewed"))
        rows = rows.join(scored, "order_id", "left")
        totals += [
            F.count("reviewed").alias("review_rows"),
            F.count("review_score").alias("score_rows"),
            F.sum("review_score").alias("score_sum"),
        ]
    return rows.groupBy("product_id", "seller_id").agg(*totals)


def product_demand(pairs: DataFrame) -> DataFrame:
    """Sold items per product."""
    return (
        pairs.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.sum("item_rows").alias("product_sales_count"))
    )


def seller_demand(pairs: DataFrame) -> DataFrame:
    """Sold items and distinct products per seller."""
    return (
        pairs.filter(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(
            F.sum("item_rows").alias("seller_sales_count"),
            F.count("product_id").alias("seller_product_diversity"),
        )
    )
