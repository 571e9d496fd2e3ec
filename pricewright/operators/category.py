"""Per-category statistics, their reports and their SQL seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import round_half_even, whole_half_even
from ..sources.star import StarSchema
from ..stage import Stage
from .facts import product_attributes
from .keys import KeyChecks
from .reviews import order_mean_review

# Every category carries the same payment type; default installments by the
# rounded average price, (below, installments), above the last edge the rest.
PAYMENT_TYPE = "credit_card"
INSTALLMENT_TIERS = [(50, 1), (100, 3), (200, 6)]
INSTALLMENT_REST = 12

REPORT = ["category", "avg_price", "avg_review", "median_sales_count", "default_max_installments"]
# Columns and insert text of the SQL seed.
SEED_COLUMNS = [
    "category",
    "avg_price",
    "avg_review",
    "median_sales_count",
    "most_common_payment_type",
    "default_max_installments",
]


def product_categories(star: StarSchema, keys: KeyChecks | None = None) -> DataFrame:
    """English category of every product that has one."""
    return (
        product_attributes(star, keys)
        .select("product_id", F.col("product_category_name_english").alias("category"))
        .filter(F.col("category").isNotNull())
    )


def category_order_totals(star: StarSchema, categories: DataFrame | None = None) -> DataFrame:
    """Sold items and price totals per category and order.

    ``categories`` is the result of :func:`product_categories`, where it is written already.

    Collapsing to this grain first means the later join on the order id sees at most one
    row per category for any order, however many items that order has.
    """
    return (
        star.items.join(product_categories(star) if categories is None else categories, "product_id")
        .groupBy("category", "order_id")
        .agg(
            F.count(F.lit(1)).alias("item_rows"),
            F.count("price").alias("priced_rows"),
            F.sum("price").alias("price_sum"),
        )
    )


def category_prices_and_reviews(
    star: StarSchema, categories: DataFrame | None = None
) -> DataFrame:
    """Average price, and average review weighted by sold items, of each category."""
    rows, score = F.col("item_rows"), F.col("review_score")
    review_sum = F.sum(rows * score)
    review_rows = F.sum(F.when(score.isNotNull(), rows))
    return (
        category_order_totals(star, categories)
        .join(order_mean_review(star.reviews), "order_id", "left")
        .groupBy("category")
        .agg(
            round_half_even(F.try_divide(F.sum("price_sum"), F.sum("priced_rows"))).alias(
                "avg_price"
            ),
            round_half_even(F.try_divide(review_sum, review_rows)).alias("avg_review"),
        )
    )


def category_median_sales(star: StarSchema, categories: DataFrame | None = None) -> DataFrame:
    """Median of the sales counts of a category's products, rounded half to even.

    Counts of products with equal sales are combined first. A category with k different
    sales counts has sold at least k*(k+1)/2 items, so the state of one median is bounded
    by the square root of twice the item count.
    """
    return (
        star.items.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count("order_id").alias("sales_count"))
        .join(product_categories(star) if categories is None else categories, "product_id")
        .groupBy("category", "sales_count")
        .agg(F.count(F.lit(1)).alias("products"))
        .groupBy("category")
        .agg(
            whole_half_even(F.percentile("sales_count", 0.5, F.col("products"))).alias(
                "median_sales_count"
            )
        )
    )


def installment_tier(avg_price: Column) -> Column:
    tier = F
    for below, installments in INSTALLMENT_TIERS:
        tier = tier.when(avg_price < below, installments)
    return tier.otherwise(INSTALLMENT_REST)


def fill_avg_review(stats: DataFrame) -> DataFrame:
    """Fill a missing average review with the rounded plain mean of the category averages."""
    overall = stats.agg(round_half_even(F.avg("avg_review")).alias("overall")).scalar()
    return stats.withColumn("avg_review", F.coalesce("avg_review", overall))


def category_stats(star: StarSchema, stage: Stage) -> DataFrame:
    """The category table, sorted by category."""
    stage, keys = stage.sub("category_stats"), KeyChecks()
    categories = stage.table(product_categories(star, keys), "product_categories")
    keys.verify()
    aligned = category_prices_and_reviews(star, categories).join(
        category_median_sales(star, categories), "category", "full"
    )
    # Written before the fill, which reads the finished averages a second time.
    return (
        fill_avg_review(stage.table(aligned, "category_aggregates"))
        .withColumns(
            {
                "most_common_payment_type": F.lit(PAYMENT_TYPE),
                "default_max_installments": installment_tier(F.col("avg_price")),
            }
        )
        .select(*SEED_COLUMNS)
        .orderBy("category")
    )


def top_categories(stats: DataFrame, n: int = 10) -> DataFrame:
    return stats.select(*REPORT).orderBy(F.desc("avg_price"), "category").limit(n)


def bottom_categories(stats: DataFrame, n: int = 5) -> DataFrame:
    return stats.select(*REPORT).orderBy("avg_price", "category").limit(n)


def category_ranges(stats: DataFrame) -> DataFrame:
    """Number of categories and the range of each statistic, as one row."""
    ranges = [
        agg(name).alias(f"{prefix}_{name}")
        for name in ("avg_price", "avg_review", "median_sales_count")
        for prefix, agg in (("min", F.min), ("max", F.max))
    ]
    return stats.agg(F.count(F.lit(1)).alias("categories"), *ranges)


def _number(value: Column) -> Column:
    """Shortest text of a two-place number: 4.0, 115.8, 12345678.9."""
    text = F.regexp_replace(value.cast("decimal(20,2)").cast("string"), "(\\.\\d)0$", "$1")
    return F.coalesce(text, F.lit("NULL"))


def seed_rows(stats: DataFrame) -> DataFrame:
    """One SQL value tuple per category, ``category, row_sql``."""
    quoted = F.regexp_replace("category", "'", "''")
    return stats.select(
        "category",
        F.format_string(
            "('%s', %s, %s, %s, '%s', %s)",
            quoted,
            _number(F.col("avg_price")),
            _number(F.col("avg_review")),
            F.col("median_sales_count").cast("string"),
            F.col("most_common_payment_type"),
            F.col("default_max_installments").cast("string"),
        ).alias("row_sql"),
    )


def seed_lines(stats: DataFrame) -> DataFrame:
    """The lines of one idempotent insert statement, in order, ``value``."""
    rows = seed_rows(stats)
    last = rows.agg(F.max("category")).scalar()
    comma = F.when(F.col("category") == last, "").otherwise(",")
    head = f"INSERT INTO category_stats ({', '.join(SEED_COLUMNS)})\nVALUES"
    frame = stats.sparkSession.createDataFrame(
        [(0, "", head), (2, "", "ON CONFLICT (category) DO NOTHING;")],
        "part int, category string, value string",
    )
    body = rows.select(
        F.lit(1).alias("part"),
        "category",
        F.concat(F.lit("  "), F.col("row_sql"), comma).alias("value"),
    )
    return frame.unionByName(body).orderBy("part", "category").select("value")


def missing_categories(stats: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose category the existing table does not hold yet."""
    return stats.dropDuplicates(["category"]).join(existing, "category", "left_anti")


def insert_if_absent(stats: DataFrame, existing: DataFrame) -> DataFrame:
    """The existing table plus the rows it lacks; existing rows stay as they are."""
    return existing.unionByName(missing_categories(stats, existing).select(existing.columns))
