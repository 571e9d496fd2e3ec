"""The star schema over the order-processing sample tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .star import StarSchema


#: Category of a part, its English name (some hold a quote), and one whose orders have no reviews.
CATEGORY = "concat(p_type, ' ', p_brand)"
ENGLISH = "lower(concat(p_type, if(p_type = 'PROMO', \"'s \", ' '), p_brand))"
UNREVIEWED = "SMALL Brand#3"


def sample_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_extendedprice AS price",
        "round(l_quantity * (1 + l_tax), 2) AS freight_value",
    )


def sample_star(spark: SparkSession, folder: str) -> StarSchema:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lineitem, nation = table("lineitem"), table("nation")
    products = table("part").selectExpr(
        "p_partkey AS product_id",
        f"CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE {CATEGORY} END AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "200 + p_partkey % 800 AS product_description_lenght",
        "1 + p_partkey % 6 AS product_photos_qty",
        "CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE p_size * 100.0D END AS product_weight_g",
        "p_size * 1.0D AS product_length_cm",
        "(1 + p_partkey % 40) * 1.0D AS product_height_cm",
        "(p_partkey % 60) * 1.0D AS product_width_cm",
    )
    translation = (
        table("part")
        .filter("p_type <> 'ECONOMY'")
        .selectExpr(
            f"{CATEGORY} AS product_category_name", f"{ENGLISH} AS product_category_name_english"
        )
        .distinct()
    )
    orders = table("orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), o_orderdate) AS order_purchase_timestamp",
    )
    payments = lineitem.filter("l_linestatus = 'O'").selectExpr(
        "l_orderkey AS order_id",
        "CASE l_returnflag WHEN 'A' THEN 'boleto' WHEN 'N' THEN 'credit_card' "
        "WHEN 'R' THEN 'voucher' END AS payment_type",
        "1 + CAST(l_quantity AS INT) % 12 AS payment_installments",
    )
    reviews = table("events").selectExpr(
        "event_id AS review_id",
        "event_id DIV 2 AS order_id",
        "1 + CAST(floor(value) AS INT) % 5 AS review_score",
        "ts AS review_creation_date",
    )
    silent = (
        lineitem.join(products, F.col("l_partkey") == F.col("product_id"))
        .filter(F.col("product_category_name") == UNREVIEWED)
        .select(F.col("l_orderkey").alias("order_id"))
    )
    reviews = reviews.join(silent, "order_id", "left_anti")
    customers = (
        table("customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr("c_custkey AS customer_id", "n_name AS customer_state")
    )
    sellers = (
        table("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr("s_suppkey AS seller_id", "n_name AS seller_state")
    )
    return StarSchema(
        items=sample_items(lineitem),
        products=products,
        translation=translation,
        orders=orders,
        payments=payments,
        reviews=reviews,
        customers=customers,
        sellers=sellers,
    )


def sample_requests(items: DataFrame, star: StarSchema) -> DataFrame:
    """Scoring requests derived from the items, some of them invalid on purpose."""
    from ..operators.encode import item_key
    from ..operators.facts import product_attributes

    given = F.col("product_id") % 3 != 0

    def optional(value: object) -> Column:
        return F.when(given, F.lit(value))

    return (
        items.join(product_attributes(star), "product_id", "left")
        .join(star.orders, "order_id", "left")
        .select(
            item_key().alias("request_id"),
            F.when(F.col("order_id") % 50 == 0, -F.col("freight_value"))
            .when(F.col("order_id") % 110 == 1, float("nan"))
            .otherwise(F.col("freight_value"))
            .alias("freight_value"),
            F.col("product_photos_qty").cast("int").alias("product_photos_qty"),
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
            F.col("product_description_lenght").cast("int").alias("product_description_lenght"),
            F.col("product_name_lenght").cast("int").alias("product_name_lenght"),
            "product_category_name_english",
            F.when(F.col("order_id") % 70 == 0, 13)
            .otherwise(F.month("order_purchase_timestamp"))
            .alias("purchase_month"),
            optional(3.5).alias("product_avg_review"),
            optional(3.5).alias("seller_avg_review"),
            optional(2).alias("max_installments"),
            optional("boleto").alias("payment_type_mode"),
            optional("RJ").alias("customer_state"),
            optional("RJ").alias("seller_state"),
        )
    )
