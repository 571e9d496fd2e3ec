"""The fact table: one row per sold item with everything known about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.star import StarSchema
from ..stage import Stage
from .demand import activity, product_demand, seller_demand
from .keys import KeyChecks
from .payments import order_payment_profile
from .reviews import latest_review_per_order, product_avg_review, seller_avg_review


def order_dimension(star: StarSchema, keys: KeyChecks) -> DataFrame:
    """One row per order: purchase time, customer state, payment profile, newest review.

    Orders meet their customer first; after that every join is on the order id, so the
    orders are shuffled twice in all.
    """
    orders = star.orders.select("order_id", "customer_id", "order_purchase_timestamp")
    customers = star.customers.select("customer_id", "customer_state")
    customers = keys.one_row_per_key(customers, "customers", "customer_id")
    reviews = latest_review_per_order(star.reviews).withColumn("reviewed", F.lit(1))
    orders = keys.one_row_per_key(orders.join(customers, "customer_id", "left"), "orders", "order_id")
    return (
        # Outer, because a payment or a review may belong to an order that is not listed.
        orders.join(order_payment_profile(star.payments), "order_id", "full")
        .join(reviews, "order_id", "full")
        .filter(F.col("order_id").isNotNull())
    )


def product_attributes(star: StarSchema, keys: KeyChecks | None = None) -> DataFrame:
    """Products with the English name of their category. With ``keys``, both keys are checked."""
    products, translation = star.products, star.translation
    if keys:
        products = keys.one_row_per_key(products, "products", "product_id")
        translation = keys.one_row_per_key(translation, "translation", "product_category_name")
    return products.join(translation, "product_category_name", "left")


def product_dimension(
    star: StarSchema, pairs: DataFrame, keys: KeyChecks, reviews: bool = True
) -> DataFrame:
    """One row per sold product: attributes, sales count and review average."""
    dimension = product_demand(pairs).join(product_attributes(star, keys), "product_id", "left")
    if reviews:
        dimension = dimension.join(product_avg_review(pairs), "product_id", "left")
    return dimension


def seller_dimension(
    star: StarSchema, pairs: DataFrame, keys: KeyChecks, reviews: bool = True
) -> DataFrame:
    """One row per selling seller: state, sales count, diversity and review average."""
    dimension = seller_demand(pairs)
    if reviews:
        sellers = star.sellers.select("seller_id", "seller_state")
        dimension = dimension.join(seller_avg_review(pairs), "seller_id", "left").join(
            keys.one_row_per_key(sellers, "sellers", "seller_id"), "seller_id", "left"
        )
    return dimension


def build_facts(star: StarSchema, stage: Stage) -> DataFrame:
    """Items with order, product and seller attributes: all eight tables.

    The dimensions are written first (see :mod:`pricewright.stage`), then the items pass
    through three joins, one per key, instead of one join per source table. A dimension whose key is
    null or not unique raises, before any item meets it.

    Tables laid out by order need no order dimension: orders, payments, reviews and items are joined
    and grouped by the order id where they lie, without an exchange.
    """
    stage, keys = stage.sub("facts"), KeyChecks()
    if star.by_order:
        # Orders were checked, and met their customers, when the layout was written.
        scores = latest_review_per_order(star.reviews)
        items = star.items.join(star.orders, "order_id", "left").join(
            order_payment_profile(star.payments), "order_id", "left"
        )
    else:
        orders = stage.table(order_dimension(star, keys), "order_dimension")
        keys.verify()
        scores = orders.filter("reviewed = 1").select("order_id", "review_score")
        items = star.items.join(orders.drop("reviewed", "review_score"), "order_id", "left")
    pairs = stage.table(activity(star.items, scores), "activity")
    products = stage.table(product_dimension(star, pairs, keys), "product_dimension")
    sellers = stage.table(seller_dimension(star, pairs, keys), "seller_dimension")
    keys.verify()
    return items.join(products, "product_id", "left").join(sellers, "seller_id", "left")


def build_core_facts(star: StarSchema, stage: Stage) -> DataFrame:
    """Items with product, demand and purchase time only: the four core tables."""
    stage, keys = stage.sub("core_facts"), KeyChecks()
    orders = star.orders.select("order_id", "order_purchase_timestamp")
    if not star.by_order:
        orders = stage.table(keys.one_row_per_key(orders, "orders", "order_id"), "order_times")
    pairs = stage.table(activity(star.items), "activity")
    products = stage.table(product_dimension(star, pairs, keys, reviews=False), "product_dimension")
    sellers = stage.table(seller_dimension(star, pairs, keys, reviews=False), "seller_dimension")
    keys.verify()
    return (
        star.items.join(orders, "order_id", "left")
        .join(products, "product_id", "left")
        .join(sellers, "seller_id", "left")
    )
