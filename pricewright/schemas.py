"""Table schemas, feature lists and fixed business values."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Columns the engine reads from each source table. Other columns in a file are ignored.
TABLES: dict[str, T.StructType] = {
    "items": _struct(
        order_id=_S, order_item_id=_I, product_id=_S, seller_id=_S, price=_D, freight_value=_D
    ),
    "products": _struct(
        product_id=_S,
        product_category_name=_S,
        product_name_lenght=_I,
        product_description_lenght=_I,
        product_photos_qty=_I,
        product_weight_g=_D,
        product_length_cm=_D,
        product_height_cm=_D,
        product_width_cm=_D,
    ),
    "orders": _struct(order_id=_S, customer_id=_S, order_purchase_timestamp=_TS),
    "payments": _struct(order_id=_S, payment_type=_S, payment_installments=_I),
    "reviews": _struct(review_id=_S, order_id=_S, review_score=_I, review_creation_date=_TS),
    "customers": _struct(customer_id=_S, customer_state=_S),
    "sellers": _struct(seller_id=_S, seller_state=_S),
    "translation": _struct(product_category_name=_S, product_category_name_english=_S),
}

# File names of the published e-commerce data set.
CSV_FILES = {
    "items": "olist_order_items_dataset.csv",
    "products": "olist_products_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "translation": "product_category_name_translation.csv",
}

# Tables every job needs, and the ones only some jobs read.
CORE_TABLES = ("items", "products", "orders", "translation")
CATEGORY_TABLES = ("items", "products", "reviews", "translation")
# May be absent from a file: used only as a tie-break or row identity.
OPTIONAL_COLUMNS = {"order_item_id", "review_id"}

# Feature lists of the current model, in model order.
NUMERIC_BASE = [
    "freight_value",
    "product_photos_qty",
    "product_weight_g",
    "product_volume_cm3",
    "product_description_lenght",
    "product_name_lenght",
    "density",
    "shipping_ratio",
    "complexity_score",
    "log_weight",
    "log_volume",
    "purchase_month",
    "is_peak_season",
    "product_avg_review",
    "seller_avg_review",
    "max_installments",
    "product_sales_count",
    "seller_sales_count",
    "seller_product_diversity",
]
ENCODED = ["category_avg_price", "seller_avg_price"]
NUMERIC = NUMERIC_BASE + ENCODED
CATEGORICAL = [
    "product_category_name_english",
    "size_category",
    "payment_type_mode",
    "customer_state",
    "seller_state",
]
FEATURES = NUMERIC + CATEGORICAL

# Feature list of the older model and of the algorithm comparison.
BASELINE_FEATURES = [
    "freight_value",
    "product_photos_qty",
    "product_weight_g",
    "product_volume_cm3",
    "purchase_month",
    "purchase_day_of_week",
    "purchase_hour",
    "density",
    "shipping_ratio",
    "is_weekend",
    "is_peak_season",
    "complexity_score",
    "log_weight",
    "log_volume",
    "product_sales_count",
    "seller_sales_count",
    "seller_product_diversity",
    "category_avg_price",
    "product_category_name_english",
    "size_category",
]
BASELINE_CATEGORICAL = ["product_category_name_english", "size_category"]
BASELINE_NUMERIC = [f for f in BASELINE_FEATURES if f not in BASELINE_CATEGORICAL]

# Published scores the current model is measured against.
BASELINE_R2 = 0.7831
BASELINE_MAE = 20.50

# Source files the current model reads beyond the older one.
NEW_TABLES = [
    "olist_order_payments_dataset.csv",
    "olist_order_reviews_dataset.csv",
    "olist_customers_dataset.csv",
    "olist_sellers_dataset.csv",
]

CATEGORY_STATS = _struct(
    category=_S,
    avg_price=_D,
    avg_review=_D,
    median_sales_count=T.LongType(),
    most_common_payment_type=_S,
    default_max_installments=_I,
)

# One model-comparison record.
METRICS = _struct(algorithm=_S, r2=_D, mae=_D, rmse=_D, mape=_D)

# Scoring request. (type, default or None when required, lower bound,
# bound is inclusive, upper bound).
REQUEST_FIELDS: dict[str, tuple] = {
    "freight_value": (_D, None, 0, True, None),
    "product_photos_qty": (_I, None, 0, True, None),
    "product_weight_g": (_D, None, 0, False, None),
    "product_length_cm": (_D, None, 0, False, None),
    "product_height_cm": (_D, None, 0, False, None),
    "product_width_cm": (_D, None, 0, False, None),
    "product_description_lenght": (_I, None, 0, True, None),
    "product_name_lenght": (_I, None, 0, True, None),
    "product_category_name_english": (_S, None, None, None, None),
    "purchase_month": (_I, None, 1, True, 12),
    "product_sales_count": (_I, 0, None, None, None),
    "seller_sales_count": (_I, 0, None, None, None),
    "seller_product_diversity": (_I, 0, None, None, None),
    "product_avg_review": (_D, 4.0, 1, True, 5),
    "seller_avg_review": (_D, 4.0, 1, True, 5),
    "max_installments": (_I, 1, 1, True, 24),
    "payment_type_mode": (_S, "credit_card", None, None, None),
    "customer_state": (_S, "SP", None, None, None),
    "seller_state": (_S, "SP", None, None, None),
    "category_avg_price": (_D, 100.0, None, None, None),
    "seller_avg_price": (_D, 100.0, None, None, None),
}
REQUEST = T.StructType([T.StructField(n, spec[0]) for n, spec in REQUEST_FIELDS.items()])
