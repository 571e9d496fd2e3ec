"""Derived features. Training and scoring call the same functions, so they cannot drift apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Right-closed volume classes, (upper edge, label); above the last edge the rest.
SIZE_CLASSES = [(1000, "small"), (10000, "medium"), (100000, "large")]
SIZE_REST = "very_large"
# Seasonal months, weekend days (Monday = 0) and complexity weights.
PEAK_MONTHS = (11, 12)
WEEKEND_DAYS = (5, 6)
COMPLEXITY = [
    ("product_photos_qty", 0.5),
    ("product_description_lenght", 0.01),
    ("product_name_lenght", 0.02),
]


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def volume() -> Column:
    return _double("product_length_cm") * _double("product_height_cm") * _double("product_width_cm")


def density(vol: Column) -> Column:
    """Null at a volume of -1, so such a row is dropped as incomplete."""
    return F.try_divide(_double("product_weight_g"), vol + 1)


def shipping_ratio() -> Column:
    """Null at a weight of -1, so such a row is dropped as incomplete."""
    return F.try_divide(_double("freight_value"), _double("product_weight_g") + 1)


def complexity_score() -> Column:
    return reduce(lambda a, b: a + b, [_double(name) * weight for name, weight in COMPLEXITY])


def size_category(vol: Column) -> Column:
    """Right-closed classes; a volume of zero, below zero or null has none."""
    classes = F.when(vol <= 0, F.lit(None).cast("string"))
    for upper, label in SIZE_CLASSES:
        classes = classes.when(vol <= upper, label)
    return classes.when(vol.isNotNull(), SIZE_REST)


def flag(value: Column, members: tuple[int, ...]) -> Column:
    """0/1 membership; null is not a member."""
    return F.coalesce(value.isin(*members), F.lit(False)).cast("int")


def is_peak_season(month: Column) -> Column:
    return flag(month, PEAK_MONTHS)


def is_weekend(weekday: Column) -> Column:
    return flag(weekday, WEEKEND_DAYS)


def with_physical_features(df: DataFrame) -> DataFrame:
    """Volume, density, shipping ratio, logs, complexity and size class."""
    vol = F.col("product_volume_cm3")
    return df.withColumn("product_volume_cm3", volume()).withColumns(
        {
            "density": density(vol),
            "shipping_ratio": shipping_ratio(),
            "log_weight": F.log1p(_double("product_weight_g")),
            "log_volume": F.log1p(vol),
            "complexity_score": complexity_score(),
            "size_category": size_category(vol),
        }
    )


def with_calendar_features(df: DataFrame, at: str = "order_purchase_timestamp") -> DataFrame:
    """Month, weekday (Monday = 0), hour and the two flags."""
    return df.withColumns(
        {
            "purchase_month": F.month(at),
            "purchase_day_of_week": F.weekday(at),
            "purchase_hour": F.hour(at),
        }
    ).withColumns(
        {
            "is_weekend": is_weekend(F.col("purchase_day_of_week")),
            "is_peak_season": is_peak_season(F.col("purchase_month")),
        }
    )


def log_target(price: Column) -> Column:
    return F.log1p(price)


def price_of(log_price: Column) -> Column:
    return F.expm1(log_price)
