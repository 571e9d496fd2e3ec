"""Imputation, feature derivation, row cleaning and outlier trimming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from .. import schemas
from ..functions.features import with_calendar_features, with_physical_features
from ..functions.quantiles import exact_quantiles

Quantiles = Callable[[DataFrame, dict[str, tuple[str, float]]], DataFrame]
IMPUTED = ["product_avg_review", "seller_avg_review", "max_installments"]
# Columns that are missing only when another numeric feature is.
IMPLIED = {"density", "shipping_ratio", "complexity_score", "is_weekend", "is_peak_season"}
OUTLIER_BOUNDS = {"low": ("price", 0.01), "high": ("price", 0.99)}


def priced(facts: DataFrame) -> DataFrame:
    """Rows with a target."""
    return facts.filter(F.col("price").isNotNull())


def imputation_medians(facts: DataFrame, quantiles: Quantiles = exact_quantiles) -> DataFrame:
    """Medians over all item rows, as one row. ``sketches.sketched_quantiles`` has a bounded error."""
    return quantiles(facts, {name: (name, 0.5) for name in IMPUTED})


def impute_medians(facts: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Fill missing review averages and installments with the median of their column."""
    medians = imputation_medians(facts) if medians is None else medians
    fill = medians.select(F.struct(*IMPUTED)).scalar()
    return facts.withColumns(
        {name: F.coalesce(F.col(name).cast("double"), fill[name]) for name in IMPUTED}
    )


def fill_unknown(df: DataFrame, columns: list[str] = schemas.CATEGORICAL) -> DataFrame:
    return df.withColumns(
        {name: F.coalesce(F.col(name).cast("string"), F.lit("unknown")) for name in columns}
    )


def outlier_bounds(df: DataFrame, quantiles: Quantiles = exact_quantiles) -> DataFrame:
    """The 1 % and 99 % price quantiles, as one row ``low, high``."""
    return quantiles(df, OUTLIER_BOUNDS)


def trim_outliers(df: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Keep prices within the bounds, both inclusive."""
    bounds = outlier_bounds(df) if bounds is None else bounds
    limits = bounds.select(F.struct("low", "high")).scalar()
    return df.filter(F.col("price").between(limits["low"], limits["high"]))


def engineer(facts: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Current feature set: priced rows, imputed medians, derived columns."""
    return with_calendar_features(
        with_physical_features(impute_medians(priced(facts), medians))
    )


def _without_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which no named column is null or NaN.

    One condition per column, unlike ``na.drop``: the scan then gets the null tests. Derived
    columns whose inputs are tested anyway are left out, which keeps the generated filter
    below the size up to which the JVM compiles a method.
    """
    columns = [name for name in columns if name not in IMPLIED]
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    present = [f"`{name}` IS NOT NULL" for name in columns]
    present += [f"NOT isnan(`{name}`)" for name in columns if name in doubles]
    return df.where(" AND ".join(present))


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows in which no numeric feature and no price is missing."""
    return _without_missing(df, schemas.NUMERIC_BASE + ["price"])


def clean(engineered: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Current model: complete rows, trimmed prices, ``unknown`` for missing categories."""
    return fill_unknown(trim_outliers(complete_rows(engineered), bounds))


def engineer_baseline(facts: DataFrame, category_means: DataFrame | None = None) -> DataFrame:
    """Older feature set, with the category mean taken over all priced rows.

    That mean sees the rows later used for testing. It is kept for comparison with the
    older results only; :mod:`pricewright.operators.encode` has the leak-free form.
    """
    rows = priced(facts)
    means = full_category_means(rows) if category_means is None else category_means
    return with_calendar_features(with_physical_features(rows)).join(
        means, "product_category_name_english", "left"
    )


def full_category_means(facts: DataFrame) -> DataFrame:
    return (
        priced(facts)
        .filter(F.col("product_category_name_english").isNotNull())
        .groupBy("product_category_name_english")
        .agg(F.avg("price").alias("category_avg_price"))
    )


def complete_baseline_rows(df: DataFrame) -> DataFrame:
    """Rows in which none of the older features, categories included, is missing."""
    return _without_missing(df, schemas.BASELINE_FEATURES + ["price"])


def clean_baseline(
    engineered: DataFrame, trim: bool = True, bounds: DataFrame | None = None
) -> DataFrame:
    """Older model (``trim``) or algorithm comparison (no trim)."""
    rows = complete_baseline_rows(engineered)
    return trim_outliers(rows, bounds) if trim else rows
