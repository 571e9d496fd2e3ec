"""Mergeable sketches, for those who take an error bound for less work. Exact forms are the default.

A sketch is a column of bytes that can be stored with a load and merged with those of other loads.

* Distinct counts: HyperLogLog with 2 ** ``LG_K`` registers. The relative standard error is about
  1.04 / sqrt(2 ** LG_K), 1.6 % here; counts up to some hundreds are all but exact.
* Quantiles: KLL with ``K`` items a level. The normalised rank error is below 0.8 % with 99 %
  confidence here. One scan in place of two, and a state of a few kilobytes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

LG_K = 12
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
K = 400
RANK_ERROR = 0.008


def seller_products(items: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``seller_id, products``: a distinct sketch of the products each seller sold."""
    known = items.filter("seller_id IS NOT NULL AND product_id IS NOT NULL")
    return known.groupBy("seller_id").agg(F.hll_sketch_agg("product_id", lg_k).alias("products"))


def merge_seller_products(*loads: DataFrame) -> DataFrame:
    """The sketches of several loads, as if of all their items."""
    together = reduce(DataFrame.unionAll, loads)
    return together.groupBy("seller_id").agg(F.hll_union_agg("products").alias("products"))


def seller_diversity(sketches: DataFrame) -> DataFrame:
    """``seller_id, seller_product_diversity``, estimated."""
    estimate = F.hll_sketch_estimate("products")
    return sketches.select("seller_id", estimate.alias("seller_product_diversity"))


def _usable(column: str):
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def value_sketches(df: DataFrame, columns: list[str], k: int = K) -> DataFrame:
    """One row with a quantile sketch of each column; null and NaN are skipped."""
    picked = df.select(*[_usable(c).alias(c) for c in columns])
    return picked.agg(*[F.kll_sketch_agg_double(c, F.lit(k)).alias(c) for c in columns])


def merge_value_sketches(*loads: DataFrame) -> DataFrame:
    """The sketches of several loads, as if of all their rows."""
    together = reduce(DataFrame.unionByName, loads)
    return together.agg(*[F.kll_merge_agg_double(c).alias(c) for c in together.columns])


def quantiles_of(sketches: DataFrame, targets: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with one column per target ``name: (column, probability)``."""
    found = []
    for name, (column, probability) in targets.items():
        some = F.kll_sketch_get_n_double(column) > 0
        value = F.kll_sketch_get_quantile_double(column, F.lit(float(probability)))
        found.append(F.when(some, value).alias(name))
    return sketches.select(*found)


def sketched_quantiles(df: DataFrame, targets: dict[str, tuple[str, float]]) -> DataFrame:
    """:func:`pricewright.functions.quantiles.exact_quantiles` within the error, in one scan."""
    columns = list(dict.fromkeys(column for column, _ in targets.values()))
    return quantiles_of(value_sketches(df, columns), targets)
