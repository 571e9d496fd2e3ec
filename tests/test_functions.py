from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pricewright.functions import features
from pricewright.functions.numeric import round_half_even, whole_half_even
from pricewright.functions.quantiles import exact_quantiles


def test_size_classes_are_right_closed(spark):
    volumes = [-1.0, 0.0, 0.5, 1000.0, 1000.1, 10000.0, 10001.0, 100000.0, 100001.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(volumes)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(features.size_category(F.col("v"))).collect()]
    assert got == [
        None, None, "small", "small", "medium", "medium", "large", "large", "very_large", None,
    ]


def test_flags_are_zero_for_null(spark):
    df = spark.createDataFrame([(11,), (12,), (1,), (None,)], "m int")
    assert [r[0] for r in df.select(features.is_peak_season(F.col("m"))).collect()] == [1, 1, 0, 0]


def test_calendar_features(spark):
    # 2018-01-01 was a Monday.
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2018-01-01 05:00:00'), "
        "(timestamp_ntz'2018-11-25 23:59:59'), (NULL) AS t(order_purchase_timestamp)"
    )
    rows = features.with_calendar_features(df).collect()
    assert [r.purchase_day_of_week for r in rows] == [0, 6, None]
    assert [r.is_weekend for r in rows] == [0, 1, 0]
    assert [r.is_peak_season for r in rows] == [0, 1, 0]
    assert [r.purchase_hour for r in rows] == [5, 23, None]


def test_physical_features(spark):
    df = spark.createDataFrame(
        [(2.0, 3.0, 4.0, 50.0, 10.2, 3, 200, 40), (2.0, 3.0, 4.0, None, 10.2, 3, 200, 40)],
        "product_length_cm double, product_height_cm double, product_width_cm double, "
        "product_weight_g double, freight_value double, product_photos_qty int, "
        "product_description_lenght int, product_name_lenght int",
    )
    full, light = features.with_physical_features(df).collect()
    assert full.product_volume_cm3 == 24
    assert full.density == pytest.approx(2.0)
    assert full.shipping_ratio == pytest.approx(0.2)
    assert full.log_weight == pytest.approx(math.log(51))
    assert full.complexity_score == pytest.approx(1.5 + 2.0 + 0.8)
    assert light.density is None and light.shipping_ratio is None and light.log_volume is not None


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (1.5,)], "x double")
    assert [r[0] for r in df.select(round_half_even(F.col("x"))).collect()] == [
        0.12, 0.38, 2.5, 1.5,
    ]
    assert [r[0] for r in df.select(whole_half_even(F.col("x"))).collect()] == [0, 0, 2, 2]


PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


def _quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    row = exact_quantiles(df, {f"q{i}": ("x", p) for i, p in enumerate(PROBABILITIES)}).first()
    return list(row)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats(-1e6, 1e6), st.sampled_from([0.0, -0.5, 7.0, 7.0, 1e-9, 1e12])
        ),
        min_size=1,
        max_size=60,
    )
)
def test_quantiles_equal_linear_interpolation(spark, values):
    expected = np.quantile(np.array(values), PROBABILITIES)
    assert _quantiles(spark, values) == pytest.approx(list(expected), rel=1e-9, abs=1e-9)


def test_quantiles_with_a_hot_value_and_many_buckets(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(4000, 19.9), rng.lognormal(4, 2, 8000).round(2)])
    expected = np.quantile(values, PROBABILITIES)
    assert _quantiles(spark, values.tolist()) == pytest.approx(list(expected), rel=1e-9)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame(
        [(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "a double, b double"
    )
    row = exact_quantiles(df, {"a": ("a", 0.5), "b": ("b", 0.5)}).first()
    assert row.a == 2.0 and row.b is None
