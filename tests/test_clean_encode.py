from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pricewright import schemas
from pricewright.operators import clean, encode


def test_impute_uses_row_medians(spark):
    df = spark.createDataFrame(
        [(1.0, 4.0, 1), (1.0, None, 2), (3.0, 2.0, None), (None, None, 12)],
        "product_avg_review double, seller_avg_review double, max_installments int",
    )
    rows = clean.impute_medians(df).collect()
    assert [r.product_avg_review for r in rows] == [1.0, 1.0, 3.0, 1.0]
    assert [r.seller_avg_review for r in rows] == [4.0, 3.0, 2.0, 3.0]
    assert [r.max_installments for r in rows] == [1.0, 2.0, 2.0, 12.0]


def test_trim_keeps_both_bounds(spark):
    df = spark.range(1, 102).select(F.col("id").cast("double").alias("price"))
    bounds = clean.outlier_bounds(df).first()
    assert (bounds.low, bounds.high) == (2.0, 100.0)
    kept = clean.trim_outliers(df).agg(F.min("price"), F.max("price"), F.count("price")).first()
    assert tuple(kept) == (2.0, 100.0, 99)


def test_unknown_fill(spark):
    df = spark.createDataFrame([(None, 5)], "a string, b int")
    assert tuple(clean.fill_unknown(df, ["a", "b"]).first()) == ("unknown", "5")


def _engineered(spark, **changes):
    base = {name: 1.0 for name in schemas.NUMERIC_BASE}
    base.update({name: "x" for name in schemas.CATEGORICAL})
    base.update(
        purchase_day_of_week=1, purchase_hour=1, is_weekend=0, category_avg_price=1.0, price=5.0
    )
    rows = [base] + [{**base, name: None} for name in changes["missing"]]
    kinds = {k: "string" if isinstance(v, str) else "double" for k, v in base.items()}
    data = [tuple(None if r[k] is None else (r[k] if kinds[k] == "string" else float(r[k])) for k in base) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def test_complete_rows(spark):
    missing = ["freight_value", "log_volume", "price", "size_category", "customer_state"]
    df = _engineered(spark, missing=missing)
    assert clean.complete_rows(df).count() == 3  # missing categories stay
    # The older model drops missing categories of its own list, and knows no states.
    assert clean.complete_baseline_rows(df).count() == 2


def test_derived_columns_are_missing_only_with_their_inputs():
    tested = set(schemas.NUMERIC_BASE) - clean.IMPLIED
    assert {
        "freight_value", "product_weight_g", "product_volume_cm3", "product_photos_qty",
        "product_description_lenght", "product_name_lenght", "purchase_month",
    } <= tested


def test_split_does_not_depend_on_partitions(spark, star):
    def split(df):
        rows = encode.with_split(df).select("item_key", "split", encode.fold().alias("fold"))
        return sorted(map(tuple, rows.collect()))

    one, many = split(star.items.coalesce(1)), split(star.items.repartition(8))
    assert one == many
    share = sum(s == "test" for _, s, _ in one) / len(one)
    assert 0.17 < share < 0.23
    assert {f for _, s, f in one if s == "train"} == {0, 1, 2}


def _rows(spark, test_price):
    data = [
        ("a", "s1", 10.0, "train"), ("a", "s2", 30.0, "train"), ("b", "s1", 50.0, "train"),
        ("c", "s9", test_price, "test"), ("a", "s1", test_price, "test"), ("a", None, 20.0, "train"),
    ]
    df = spark.createDataFrame(
        data, "product_category_name_english string, seller_id string, price double, split string"
    )
    return df.withColumn("label", F.log1p("price"))


def test_encodings_see_training_rows_only(spark):
    from pricewright.stage import Stage

    results = []
    for price in (1.0, 9999.0):
        rows = _rows(spark, price)
        encoded = encode.fit_encodings(rows, Stage(spark)).apply(rows)
        results.append(
            sorted(
                (r.product_category_name_english, r.seller_id or "", r.category_avg_price, r.seller_avg_price)
                for r in encoded.collect()
            )
        )
    assert results[0] == results[1]
    fallback = math.expm1(sum(math.log1p(p) for p in (10, 30, 50, 20)) / 4)
    found = {(c, s): (x, y) for c, s, x, y in results[0]}
    assert found[("a", "s1")] == pytest.approx((20.0, 30.0))
    assert found[("c", "s9")] == pytest.approx((fallback, fallback))
    assert found[("a", "")] == pytest.approx((20.0, fallback))


def test_full_means_include_all_rows(spark):
    rows = _rows(spark, 100.0)
    means = {r[0]: r[1] for r in clean.full_category_means(rows).collect()}
    assert means == {"a": pytest.approx(40.0), "b": 50.0, "c": 100.0}


def test_prepared_table(prepared):
    assert prepared.columns == ["item_key", "split", "price", "label", *schemas.FEATURES]
    nulls = prepared.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in schemas.FEATURES])
    assert sum(nulls.first()) == 0
    assert len(schemas.FEATURES) == 26 and len(schemas.BASELINE_FEATURES) == 20
