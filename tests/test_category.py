from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from pricewright import schemas
from pricewright.operators import category
from pricewright.plans import jobs
from pricewright.sources import sinks
from pricewright.sources.star import StarSchema
from pricewright.stage import Stage


@pytest.fixture
def small_star(spark):
    def frame(rows, columns):
        return spark.createDataFrame(rows, columns)

    return StarSchema(
        items=frame(
            [
                ("o1", "p1", 10.0), ("o1", "p1", 20.0), ("o2", "p2", 300.0),
                ("o3", "p3", 60.0), ("o3", "p4", None), ("o4", "p5", 5.0), ("o5", "p6", 1.0),
            ],
            "order_id string, product_id string, price double",
        ),
        products=frame(
            [("p1", "ca"), ("p2", "ca"), ("p3", "cb"), ("p4", "cb"), ("p5", None), ("p6", "cz")],
            "product_id string, product_category_name string",
        ),
        translation=frame(
            [("ca", "men's"), ("cb", "beds")],
            "product_category_name string, product_category_name_english string",
        ),
        reviews=frame(
            [("o1", 5), ("o1", 4), ("o2", 1)], "order_id string, review_score int"
        ),
    )


def test_statistics(small_star, stage):
    rows = {r.category: r for r in category.category_stats(small_star, stage).collect()}
    assert set(rows) == {"men's", "beds"}
    men, beds = rows["men's"], rows["beds"]
    assert men.avg_price == 110.0 and men.default_max_installments == 6
    assert men.avg_review == 3.33  # (4.5 + 4.5 + 1) / 3
    assert men.median_sales_count == 2  # median of 2 and 1 is 1.5, to even
    assert beds.avg_price == 60.0 and beds.default_max_installments == 3
    assert beds.avg_review == 3.33  # no review: mean of the category averages
    assert beds.median_sales_count == 1
    assert {r.most_common_payment_type for r in rows.values()} == {"credit_card"}


def test_seed_text(spark, small_star, stage, tmp_path):
    sinks.write_seed(category.category_stats(small_star, stage), str(tmp_path / "seed"))
    text = "".join(
        open(part, encoding="utf-8").read()
        for part in sorted(glob.glob(str(tmp_path / "seed" / "part-*")))
    )
    assert text == (
        "INSERT INTO category_stats (category, avg_price, avg_review, median_sales_count, "
        "most_common_payment_type, default_max_installments)\nVALUES\n"
        "  ('beds', 60.0, 3.33, 1, 'credit_card', 3),\n"
        "  ('men''s', 110.0, 3.33, 2, 'credit_card', 6)\n"
        "ON CONFLICT (category) DO NOTHING;\n"
    )


def test_seed_numbers(spark):
    df = spark.createDataFrame([(4.0,), (115.8,), (12345678.9,), (0.05,), (None,)], "x double")
    assert [r[0] for r in df.select(category._number(F.col("x"))).collect()] == [
        "4.0", "115.8", "12345678.9", "0.05", "NULL",
    ]


def test_tiers_of_published_prices(spark):
    pairs = [
        (25.34, 1), (49.99, 1), (50.0, 3), (54.6, 3), (99.99, 3), (100.0, 6), (115.8, 6),
        (199.99, 6), (200.0, 12), (201.14, 12), (1098.34, 12), (None, 12),
    ]
    df = spark.createDataFrame(pairs, "p double, tier int")
    assert df.filter(category.installment_tier(F.col("p")) != F.col("tier")).count() == 0


def test_reports(spark):
    stats = spark.createDataFrame(
        [(f"c{i:02d}", float(i // 2), 4.0, i, "credit_card", 1) for i in range(20)],
        schemas.CATEGORY_STATS,
    )
    top = [r.category for r in category.top_categories(stats).collect()]
    assert top[:3] == ["c18", "c19", "c16"] and len(top) == 10
    assert [r.category for r in category.bottom_categories(stats).collect()] == [
        "c00", "c01", "c02", "c03", "c04",
    ]
    ranges = category.category_ranges(stats).first()
    assert (ranges.categories, ranges.min_avg_price, ranges.max_median_sales_count) == (20, 0, 19)


def test_insert_never_changes_existing_rows(spark, small_star, tmp_path):
    target = str(tmp_path / "table")
    first = jobs.categories(small_star, Stage(spark), table_path=target)
    changed = first.withColumn("avg_price", F.lit(0.0)).unionByName(
        first.limit(1).withColumn("category", F.lit("new"))
    )
    for _ in range(2):
        sinks.insert_missing(changed, target)
        rows = {r.category: r.avg_price for r in spark.read.parquet(target).collect()}
        assert rows == {"men's": 110.0, "beds": 60.0, "new": rows["new"]}
        assert spark.read.parquet(target).count() == 3


def test_hot_category(spark, stage):
    """One category and one order hold a third of the items."""
    n = 9000
    items = spark.range(n).selectExpr(
        "IF(id % 3 = 0, 'o', concat('o', id)) AS order_id",
        "IF(id % 3 = 0, 'p0', concat('p', id % 90)) AS product_id",
        "CAST(id % 97 AS DOUBLE) AS price",
    )
    products = spark.range(90).selectExpr(
        "concat('p', id) AS product_id", "concat('c', id % 4) AS product_category_name"
    )
    translation = spark.range(4).selectExpr(
        "concat('c', id) AS product_category_name", "concat('e', id) AS product_category_name_english"
    )
    review_rows = spark.range(n).selectExpr(
        "IF(id % 3 = 0, 'o', concat('o', id)) AS order_id", "CAST(1 + id % 5 AS INT) AS review_score"
    )
    got = category.category_stats(
        StarSchema(items=items, products=products, translation=translation, reviews=review_rows),
        stage,
    ).toPandas()
    i, p = items.toPandas(), products.toPandas()
    i["category"] = i.product_id.map(dict(zip(p.product_id, p.product_category_name))).str.replace(
        "c", "e"
    )
    mean = review_rows.toPandas().groupby("order_id").review_score.mean()
    i["score"] = i.order_id.map(mean)
    counts = i.groupby(["category", "product_id"]).size().groupby("category").median()
    expected = i.groupby("category").agg(price=("price", "mean"), score=("score", "mean"))
    assert got.avg_price.tolist() == pytest.approx(expected.price.round(2).tolist())
    assert got.avg_review.tolist() == pytest.approx(expected.score.round(2).tolist())
    assert got.median_sales_count.tolist() == [round(v) for v in counts]
