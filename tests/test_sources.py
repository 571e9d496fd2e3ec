from __future__ import annotations

import datetime as dt
import os

import pytest

from pricewright import schemas
from pricewright.sources.star import (
    read_csv_table,
    read_quarantined,
    read_star,
    scan_counts,
    to_parquet,
)
from pricewright.stage import Stage, shared_dir

FILES = {
    "items": 'freight_value,order_id,order_item_id,product_id,seller_id,shipping_limit_date,price\n'
    "1.5,o1,1,p1,s1,2018-01-01 00:00:00,10.0\n,o2,1,p2,s1,2018-01-01 00:00:00,\n",
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,"
    "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
    "p1,ca,40,287,1,225,16,10,14\np2,,,,,,,,\n",
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp\n"
    "o1,c1,delivered,2017-10-02 10:56:33\no2,c2,delivered,2017-11-02 10:56:33\n",
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    "o1,1,boleto,3,18.12\n",
    "reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,4,,"two lines,\nand a ""quote""",2018-01-18 00:00:00,2018-01-18 21:46:59\n',
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,"
    "customer_state\nc1,u1,01151,sao paulo,SP\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,13023,campinas,RJ\n",
    "translation": "product_category_name,product_category_name_english\nca,health_beauty\n",
}


@pytest.fixture
def csv_folder(tmp_path):
    for table, text in FILES.items():
        (tmp_path / schemas.CSV_FILES[table]).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_csv_tables(spark, csv_folder):
    star = read_star(spark, csv_folder)
    first, second = star.items.orderBy("order_id").collect()
    assert (first.price, first.freight_value, first.order_item_id) == (10.0, 1.5, 1)
    assert second.price is None and second.freight_value is None
    review = star.reviews.first()
    assert (review.review_score, review.review_creation_date) == (4, dt.datetime(2018, 1, 18))
    assert star.products.filter("product_category_name IS NULL").count() == 1
    counts = {r.table_name: r.row_count for r in scan_counts(star).collect()}
    assert counts == {
        "items": 2, "products": 2, "orders": 2, "payments": 1, "reviews": 1,
        "customers": 1, "sellers": 1, "translation": 1,
    }


def test_subset_and_parquet(spark, csv_folder, tmp_path):
    star = read_star(spark, csv_folder, schemas.CORE_TABLES)
    assert star.payments is None
    for table, df in star.tables().items():
        df.write.parquet(str(tmp_path / "pq" / f"{table}.parquet"))
    again = read_star(spark, str(tmp_path / "pq"), schemas.CORE_TABLES, fmt="parquet")
    assert again.items.schema == star.items.schema and again.items.count() == 2


def test_bad_value_and_missing_column(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("order_id,customer_id,order_purchase_timestamp\no1,c1,yesterday\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|yesterday"):
        read_csv_table(spark, "orders", str(bad)).collect()
    lenient = read_csv_table(spark, "orders", str(bad), mode="PERMISSIVE").first()
    assert lenient.order_purchase_timestamp is None
    with pytest.raises(ValueError, match="seller_state"):
        read_csv_table(spark, "sellers", str(bad))


def test_only_used_columns_are_read(spark, star):
    plan = star.items.select("product_id")._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "l_partkey" in plan


def test_scans_are_not_repartitioned(star):
    for df in (star.items, star.items.groupBy().count()):
        assert "RoundRobin" not in df._jdf.queryExecution().executedPlan().toString()


def test_stage_tables(spark, stage):
    df = spark.range(5).withColumnRenamed("id", "x")
    assert stage.table(df, "t").count() == 5
    assert stage.root.startswith(shared_dir(spark))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        stage.table(df, "t")
    assert Stage(spark).root != stage.root


def test_stage_is_removed(spark):
    with Stage(spark) as stage:
        stage.table(spark.range(3).toDF("x"), "t")
        folder = stage.root.removeprefix("file:").replace("///", "/")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    stage.remove()


class _Session:
    """Just enough of a session to ask for the shared folder."""

    def __init__(self, configured, master, current=None, default="file:///"):
        session = self

        class conf:
            get = staticmethod(lambda key, default=None: configured or default)

        class hadoop:
            get = staticmethod(lambda key: default)

        class jsc:
            hadoopConfiguration = staticmethod(lambda: hadoop)

        class context:
            getCheckpointDir = staticmethod(lambda: current)

        context.master, context._jsc = master, jsc
        session.conf, session.sparkContext = conf, context


def test_shared_folder_is_the_named_one():
    assert shared_dir(_Session("hdfs://ckpt/", "yarn")) == "hdfs://ckpt"
    assert shared_dir(_Session(None, "yarn", "hdfs://set")) == "hdfs://set"
    assert shared_dir(_Session("/ckpt", "yarn", default="hdfs://name")) == "/ckpt"
    assert shared_dir(_Session("file:///ckpt", "local[4]")) == "file:///ckpt"
    for folder in (None, "/ckpt", "file:///ckpt"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(_Session(folder, "yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session(None, "local[4]"))


def test_files_of_differing_column_order_are_refused(spark, tmp_path):
    (tmp_path / "sellers").mkdir()
    (tmp_path / "sellers/a.csv").write_text("seller_id,seller_state\ns1,SP\n")
    (tmp_path / "sellers/b.csv").write_text("seller_state,seller_id\nRJ,s2\n")
    with pytest.raises(Exception, match="header|Header"):
        read_csv_table(spark, "sellers", str(tmp_path / "sellers")).collect()


def test_quarantine(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "order_id,payment_type,payment_installments\n"
        "o1,boleto,3\no2,card,many\no3,,\no4,card, \n"
    )
    good, aside = read_quarantined(spark, "payments", str(tmp_path / "p.csv"))
    assert sorted(r.order_id for r in good.collect()) == ["o1", "o3", "o4"]
    (row,) = aside.collect()
    assert row.reason == "payment_installments: no int: many" and "o2" in row.record


def test_conversion_to_parquet(spark, csv_folder, tmp_path):
    to_parquet(spark, csv_folder, str(tmp_path / "out"))
    before = {r.table_name: r.row_count for r in scan_counts(read_star(spark, csv_folder)).collect()}
    after = read_star(spark, str(tmp_path / "out"), fmt="parquet")
    assert {r.table_name: r.row_count for r in scan_counts(after).collect()} == before
