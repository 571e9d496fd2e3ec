"""Source tables laid out by order.

Orders, payments, reviews and items meet on the order id in every job. Written once in buckets of that id,
with equal numbers of buckets, they are joined and grouped by it without an exchange. Orders carry
the state of their customer, so that the join on the customer id is paid once, at conversion.

Bucketed files are Parquet files as any other; only the table's definition says how they are dealt
out. A layout folder holds that number, and a reader registers the tables from it under names of the
folder, so any session, and any catalog, can use it.

Buckets are read by one task each, and adaptive execution cannot split them. If one order fills a bucket by
the measure Spark uses for hot partitions, the tables are read as plain files, with exchanges.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.keys import KeyChecks
from ..stage import Stage
from .star import StarSchema

KEY = "order_id"
BY_ORDER = ("orders", "payments", "reviews", "items")
#: Unique keys of the dimension tables.
DIMENSION_KEYS = {
    "products": "product_id",
    "orders": "order_id",
    "customers": "customer_id",
    "sellers": "seller_id",
    "translation": "product_category_name",
}
_MANIFEST = "buckets int, largest long, mean double"


def write_layout(star: StarSchema, out: str, buckets: int) -> None:
    """Write all tables of ``star`` below ``out``; keys of dimensions are checked on the way.

    Choose ``buckets`` so that one of them fits a task: the size of the items over 128 MB.
    """
    spark = star.items.sparkSession
    tables = star.tables()
    keys = KeyChecks()
    checked = {
        name: keys.one_row_per_key(df, name, DIMENSION_KEYS[name]) if name in DIMENSION_KEYS else df
        for name, df in tables.items()
    }
    if "customers" in checked and "orders" in checked:
        # Written first: its size is then known where the orders meet it.
        checked["customers"].write.mode("error").parquet(f"{out}/customers.parquet")
        customers = spark.read.parquet(f"{out}/customers.parquet")
        checked["orders"] = checked["orders"].join(
            customers.select("customer_id", "customer_state"), "customer_id", "left"
        )
        checked.pop("customers")
    stage = Stage(spark, out)
    for name, df in checked.items():
        if name in BY_ORDER:
            stage.table(df, f"{name}.parquet", bucketed=(KEY, buckets))
        else:
            df.write.mode("error").parquet(f"{out}/{name}.parquet")
    keys.verify()
    stage.forget()
    largest, mean = _bucket_sizes(spark, [f"{out}/{n}.parquet" for n in BY_ORDER if n in checked])
    manifest = spark.createDataFrame([(buckets, largest, mean)], _MANIFEST)
    manifest.coalesce(1).write.mode("error").json(f"{out}/layout")


def _bucket_sizes(spark: SparkSession, paths: list[str]) -> tuple[int, float]:
    """Bytes of the largest file of all tables, and the mean of that table's files."""
    worst = (0, 0.0)
    for path in paths:
        file = F.col("_metadata")
        files = spark.read.parquet(path).groupBy(file["file_path"]).agg(F.max(file["file_size"]).alias("s"))
        most, mean = files.agg(F.max("s"), F.avg("s")).first()
        if most is not None and most > worst[0]:
            worst = most, mean
    return worst


def _is_hot(spark: SparkSession, largest: int, mean: float) -> bool:
    """Whether Spark would call a partition of this size hot."""
    conf = "spark.sql.adaptive.skewJoin"
    factor = float(spark.conf.get(f"{conf}.skewedPartitionFactor"))
    jvm = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    least = jvm.byteStringAsBytes(spark.conf.get(f"{conf}.skewedPartitionThresholdInBytes"))
    return largest > factor * mean and largest > least


def _registered(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The bucketed table at ``path``."""
    name = f"pricewright_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
    columns = spark.read.parquet(path).schema.toDDL()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) "
        f"SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def read_layout(
    spark: SparkSession, folder: str, tables: tuple[str, ...] = tuple(schemas.TABLES)
) -> StarSchema:
    """The named tables of a layout folder."""
    manifest = spark.read.schema(_MANIFEST).json(f"{folder}/layout").first()
    plain = _is_hot(spark, manifest["largest"], manifest["mean"])
    read = {}
    for name in tables:
        path = f"{folder}/{name}.parquet"
        if name in BY_ORDER and not plain:
            read[name] = _registered(spark, path, manifest["buckets"])
        else:
            read[name] = spark.read.parquet(path)
    return StarSchema(**read, by_order=not plain)
