"""Train/test split and leak-free target encodings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.features import log_target, price_of
from ..stage import Stage

ITEM_KEY = ["order_id", "order_item_id", "product_id", "seller_id"]


def item_key(columns: list[str] | None = None) -> Column:
    """Text identity of a sold item; a price in cents separates otherwise equal rows."""
    cents = F.rint(F.col("price") * 100).cast("bigint").cast("string")
    return F.concat_ws("|", *(columns or ITEM_KEY), cents)


def key_hash(key: Column) -> Column:
    """The first 32 bits of the MD5 of a key, the same on every engine and every run."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def with_split(df: DataFrame, key: str = "item_key") -> DataFrame:
    """Add ``item_key``, ``split`` (one row in five is ``test``) and the log target ``label``.

    The split depends on the row alone: no sort, no shuffle, and the same for any number
    of partitions or restarts.
    """
    if key not in df.columns:
        df = df.withColumn(key, item_key([c for c in ITEM_KEY if c in df.columns]))
    side = F.when(key_hash(F.col(key)) % 5 == 0, "test").otherwise("train")
    return df.withColumns({"split": side, "label": log_target(F.col("price"))})


def fold(folds: int = 3, key: str = "item_key") -> Column:
    """Fold number from other hash bits than the split uses."""
    bits = F.conv(F.substring(F.md5(F.col(key)), 9, 8), 16, 10).cast("bigint")
    return (bits % folds).cast("int")


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")


def test_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "test")


def train_price_totals(df: DataFrame) -> DataFrame:
    """Training rows, price sum and log price sum per (category, seller) pair.

    The training rows are read once for all three encodings, and combined before the
    shuffle: no category or seller reaches a task as raw rows.
    """
    return (
        train_rows(df)
        .groupBy("product_category_name_english", "seller_id")
        .agg(
            F.count("label").alias("rows"),
            F.sum("label").alias("label_sum"),
            F.sum(price_of(F.col("label"))).alias("price_sum"),
        )
    )


def global_avg_price(totals: DataFrame) -> DataFrame:
    """Back-transformed mean log price of the training rows (not the arithmetic mean)."""
    mean = F.try_divide(F.sum("label_sum"), F.sum("rows"))
    return totals.agg(price_of(mean).alias("global_avg_price"))


def train_price_means(totals: DataFrame, key: str, name: str) -> DataFrame:
    """Mean price per key over the training rows only."""
    return (
        totals.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.try_divide(F.sum("price_sum"), F.sum("rows")).alias(name))
    )


@dataclass(frozen=True)
class TargetEncodings:
    """Fitted lookup tables."""

    category: DataFrame
    seller: DataFrame
    fallback: DataFrame

    def apply(self, df: DataFrame) -> DataFrame:
        """Add both averages; keys not seen in training get the global average."""
        fallback = self.fallback.select("global_avg_price").scalar()
        joined = df.join(self.category, "product_category_name_english", "left").join(
            self.seller, "seller_id", "left"
        )
        return joined.withColumns(
            {
                name: F.coalesce(F.col(name), fallback)
                for name in ("category_avg_price", "seller_avg_price")
            }
        )


def fit_encodings(df: DataFrame, stage: Stage) -> TargetEncodings:
    """Category and seller averages of the training rows, written so that their size is
    known where they are joined."""
    stage = stage.sub("encodings")
    totals = stage.table(train_price_totals(df), "train_price_totals")
    category = train_price_means(totals, "product_category_name_english", "category_avg_price")
    seller = train_price_means(totals, "seller_id", "seller_avg_price")
    return TargetEncodings(
        category=stage.table(category, "category_avg_price"),
        seller=stage.table(seller, "seller_avg_price"),
        fallback=global_avg_price(totals),
    )


def level_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct training levels per categorical column: the width of each one-hot block."""
    return train_rows(df).agg(*[F.count_distinct(c).alias(c) for c in columns])
