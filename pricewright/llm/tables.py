"""Shared handling of the document table: keys, sizes, staged tables, word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..stage import Stage

#: Words are runs of anything but the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"
#: A null document id stands for the smallest id of all.
NULL_ID = -(2**63)
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(spark: SparkSession) -> Stage:
    return Stage(spark)


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Let Arrow send texts to Python workers in batches of at most ``size``, unless the session
    names a size: a batch is held by the JVM and by the worker, in each direction."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeats_ids(docs: DataFrame, column: str = "doc_id") -> bool:
    """Whether several rows share an id. Reads the id column alone."""
    return bool(docs.groupBy(column).count().filter("count > 1").head(1))


def version_of(docs: DataFrame) -> Column:
    """0 where ids are unique, else a hash of the text."""
    return F.xxhash64(text_of(docs)) if repeats_ids(docs) else F.lit(0).cast("long")


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """``id, version, text`` of every row, and ``more`` of its columns.

    Rows that share a ``doc_id`` (null ids among them) are versions of one document, told
    apart by a hash of their text; with unique ids, the usual case, ``version`` is 0. Repeated
    rows are equal in all three columns and so get equal results.
    """
    return docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("id"),
        version_of(docs).alias("version"),
        text_of(docs).alias("text"),
        *more,
    )


def doc_id(column: str = "id") -> Column:
    """The outer id of a keyed row."""
    return F.when(F.col(column) != NULL_ID, F.col(column))


#: Equal rows that are numbered by one task.
RUN = 65_536


def one_by_one(counted: DataFrame, at: str = "at", n: str = "n") -> DataFrame:
    """Each row of a written table ``n`` times, with ``at`` counting on; ``n`` is dropped.

    A row that stands for more than ``RUN`` is cut into runs, which are dealt out.
    """
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) DIV {RUN}")))
    hot = (
        counted.filter(F.col(n) > RUN)
        .withColumn("run", run)
        .withColumn(at, F.col(at) + F.col("run") * RUN)
        .withColumn(n, F.least(F.col(n) - F.col("run") * RUN, F.lit(RUN)))
        .drop("run")
        .repartition(at)
    )
    rows = counted.filter(F.col(n) <= RUN).unionByName(hot)
    one = F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    return rows.withColumn("one", one).withColumn(at, F.col(at) + F.col("one")).drop("one", n)


def buckets(spark: SparkSession) -> int:
    """Groups that a hash deals packed data into: in proportion to the shuffle partitions,
    which whoever runs the job sizes to the data."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


BUCKETED = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("blob", T.BinaryType())]
)
