"""Writers and readers of results: models, metrics and the category table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from .. import schemas
from ..operators.category import missing_categories, seed_lines


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_metrics(record: DataFrame, path: str) -> None:
    """Write a one-row result record as JSON."""
    record.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read comparison records of many runs."""
    return spark.read.schema(schemas.METRICS).json(paths)


def write_seed(stats: DataFrame, path: str) -> None:
    """Write the insert statement as UTF-8 text.

    The lines are range-sorted over as many files as needed; the part files in name order
    are the statement. A usual category table gives one file.
    """
    seed_lines(stats).write.mode("overwrite").text(path)


def insert_missing(stats: DataFrame, path: str) -> None:
    """Append the categories the table at ``path`` does not hold yet, creating it if needed.

    Running it again changes nothing: existing rows are never touched. Two writers at the same
    time may both append a category; run one at a time.
    """
    spark = stats.sparkSession
    try:
        existing = spark.read.schema(schemas.CATEGORY_STATS).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = spark.createDataFrame([], schemas.CATEGORY_STATS)
    missing_categories(stats, existing).write.mode("append").parquet(path)
