"""Continuous scoring: requests arrive as a stream, priced rows leave as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.score import CORRUPT, score


#: Files of a batch where the caller names no limit, so that a backlog is no single huge batch.
FILES_PER_BATCH = 1000


def request_schema(keep: Sequence[str] = ()) -> T.StructType:
    """The request fields behind text columns ``keep`` (such as an id) to pass through.

    The last column takes a record that does not parse, so that it is rejected, not lost.
    """
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in keep]
        + schemas.REQUEST.fields
        + [T.StructField(CORRUPT, T.StringType())]
    )


def read_request_table(
    spark: SparkSession, path: str, fmt: str = "json", keep: Sequence[str] = ()
) -> DataFrame:
    """A table of requests. Parquet keeps the types it has; values are then cast with care."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.schema(request_schema(keep)).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.format(fmt).load(path)


def read_requests(
    spark: SparkSession,
    folder: str,
    fmt: str = "json",
    keep: Sequence[str] = (),
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Request files of a folder as a stream. A limit, of one kind only, bounds each batch of a backlog;
    without one it is ``FILES_PER_BATCH`` files."""
    schema = spark.read.parquet(folder).schema if fmt == "parquet" else request_schema(keep)
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if max_files_per_trigger is not None or max_bytes_per_trigger is None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger or FILES_PER_BATCH)
    return reader.format(fmt).load(folder)


def score_stream(
    requests: DataFrame,
    model: PipelineModel,
    output: str,
    checkpoint: str,
    keep: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start scoring into Parquet files below ``output``.

    The job keeps no state between rows, so the file log under ``checkpoint`` is all that is
    needed for exactly-once output after a restart. The default trigger drains what is
    there and stops; pass ``{"processingTime": "10 seconds"}`` to keep running.
    """
    return (
        score(requests, model, keep)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _write_sink(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of one batch, in a folder named by it, which a repeated batch replaces."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def score_into_sinks(
    requests: DataFrame,
    model: PipelineModel,
    priced: str,
    rejected: str,
    checkpoint: str,
    keep: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start scoring into two folders: priced requests, and rejected ones with their ``error``.

    Each batch is read and scored once. Its rows in either folder lie under its number, and a batch
    that runs again after a failure, whichever of the writes it had reached, writes the same folders
    anew: every request ends up in one sink, once. Read a sink with ``spark.read.parquet(folder)``;
    the batch number is a column of it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score(batch, model, keep).persist()
        try:
            _write_sink(scored.filter("error IS NULL").drop("error"), priced, batch_id)
            refused = scored.filter("error IS NOT NULL").drop("predicted_price")
            _write_sink(refused, rejected, batch_id)
        finally:
            scored.unpersist()

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
