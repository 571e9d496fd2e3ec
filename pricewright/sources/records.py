"""CSV records with line breaks inside quoted values, read in parallel from any part of a file.

A line break ends a record only where an even number of quotes stands before it in the file. So the parity
of the quotes of each block (the part of a file that one task reads) is counted in a first pass; a
prefix sum over the blocks of a file tells in which state each block begins; the second pass then cuts
every block into records on its own. A record that crosses the border of blocks leaves one fragment in each
of them, and the fragments, at most two a block, are put together afterwards.

Quotes inside a value are doubled, as in RFC 4180, which leaves the parity as it is. A file whose
quotes do not pair up is an error that names it.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

#: Options of the reader, and of a writer whose files it reads back unchanged.
CSV_OPTIONS = {"quote": '"', "escape": '"'}
WRITE_OPTIONS = CSV_OPTIONS | {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

_PIECES = "file long, block long, place int, opens boolean, text string"
#: Places of pieces: a whole record, the rest of one begun in an earlier block, one left open.
_WHOLE, _HEAD, _TAIL = 0, 1, 2


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, file_path, block, value``: the lines of all files, in order within a block."""
    metadata = F.col("_metadata")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.xxhash64(metadata["file_path"]).alias("file"),
            metadata["file_path"].alias("file_path"),
            metadata["file_block_start"].alias("block"),
            "value",
        )
    )


def borders(found: DataFrame) -> DataFrame:
    """``file, block, begins_open, ends_open`` of the blocks that a record enters or leaves."""
    quotes = F.char_length("value") - F.char_length(F.translate("value", '"', ""))
    parity = found.groupBy("file", "block").agg(
        F.bit_xor(quotes.bitwiseAND(1)).alias("odd"), F.first("file_path").alias("path")
    )
    file = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("odd").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = F.sum("odd").over(Window.partitionBy("file"))
    message = F.concat(F.lit("quotes do not pair up in "), F.col("path"))
    begins = F.when(every % 2 == 1, F.raise_error(message).cast("long")).otherwise(before % 2)
    return (
        parity.withColumn("begins", begins)
        .selectExpr("file", "block", "begins = 1 AS begins_open", "begins <> odd AS ends_open")
        .filter("begins_open OR ends_open")
    )


class _Block:
    """Cuts the lines of one block into pieces."""

    def __init__(self, file: int, block: int, begins_open: bool):
        self.file, self.block = file, block
        self.open = self.head = begins_open
        self.first = block == 0
        self.waiting: list[str] = []

    def cut(self, values: pa.Array, header: list[str] | None) -> Iterator[tuple[int, bool, str]]:
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) & 1
        closed = (np.cumsum(odd) + self.open) % 2 == 0
        texts = values.to_pylist()
        at = 0
        for end in (np.flatnonzero(closed) + 1).tolist():
            text = "\n".join([*self.waiting, *texts[at:end]])
            self.waiting.clear()
            at = end
            if self.head:
                self.head = False
                yield _HEAD, False, text
            elif self.first and header is not None:
                self.first = False
                own = next(csv.reader([text.removesuffix("\r").removeprefix("\ufeff")]), [])
                if own != header:
                    raise ValueError(f"the header {own} is not {header}")
            elif text not in ("", "\r"):
                yield _WHOLE, False, text
        self.waiting += texts[at:]
        self.open = bool((int(odd.sum()) + self.open) % 2)

    def end(self) -> Iterator[tuple[int, bool, str]]:
        """What the block leaves open."""
        if self.waiting:
            text = "\n".join(self.waiting)
            yield (_HEAD if self.head else _TAIL), not self.head, text


def _cutter(header: list[str] | None):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None

        def packed(pieces: list[tuple[int, bool, str]]) -> pa.RecordBatch:
            place, opens, text = zip(*pieces) if pieces else ((), (), ())
            n = len(pieces)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([current.file] * n, pa.int64()),
                    pa.array([current.block] * n, pa.int64()),
                    pa.array(place, pa.int32()),
                    pa.array(opens, pa.bool_()),
                    pa.array(text, pa.string()),
                ],
                ["file", "block", "place", "opens", "text"],
            )

        for batch in batches:
            file, block, begins = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)
            )
            new = (np.diff(file) != 0) | (np.diff(block) != 0)
            starts = [0, *(np.flatnonzero(new) + 1).tolist()] if len(file) else []
            for start, end in zip(starts, [*starts[1:], len(file)]):
                if current is None or (current.file, current.block) != (file[start], block[start]):
                    if current is not None:
                        yield packed(list(current.end()))
                    current = _Block(int(file[start]), int(block[start]), bool(begins[start]))
                values = batch.column(3).slice(start, end - start)
                yield packed(list(current.cut(values, header)))
        if current is not None:
            yield packed(list(current.end()))

    return cut


def records(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """``record``: the text of every record, its line breaks included.

    With a ``header``, each file's first line is held against it and left out. Blank lines between
    records are no records. As many tasks read a file as Spark cuts it into blocks.
    """
    found = lines(spark, path)
    # One row of 24 bytes at most for each block of ``spark.sql.files.maxPartitionBytes``: 20 MB for
    # 100 TB of files. A shuffle join would also lose the order of the lines.
    crossed = F.broadcast(borders(found))

    def pieces(how: str) -> DataFrame:
        known = found.join(crossed, ["file", "block"], how)
        begins = F.coalesce("begins_open", F.lit(False)).alias("begins_open")
        return known.select("file", "block", begins, "value").mapInArrow(_cutter(header), _PIECES)

    whole = pieces("left").filter(F.col("place") == _WHOLE).select(F.col("text").alias("record"))
    # Only blocks that a record enters or leaves are cut again for their fragments.
    fragments = pieces("inner").filter(F.col("place") != _WHOLE)
    order = Window.partitionBy("file").orderBy("block", "place")
    crossing = (
        fragments.withColumn("number", F.sum(F.col("opens").cast("int")).over(order))
        .groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("parts"))
        .select(F.array_join(F.col("parts.text"), "\n").alias("record"))
    )
    return whole.unionAll(crossing)


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """The rows of CSV files with a header line, typed by ``schema`` in the files' column order."""
    found = records(spark, path, schema.names)
    options = CSV_OPTIONS | {"mode": mode, "multiLine": "true"}
    # As Spark's reader of whole files does: where records end in CRLF, breaks inside values become LF.
    crlf = F.col("record").endswith("\r")
    text = F.when(crlf, F.regexp_replace(F.rtrim("record", F.lit("\r")), "\r\n", "\n"))
    parsed = F.from_csv(text.otherwise(F.col("record")), schema.toDDL(), options)
    return found.select(parsed.alias("row")).select("row.*")
