"""Reproducible sharding by a Feistel permutation.

Method: every row has a global number from 0; a Feistel network over the next even power of two
permutes the numbers, walking its cycle again while a value is out of range, which keeps it a
permutation of the row numbers. The permuted number gives shard (remainder) and slot (quotient), so
the shards' row counts differ by one at most, slots have no gaps, and the shard and slot of a row number
can be computed, and inverted, without any table.

Row numbers follow the order of (lane, id, checksum, size), where the lane is a hash of the other three
and their number is fixed, so they depend on the rows alone. Rows alike in all three are counted before
they are shuffled and numbered as one, so neither an id nor a row that is a third of the table fills a
lane. Counts by lane give each lane's first number.

Defined cases: null and empty texts have size 8 and checksum 0; null ids come first of their lane;
rows that are alike in id, checksum and size are interchangeable and get a slot each; an empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .runs import mix
from .tables import one_by_one, read, stage, text_of

SHARDS = 24
SEED = 20_240_607
ROUNDS = 8
#: Lanes of row numbers; the table of their first numbers has as many rows and is broadcast.
LANES = 4096


def _round(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    return mix(half + np.uint64(key)) & mask


def _network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ _round(right, key, mask)
    # The halves change places at the end, so the same network with reversed keys inverts it.
    return (right << shift) | left


def round_keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.default_rng(seed).integers(0, 2**63, ROUNDS)]


def permute(numbers: np.ndarray, total: int, seed: int = SEED, invert: bool = False) -> np.ndarray:
    """A permutation of 0 .. total - 1, applied to ``numbers``; or its inverse."""
    keys = round_keys(seed)[:: -1 if invert else 1]
    bits = max(1, -(-max(1, (total - 1).bit_length()) // 2))
    out = _network(numbers.astype(np.uint64), bits, keys)
    while len(outside := np.flatnonzero(out >= np.uint64(total))):
        out[outside] = _network(out[outside], bits, keys)
    return out.astype(np.int64)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, row_number, shard, slot`` of every row."""
    store = stage(docs.sparkSession)
    text = text_of(docs)
    alike = ["doc_id", "text_crc32", "size"]
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    lane = F.pmod(F.xxhash64(*alike), F.lit(LANES)).cast("int")
    counted = rows.groupBy(*alike).agg(F.count("*").alias("n")).withColumn("lane", lane)
    counted = store.table(counted, "counted")
    counts = counted.groupBy("lane").agg(F.sum("n").alias("count"))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("lane", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("lane").orderBy(*alike).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        counted.withColumn("at", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(first), "lane")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("first") + F.col("at")).alias("row_number"),
            "n",
        )
    )
    numbered = one_by_one(store.table(numbered, "numbered"), "row_number")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("row_number").to_numpy(zero_copy_only=False)
            to = permute(number, total, seed)
            columns = [pa.array((to % shards).astype(np.int32)), pa.array(to // shards)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], [*batch.schema.names, "shard", "slot"]
            )

    return numbered.mapInArrow(
        place,
        "doc_id long, size long, text_crc32 long, row_number long, shard int, slot long",
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        "size",
        "text_crc32",
        "'rows' AS law",
        "shard",
        "slot",
        "CAST(NULL AS INT) AS grown_shard",
    )
