"""Packing by optimal length buckets.

Method: documents become sequences of at most ``MAX_TOKENS`` tokens (longer ones are cut, nothing is
lost). A global histogram of sequence lengths, at most ``MAX_TOKENS`` rows, goes to a dynamic
program that chooses the bucket boundaries with the least total padding. Inside each bucket,
batches are filled up to a token budget: with every sequence padded to its bucket's boundary, a batch
takes as many as fit.

A token is a word, and every document ends in one end mark. Places within a bucket are counted per lane
of a hash, with a fixed number of lanes, so the bucket that holds most rows is numbered by many
tasks; counts by bucket and lane give each lane's first number. Sequences alike in all columns are counted
before they are shuffled and numbered as one, so no id fills a lane.

Defined cases: null and empty texts are one sequence of one token; rows alike in id and length
are interchangeable and get a place each; null ids come first of their lane; an empty table gives an
empty result. Columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .tables import one_by_one, read, stage, text_of

MAX_TOKENS = 2048
BUCKETS = 8
BATCH_TOKENS = 65_536
LANES = 1024


def boundaries(counts: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding over a histogram."""
    lengths = np.array(sorted(counts), np.int64)
    n = len(lengths)
    if not n:
        return []
    number = np.concatenate([[0], np.cumsum([counts[x] for x in lengths.tolist()])])
    tokens = np.concatenate([[0], np.cumsum([counts[x] * x for x in lengths.tolist()])])
    # best[j]: least padding of the first j lengths; a bucket of lengths i .. j - 1 is padded to the
    # last of them.
    best = np.concatenate([[0.0], np.full(n, np.inf)])
    choice = []
    for _ in range(min(buckets, n)):
        following, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            padding = lengths[j - 1] * (number[j] - number[:j]) - (tokens[j] - tokens[:j])
            total = best[:j] + padding
            cut[j] = int(total.argmin())
            following[j] = total[cut[j]]
        best = following
        choice.append(cut)
    out, j = [], n
    for cut in reversed(choice):
        if j:
            out.append(int(lengths[j - 1]))
            j = int(cut[j])
    return out[::-1]


def sequences(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``doc_id, n_tokens, piece, start_token, length``: the sequences of every row."""
    text = text_of(docs)
    tokens = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1
    return (
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), tokens.alias("n_tokens"))
        .withColumn("pieces", F.ceil(F.col("n_tokens") / max_tokens).cast("int"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("start_token", (F.col("piece") * F.lit(max_tokens)).cast("long"))
        .withColumn(
            "length", F.least(F.lit(max_tokens), F.col("n_tokens") - F.col("start_token"))
        )
        .drop("pieces")
    )


def pack(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """``doc_id, piece, start_token, n_tokens, bucket, bucket_tokens, batch, slot`` of every sequence.

    ``n_tokens`` is the length of the sequence, ``bucket_tokens`` what it is padded to.
    """
    if batch_tokens < max_tokens:
        raise ValueError("a batch must hold the longest sequence")
    store = stage(docs.sparkSession)
    rows = sequences(docs, max_tokens).groupBy("doc_id", "piece", "start_token", "length")
    rows = store.table(rows.agg(F.count("*").alias("n")), "sequences")
    # One row for each length: at most ``max_tokens``.
    counts = rows.groupBy("length").agg(F.sum("n").alias("count")).collect()
    counts = {r["length"]: r["count"] for r in counts}
    upper = boundaries(counts, buckets)
    if not upper:
        upper = [max_tokens]
    bounds = F.array(*[F.lit(u).cast("long") for u in upper])
    bucket = F.expr("size(filter(bounds, b -> b < length))")
    lane = F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(LANES)).cast("int")
    rows = rows.withColumn("bounds", bounds).withColumn("bucket", bucket).withColumn("lane", lane)
    rows = rows.withColumn("bucket_tokens", F.col("bounds")[F.col("bucket")]).drop("bounds")
    before = (
        Window.partitionBy("bucket").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = (
        rows.groupBy("bucket", "lane")
        .agg(F.sum("n").alias("count"))
        .select("bucket", "lane", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    )
    within = (
        Window.partitionBy("bucket", "lane")
        .orderBy("doc_id", "piece", "length")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    size = F.floor(F.lit(batch_tokens) / F.col("bucket_tokens"))
    # ``first`` has at most buckets * LANES rows.
    numbered = (
        rows.withColumn("at", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(first), ["bucket", "lane"])
        .withColumn("at", F.col("first") + F.col("at"))
        .drop("first", "lane")
    )
    return one_by_one(store.table(numbered, "numbered")).select(
        "doc_id",
        "piece",
        "start_token",
        F.col("length").alias("n_tokens"),
        "bucket",
        "bucket_tokens",
        F.floor(F.col("at") / size).alias("batch"),
        (F.col("at") % size).alias("slot"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
