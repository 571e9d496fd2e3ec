"""SimHash near-duplicates by exact tiled comparison.

Method: distinct 64-bit fingerprints are laid out in tiles ordered by their population count; tile
pairs whose counts differ by more than the radius are skipped, since each differing bit changes
the count by at most one; the others are compared with numpy exclusive-or and bit counts.

All tiles against all would be quadratic, so fingerprints are first split by ``radius + 1`` bands
of bits: two that differ in at most ``radius`` bits agree in one band at least, so every link is found
within some band value. A band value with more fingerprints than a group may hold is cut into tiles,
and tile pairs are dealt to tasks. A tile pair reports a spanning star of its links, never
all pairs, which keeps each component connected.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and are linked
like any other; repeated rows and rows with one id each keep their row; a null id is the smallest
id; an empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import runs as R
from .components import components
from .tables import NULL_ID, buckets, doc_id, keyed, read, repeats_ids, stage, version_of

SHINGLE = 3
RADIUS = 3
BITS = 64
SEED = 42
#: Fingerprints of one band value that are compared within one group; more are cut into tiles.
GROUP = 8192
TILE = 2048
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first = (ends - size)[:n].tolist()
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        spans = zip(first[at : at + _BLOCK], last[at : at + _BLOCK])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``id, version, fp`` of every row of :func:`tables.keyed`; the fingerprint as a signed long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = R.string_buffer(batch.column("text"))
            found = np.array(
                [
                    fingerprint(data[a:b].tobytes(), shingle)
                    for a, b in zip(off[:-1], off[1:])
                ],
                np.uint64,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("version"), pa.array(found.view(np.int64))],
                ["id", "version", "fp"],
            )

    return docs.mapInArrow(each, "id long, version long, fp long")


def stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least index reachable from each of ``n`` by the links ``a, b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def star_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between values, reduced to a star for each connected group."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = stars(inverse[: len(a)], inverse[len(a) :], len(nodes))
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def close_links(
    left: np.ndarray, right: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within the radius across two sides, or within one (``left is
    right``). Tiles too far apart in population count are skipped."""
    same = left is right
    left = _by_count(left)
    right = left if same else _by_count(right)
    ones_l, ones_r = (np.bitwise_count(v).astype(int) for v in (left, right))
    outs = [(left[:0], left[:0])]
    for i in range(0, len(left), TILE):
        x = left[i : i + TILE]
        low, high = ones_l[i], ones_l[i + len(x) - 1]
        for j in range(i if same else 0, len(right), TILE):
            y = right[j : j + TILE]
            if ones_r[j] - high > radius or low - ones_r[j + len(y) - 1] > radius:
                continue
            a, b = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
            if same and i == j:
                a, b = a[a < b], b[a < b]
            pair = x[a], y[b]
            outs.append(star_links(*pair) if len(a) > TILE else pair)
    return tuple(np.concatenate(side) for side in zip(*outs))


def _by_count(values: np.ndarray) -> np.ndarray:
    return values[np.argsort(np.bitwise_count(values), kind="stable")]


def _star_table(a: np.ndarray, b: np.ndarray) -> pa.Table:
    a, b = star_links(a, b)
    return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b`` links between distinct fingerprints ``fp`` that connect all within the radius."""
    spark = distinct.sparkSession
    width = -(-BITS // (radius + 1))
    bands = F.array(
        *[
            F.struct(
                F.lit(i).alias("band"),
                F.shiftrightunsigned("fp", i * width)
                .bitwiseAND(F.lit((1 << min(width, BITS - i * width)) - 1))
                .alias("value"),
            )
            for i in range(radius + 1)
        ]
    )
    split = distinct.select("fp", F.explode(bands).alias("k")).select("fp", "k.*")
    counted = split.groupBy("band", "value", F.bit_count("fp").alias("ones")).agg(
        F.count("*").alias("n")
    )
    sizes = counted.groupBy("band", "value").agg(
        F.sum("n").alias("total"),
        F.collect_list(F.struct("ones", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))).alias(
            "layers"
        ),
    )
    # At most one row for every ``GROUP`` fingerprints, with at most 65 layers.
    large = sizes.filter(F.col("total") > GROUP)
    small = split.join(large.select("band", "value"), ["band", "value"], "left_anti")

    def compare(table: pa.Table) -> pa.Table:
        value = table.column("value").to_numpy()
        band = table.column("band").to_numpy()
        fp = table.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((np.bitwise_count(fp), value, band))
        fp, value, band = fp[order], value[order], band[order]
        edge = np.flatnonzero(
            np.concatenate([[True], (value[1:] != value[:-1]) | (band[1:] != band[:-1]), [True]])
        )
        size = np.diff(edge)
        found = []
        # Band values with few fingerprints are compared together, neighbour by neighbour.
        few = np.repeat(size <= 64, size)
        group = np.repeat(np.arange(len(size)), size)
        for shift in range(1, int(size[size <= 64].max(initial=1))):
            x = np.flatnonzero(few[:-shift] & (group[:-shift] == group[shift:]))
            x = x[np.bitwise_count(fp[x] ^ fp[x + shift]) <= radius]
            found.append((fp[x], fp[x + shift]))
        for g in np.flatnonzero(size > 64):
            own = fp[edge[g] : edge[g + 1]]
            found.append(close_links(own, own, radius))
        if not found:
            found = [(fp[:0], fp[:0])]
        return _star_table(*(np.concatenate(c) for c in zip(*found)))

    task = F.pmod(F.xxhash64("band", "value"), F.lit(buckets(spark))).cast("int")
    near = small.groupBy(task.alias("task")).applyInArrow(compare, "a long, b long")

    # A tile is a population count and one of its parts; a job is a pair of tiles.
    part = F.pmod(F.xxhash64("fp"), F.col("own.tiles").cast("long")).cast("int")
    tiled = (
        split.join(large, ["band", "value"])
        .withColumn("ones", F.bit_count("fp").cast("int"))
        .withColumn("own", F.expr("filter(layers, l -> l.ones = ones)[0]"))
        .withColumn("part", part)
        .withColumn("other", F.explode("layers"))
        .filter(F.abs(F.col("other.ones") - F.col("ones")) <= radius)
        .withColumn("with", F.explode(F.expr("sequence(0, other.tiles - 1)")))
        .withColumn("here", F.struct("ones", "part"))
        .withColumn("there", F.struct(F.col("other.ones").alias("ones"), F.col("with").alias("part")))
        .select(
            "band",
            "value",
            F.least("here", "there").alias("low"),
            F.greatest("here", "there").alias("high"),
            (F.col("here") <= F.col("there")).alias("left"),
            "fp",
        )
    )

    def compare_tiles(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        left = table.column("left").to_numpy(zero_copy_only=False)
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        x = fp[left]
        return _star_table(*close_links(x, x if low == high else fp[~left], radius))

    far = tiled.groupBy("band", "value", "low", "high").applyInArrow(
        compare_tiles, "a long, b long"
    )
    return near.union(far)


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``id, version, fp, component`` of every row; the component is its least id."""
    store = stage(docs.sparkSession)
    rows = store.table(fingerprints(keyed(docs), shingle), "fingerprints")
    distinct = store.table(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), radius), store)
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    member = store.table(member, "member")
    least = member.groupBy("root").agg(F.min("least").alias("component"))
    named = store.table(member.join(least, "root").select("fp", "component"), "named")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    return grouped(docs, shingle, radius).select(
        doc_id("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        doc_id("component").alias("component_id"),
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs``, every column, with one row of each component: that of its least id."""
    best = grouped(docs, shingle, radius).groupBy("component").agg(
        F.min(F.struct("id", "version")).alias("k")
    )
    best = best.select(F.col("k.id").alias("_id"), F.col("k.version").alias("_version"))
    own = F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))
    repeated = repeats_ids(docs)
    version = version_of(docs) if repeated else F.lit(0).cast("long")
    same = (own == best["_id"]) & (version == best["_version"])
    if not repeated:
        return docs.join(best, same, "left_semi")
    # Rows that are alike in id and text are one document; one of them stays.
    rest = F.xxhash64(*[F.to_json(F.struct(docs[f"`{c}`"])) for c in docs.columns])
    order = Window.partitionBy("_id", "_version").orderBy(rest)
    kept = docs.join(best, same).withColumn("_place", F.row_number().over(order))
    return kept.filter("_place = 1").drop("_id", "_version", "_place")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
