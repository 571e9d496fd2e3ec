"""Regression trees, forests and boosting on packed rows. The models are those of MLlib.

MLlib keeps a binned row as one integer for each dimension of the feature vector and adds it, at every
level of every tree, to as many histograms: 700 to 900 bytes a row with one-hot blocks, which soon fill
the executors' memory and are then read from disk at every level. Here a row is one byte a column: the
bin of a number, or the place of the one in a one-hot block, since the rows of a dimension's zero are
those of the node less those of its one. Rules are MLlib's: candidate splits from the distribution of the
values, the gain of variance, which nodes become leaves, Poisson draws of a forest, and boosting on twice
the residual with a first tree of weight one. Candidates come from all rows rather than a draw of them.

A level of the trees is one job: tasks add their rows to histograms, which are summed and searched by
executors when they are large. Boosting on few rows (``ONE_TASK``) runs in one task, without a job a level.
"""

from __future__ import annotations

import json
import os
import pickle
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..stage import Stage

#: Rows of a block, which is what tasks work on, and at least so many in a task.
BLOCK_ROWS, TASK_ROWS = 1 << 16, 1 << 14
#: Up to so many rows boosting is one task; they take about 60 bytes each.
ONE_TASK = 1 << 20
#: Weighted values kept of a column while its candidate splits are looked for.
POINTS = 2048
#: Bytes of the histograms that one task fills, and of those of all tasks that the driver sums itself.
GROUP_BYTES, DIRECT_BYTES, CHUNK_BYTES = 64 << 20, 32 << 20, 4 << 20
#: Boosting rounds after which the residuals are written and their lineage is cut.
CHECKPOINT_ROUNDS = 10
EPSILON = float(np.finfo(float).eps)


# Columns: numbers, and blocks of dimensions of which at most one is one


@dataclass(frozen=True)
class Column:
    first: int
    #: Dimensions of a one-hot block; none for a number.
    levels: int = 0
    #: Dimensions of the same block that went to columns before, each of at most 255.
    before: int = 0
    #: The number or the index of the level, where the rows still have it.
    source: str | None = None


def columns_of(df: DataFrame, name: str) -> list[Column]:
    """The columns behind a feature vector, by the names of its dimensions."""
    known = df.schema[name].metadata.get("ml_attr", {})
    size, attrs = known.get("num_attrs"), known.get("attrs", {})
    names = {kind: {a["idx"]: a.get("name", "") for a in attrs[kind]} for kind in attrs}
    binary, numeric = names.get("binary", {}), names.get("numeric", {})
    for dims in names.values():
        size = max([size or 0, *[i + 1 for i in dims]])
    if size is None:
        first = df.select(F.size(vector_to_array(name)).alias("size")).first()
        size = first["size"] if first else 0
    found: list[Column] = []
    block = None
    for i in range(size):
        if i not in binary:
            block = None
            found.append(Column(i, source=_source(df, numeric.get(i, ""), False)))
            continue
        owner, mark, _ = binary[i].partition("__onehot_")
        if not mark or owner != block:
            found.append(Column(i, 1, 0, _source(df, f"{owner}__index", True) if mark else None))
        elif found[-1].levels < 255:
            found[-1] = replace(found[-1], levels=found[-1].levels + 1)
        else:
            found.append(replace(found[-1], first=i, levels=1, before=found[-1].before + 255))
        block = owner if mark else None
    return found


def _source(df: DataFrame, name: str, index: bool) -> str | None:
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.NumericType):
        return None
    nominal = df.schema[name].metadata.get("ml_attr", {}).get("type") == "nominal"
    return name if nominal == index else None


def _narrow(df: DataFrame, features: str, label: str, columns: list[Column]) -> DataFrame:
    """Label and one value a column: the number, or the place of the one in a block, from 1.

    Vectors are not built where the rows still have the columns that they come from.
    """
    label_ = F.col(label).cast("double").alias("label")
    if all(c.source for c in columns):
        values = []
        for c in columns:
            value = F.col(c.source)
            place = F.when(value.between(c.before, c.before + c.levels - 1), value - c.before + 1)
            values.append(place.otherwise(0).cast("short") if c.levels else value.cast("double"))
        return df.select(label_, *[v.alias(f"c{i}") for i, v in enumerate(values)])
    rows = df.select(label_, vector_to_array(features).alias("v"))
    values = [
        F.array_position(F.slice("v", c.first + 1, c.levels), F.lit(1.0)).cast("short")
        if c.levels
        else F.col("v")[c.first]
        for c in columns
    ]
    return rows.select("label", *[v.alias(f"c{i}") for i, v in enumerate(values)])


def _numpy(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column(i).to_numpy(zero_copy_only=False)


# Candidate splits


Points = tuple[np.ndarray, np.ndarray]


def _counted(values: np.ndarray) -> Points:
    """Sorted distinct values and how often each occurs."""
    values = np.sort(values)
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])
    return values[starts], np.diff(np.r_[starts, len(values)]).astype(float)


def _thinned(values: np.ndarray, weights: np.ndarray) -> Points:
    """Many sorted values become ``POINTS`` of about equal weight."""
    if len(values) <= 2 * POINTS:
        return values, weights
    ends = np.cumsum(weights)
    part = ((ends - weights / 2) * (POINTS / ends[-1])).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    last = np.r_[starts[1:], len(values)] - 1
    return values[last], np.add.reduceat(weights, starts)


def _joined(a: Points, b: Points) -> Points:
    values, weights = np.r_[a[0], b[0]], np.r_[a[1], b[1]]
    if not len(values):
        return a
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return _thinned(values[starts], np.add.reduceat(weights, starts))


def _merged(a: tuple[int, list[Points]], b: tuple[int, list[Points]]) -> tuple[int, list[Points]]:
    return a[0] + b[0], [_joined(x, y) for x, y in zip(a[1], b[1])]


def _distribution(numbers: list[int]) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.empty(0)
        seen = 0, [(empty, empty)] * len(numbers)
        held: list[pa.RecordBatch] = []

        def added():
            columns = [np.concatenate([_numpy(b, i) for b in held]) for i in numbers]
            rows = sum(b.num_rows for b in held)
            return _merged(seen, (rows, [_thinned(*_counted(c)) for c in columns]))

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                seen, held = added(), []
        if held:
            seen = added()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(seen)], pa.binary())], ["seen"])

    return of


def cut_points(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between at most ``bins`` bins: between all distinct values, or where the count of
    the rows is nearest to a multiple of a bin's share."""
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    stride = weights.sum() / bins
    target, found, upto = stride, [], np.cumsum(weights)
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append((values[i - 1] + values[i]) / 2)
            target += stride
    return np.array(found)


# Packed rows


def _packer(columns: list[Column], cuts: list[np.ndarray | None], size: int) -> Callable:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, rows = TaskContext.get().partitionId() << 24, [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            label = table.column(0).to_numpy()
            if np.isnan(label).any():
                raise ValueError("labels must not be null or NaN")
            codes = np.empty((len(columns), len(label)), np.uint8)
            for i, cut in enumerate(cuts):
                values = table.column(i + 1).to_numpy()
                if cut is not None and np.isnan(values).any():
                    raise ValueError("features must not be null or NaN")
                codes[i] = values if cut is None else np.searchsorted(cut, values)
            data = pickle.dumps((codes, label))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([data], pa.binary())], ["number", "data"]
            )

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - rows)
                held.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == size:
                    yield block()
                    number, held, rows = number + 1, [], 0
        if rows:
            yield block()

    return packed


#: Number, codes by column and row, and label or residual of each row.
Block = tuple[int, np.ndarray, np.ndarray]


def _one_by_one(rdd: RDD) -> RDD:
    """Elements are blocks: one a batch, so that two tables of them are paired as they lie."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


@dataclass
class Packed:
    """Training rows in blocks below a folder of their own."""

    stage: Stage
    shape: Shape
    rows: int
    table: DataFrame

    def blocks(self) -> RDD:
        loaded = self.table.rdd.map(lambda r: (r["number"], *pickle.loads(r["data"])))
        return _one_by_one(loaded)


def _with_package(spark: SparkSession) -> None:
    """Put this package on the path of the Python workers that the session starts."""
    environment = spark.sparkContext.environment
    home = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, *paths]))


def pack(df: DataFrame, features: str, label: str, bins: int) -> Packed:
    spark = df.sparkSession
    _with_package(spark)
    columns = columns_of(df, features)
    narrow = _narrow(df, features, label, columns)
    numbers = [i for i, c in enumerate(columns) if not c.levels]
    found = narrow.mapInArrow(_distribution([i + 1 for i in numbers]), "seen binary")
    rows, points = found.rdd.map(lambda r: pickle.loads(r["seen"])).treeReduce(_merged)
    if not rows:
        raise ValueError("no rows to fit a model on")
    cuts: list[np.ndarray | None] = [None] * len(columns)
    for i, (values, weights) in zip(numbers, points):
        cuts[i] = cut_points(values, weights, min(bins, rows))
    tasks = spark.sparkContext.defaultParallelism
    tasks = max(1, min(tasks, rows // TASK_ROWS))
    size = min(BLOCK_ROWS, -(-rows // tasks))
    blocks = narrow.mapInArrow(_packer(columns, cuts, size), "number long, data binary")
    if blocks.rdd.getNumPartitions() < tasks:
        blocks = blocks.repartition(tasks)
    stage = Stage(spark)
    return Packed(stage, Shape(columns, cuts), rows, stage.table(blocks, "blocks"))


class Shape:
    """Widths of the histograms, and the splits that they decide between."""

    def __init__(self, columns: list[Column], cuts: list[np.ndarray | None]):
        self.columns = columns
        self.widths = [
            c.levels + 1 if cut is None else len(cut) + 1 for c, cut in zip(columns, cuts)
        ]
        self.offsets = np.r_[0, np.cumsum(self.widths)].astype(int)
        self.width = int(self.offsets[-1])
        self.dims = sum(c.levels or 1 for c in columns)
        dim, threshold, column, low, high = [], [], [], [], []
        for i, (c, cut) in enumerate(zip(columns, cuts)):
            if cut is None:
                dim += range(c.first, c.first + c.levels)
                threshold += [np.nan] * c.levels
                low += range(1, c.levels + 1)
                high += range(1, c.levels + 1)
            else:
                dim += [c.first] * len(cut)
                threshold += cut.tolist()
                low += range(1, len(cut) + 1)
                high += [255] * len(cut)
            column += [i] * (len(dim) - len(column))
        #: Of each split: its dimension, threshold (none for a one-hot one), column, and the codes
        #: from low to high that it sends one way, the hits.
        self.dim, self.threshold = np.array(dim, int), np.array(threshold, float)
        self.column = np.array(column, int)
        self.low, self.high = np.array(low, np.int16), np.array(high, np.int16)


# Trees


@dataclass(frozen=True)
class Rules:
    depth: int
    min_instances: int
    min_gain: float
    #: Dimensions drawn for each node.
    subset: int
    seed: int
    #: Draws of the rows: by Poisson counts, by chance, or all.
    draw: str = "all"
    share: float = 1.0


#: Rows, sum and squares of a node, its best split or -1, the gain, and the same sums of the hits.
N, S, Q, SPLIT, GAIN, HIT_N, HIT_S, HIT_Q = range(8)


@dataclass
class Tree:
    """Nodes in the order of their making. The second child of a split is that of its hits."""

    column: list[int] = field(default_factory=lambda: [0])
    low: list[int] = field(default_factory=lambda: [256])
    high: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    split: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    sums: list[tuple[float, float, float]] = field(default_factory=lambda: [(0.0, 0.0, 0.0)])

    def grow(self, shape: Shape, node: int, at: int, gain: float, hits: tuple) -> list[int]:
        new = len(self.child)
        self.column[node], self.split[node] = int(shape.column[at]), at
        self.low[node], self.high[node] = int(shape.low[at]), int(shape.high[at])
        self.gain[node], self.child[node] = gain, new
        others = tuple(a - b for a, b in zip(self.sums[node], hits))
        for i, sums in enumerate((others, hits)):
            self.column.append(0)
            self.low.append(256)
            self.high.append(0)
            self.child.append(new + i)
            self.split.append(-1)
            self.gain.append(-1.0)
            self.sums.append(sums)
        return [new, new + 1]

    def route(self) -> Route:
        return Route(
            np.array(self.column, np.intp),
            np.array(self.low, np.int16),
            np.array(self.high, np.int16),
            np.array(self.child, np.intp),
        )

    def predictions(self) -> np.ndarray:
        return np.array([s / n if n else 0.0 for n, s, _ in self.sums])


@dataclass(frozen=True)
class Route:
    """What leads a row through a tree; a leaf is its own child and has no hits."""

    column: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray

    def step(self, codes: np.ndarray, node: np.ndarray) -> np.ndarray:
        at = self.column.take(node)
        at *= codes.shape[1]
        at += np.arange(codes.shape[1])
        code = codes.reshape(-1).take(at)
        hit = code >= self.low.take(node)
        hit &= code <= self.high.take(node)
        node = self.child.take(node)
        node += hit
        return node

    def nodes(self, codes: np.ndarray, steps: int) -> np.ndarray:
        node = np.zeros(codes.shape[1], np.intp)
        for _ in range(steps):
            node = self.step(codes, node)
        return node


_COUNTS = np.arange(1, 16)
_POISSON = np.searchsorted(
    np.exp(-1) * np.cumsum(1 / np.r_[1, np.cumprod(_COUNTS, dtype=float)]),
    (np.arange(1 << 16) + 0.5) / (1 << 16),
).astype(float)


def _weights(rules: Rules, tree: int, block: int, rows: int) -> np.ndarray | None:
    """How often each row of a block is drawn for a tree: the same whenever it is asked."""
    if rules.draw == "all":
        return None
    random = np.random.default_rng([rules.seed & (1 << 63) - 1, tree, block])
    if rules.draw == "poisson":
        return _POISSON.take(random.integers(0, 1 << 16, rows, np.uint16))
    return (random.random(rows) < rules.share).astype(float)


def _add(
    into: np.ndarray,
    totals: np.ndarray,
    shape: Shape,
    codes: np.ndarray,
    target: np.ndarray,
    slot: np.ndarray,
    weight: np.ndarray | None,
) -> None:
    """Add rows to the histograms (slot, sum, bin) and sums of the slots; the slot behind the last one
    takes the others."""
    slots, sums, _ = into.shape
    used = slot < slots if weight is None else (slot < slots) & (weight > 0)
    if np.count_nonzero(used) < 0.7 * len(slot):
        keep = np.flatnonzero(used)
        codes, target, slot = codes[:, keep], target.take(keep), slot.take(keep)
        weight = None if weight is None else weight.take(keep)
    sum_ = target if weight is None else target * weight
    given = [weight, sum_, sum_ * target]
    for i, values in enumerate(given):
        totals[:, i] += np.bincount(slot, values, slots + 1)[:slots]
    at = np.empty_like(slot)
    for i, (width, first) in enumerate(zip(shape.widths, shape.offsets)):
        np.multiply(slot, width, out=at)
        np.add(at, codes[i], out=at)
        for k in range(sums):
            found = np.bincount(at, given[k], (slots + 1) * width)[: slots * width]
            into[:, k, first : first + width] += found.reshape(slots, width)


def _best(
    shape: Shape, rules: Rules, hist: np.ndarray, totals: np.ndarray, nodes: list[tuple[int, int]]
) -> np.ndarray:
    """Sums and best split of each slot; ``nodes`` are their trees and nodes."""
    slots, sums, _ = hist.shape
    result = np.full((slots, 8), np.nan)
    result[:, : Q + 1], result[:, SPLIT] = totals, -1
    splits = len(shape.dim)
    if not splits:
        return result
    step = max(1, (8 << 20) // (8 * splits))
    for a in range(0, slots, step):
        part = hist[a : a + step]
        hits = np.empty((len(part), sums, splits))
        at = 0
        for c, first, width in zip(shape.columns, shape.offsets, shape.widths):
            if c.levels:
                hits[:, :, at : at + width - 1] = part[:, :, first + 1 : first + width]
            else:
                # Those above each threshold.
                tail = part[:, :, first + 1 : first + width][:, :, ::-1].cumsum(axis=2)
                hits[:, :, at : at + width - 1] = tail[:, :, ::-1]
            at += width - 1
        n, s, q = (totals[a : a + step, i, None] for i in (N, S, Q))
        hit_n, rest_n = hits[:, 0], n - hits[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = s / n
            spread = q / n - mean * mean
            gain = hit_n * mean
            np.subtract(hits[:, 1], gain, out=gain)
            gain *= gain
            gain /= hit_n * rest_n
        gain[np.minimum(hit_n, rest_n) < max(rules.min_instances, EPSILON)] = -1
        if rules.subset < shape.dims:
            for i, key in enumerate(nodes[a : a + step]):
                random = np.random.default_rng([rules.seed & (1 << 63) - 1, 1 << 32, *key])
                drawn = np.zeros(shape.dims, bool)
                drawn[random.permutation(shape.dims)[: rules.subset]] = True
                gain[i, ~drawn[shape.dim]] = -1
        best = gain.argmax(axis=1)
        line = np.arange(len(part))
        most = gain[line, best]
        # A gain that is within rounding is none.
        floor = np.maximum(EPSILON * (np.abs(spread) + mean * mean)[:, 0], 0)
        good = (most > floor) & (most >= rules.min_gain) & (spread[:, 0] >= EPSILON)
        rows = result[a : a + step]
        rows[good, SPLIT], rows[good, GAIN] = best[good], most[good]
        for k in range(sums):
            rows[good, HIT_N + k] = hits[line, k, best][good]
    return result


#: For the trees, their nodes of a level and whether it is the last: sums and best splits in that order.
Measure = Callable[[list[Tree], list[list[int]], int], np.ndarray]


def grow(shape: Shape, rules: Rules, number: int, measure: Measure) -> list[Tree]:
    trees = [Tree() for _ in range(number)]
    active = [[0] for _ in trees]
    for level in range(max(rules.depth, 1)):
        found = iter(measure(trees, active, level))
        below: list[list[int]] = []
        for tree, nodes in zip(trees, active):
            below.append([])
            for node, row in zip(nodes, found):
                tree.sums[node] = tuple(row[: Q + 1].tolist())
                if row[SPLIT] >= 0 and rules.depth:
                    hits = tuple(row[HIT_N:].tolist())
                    below[-1] += tree.grow(shape, node, int(row[SPLIT]), float(row[GAIN]), hits)
        active = below
        if not any(active):
            break
    return trees


def _slots(tree: Tree, nodes: list[int]) -> np.ndarray:
    found = np.full(len(tree.child), len(nodes), np.intp)
    found[nodes] = np.arange(len(nodes))
    return found


def _sums(rules: Rules, level: int) -> int:
    """Histograms hold squares at the last level only, for the leaves below it."""
    return 3 if level >= rules.depth - 1 else 2


def _in_task(block: Block, shape: Shape, rules: Rules) -> tuple[Tree, np.ndarray]:
    """A tree on one block, and the leaf of each row."""
    number, codes, target = block
    weight = _weights(rules, 0, number, len(target))
    at = {"node": np.zeros(len(target), np.intp)}

    def measure(trees: list[Tree], active: list[list[int]], level: int) -> np.ndarray:
        if level:
            at["node"] = trees[0].route().step(codes, at["node"])
        nodes = active[0]
        hist = np.zeros((len(nodes), _sums(rules, level), shape.width))
        totals = np.zeros((len(nodes), 3))
        slot = _slots(trees[0], nodes).take(at["node"])
        _add(hist, totals, shape, codes, target, slot, weight)
        return _best(shape, rules, hist, totals, [(0, n) for n in nodes])

    (tree,) = grow(shape, rules, 1, measure)
    return tree, tree.route().step(codes, at["node"])


def _in_jobs(rows: RDD, shape: Shape, rules: Rules) -> Measure:
    """One job a level, or several when its histograms are too large for a task."""
    parts = rows.getNumPartitions()
    tasks = max(1, min(parts, rows.context.defaultParallelism))

    def measure(trees: list[Tree], active: list[list[int]], level: int) -> np.ndarray:
        sums = _sums(rules, level)
        size = 8 * (sums * shape.width + 3)
        most = max(1, GROUP_BYTES // size)
        keys = [(t, n) for t, nodes in enumerate(active) for n in nodes]
        found = []
        for a in range(0, len(keys), most):
            found.append(_job(trees, keys[a : a + most], level, sums, size))
        return np.concatenate(found)

    def _job(trees, keys, level, sums, size) -> np.ndarray:
        plan, first = [], 0
        for t in sorted({t for t, _ in keys}):
            nodes = [n for u, n in keys if u == t]
            plan.append((t, trees[t].route(), _slots(trees[t], nodes), first, len(nodes)))
            first += len(nodes)
        slots = first

        def filled(blocks: Iterator[Block]) -> tuple[np.ndarray, np.ndarray]:
            hist, totals = np.zeros((slots, sums, shape.width)), np.zeros((slots, 3))
            for number, codes, target in blocks:
                for t, route, slot_of, a, n in plan:
                    slot = slot_of.take(route.nodes(codes, level))
                    weight = _weights(rules, t, number, len(target))
                    _add(hist[a : a + n], totals[a : a + n], shape, codes, target, slot, weight)
            return hist, totals

        if slots * size * parts <= DIRECT_BYTES:
            hist, totals = np.zeros((slots, sums, shape.width)), np.zeros((slots, 3))
            for h, t in rows.mapPartitions(lambda blocks: [filled(blocks)]).collect():
                hist += h
                totals += t
            return _best(shape, rules, hist, totals, keys)
        step = max(1, min(CHUNK_BYTES // size, -(-slots // tasks)))

        def chunks(blocks: Iterator[Block]):
            hist, totals = filled(blocks)
            for a in range(0, slots, step):
                yield a, (hist[a : a + step], totals[a : a + step])

        def best(item):
            a, (hist, totals) = item
            return a, _best(shape, rules, hist, totals, keys[a : a + step])

        summed = rows.mapPartitions(chunks).reduceByKey(
            lambda x, y: (x[0] + y[0], x[1] + y[1]), tasks
        )
        return np.concatenate([r for _, r in sorted(summed.map(best).collect(), key=lambda x: x[0])])

    return measure


# Boosting


@dataclass(frozen=True)
class Boosting:
    rounds: int
    rate: float

    def weight(self, tree: int) -> float:
        return self.rate if tree else 1.0


def _next_target(target: np.ndarray, guess: np.ndarray, tree: int, plan: Boosting) -> np.ndarray:
    """Twice the residual, behind a first tree that is fitted to the label itself."""
    if not tree:
        return 2 * (target - guess)
    return target - 2 * plan.weight(tree) * guess


def _of_round(rules: Rules, tree: int) -> Rules:
    return replace(rules, seed=rules.seed + tree)


def _boost_in_task(shape: Shape, rules: Rules, plan: Boosting) -> Callable:
    def boosted(blocks: Iterator[Block]) -> Iterator[Tree]:
        found = sorted(blocks, key=lambda b: b[0])
        if not found:
            return
        codes = np.concatenate([b[1] for b in found], axis=1)
        target = np.concatenate([b[2] for b in found])
        del found
        for i in range(plan.rounds):
            tree, leaf = _in_task((0, codes, target), shape, _of_round(rules, i))
            target = _next_target(target, tree.predictions().take(leaf), i, plan)
            yield tree

    return boosted


def _boost_in_jobs(blocks: RDD, shape: Shape, rules: Rules, plan: Boosting) -> list[Tree]:
    context = blocks.context
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    targets, old, trees = blocks.map(lambda b: b[2]), None, []
    targets = _one_by_one(targets).persist(StorageLevel.MEMORY_AND_DISK)
    written: list[RDD] = []
    try:
        for i in range(plan.rounds):
            rows = blocks.zip(targets).map(lambda pair: (*pair[0][:2], pair[1]))
            of_round = _of_round(rules, i)
            trees += grow(shape, of_round, 1, _in_jobs(rows, shape, of_round))
            if old is not None:
                old.unpersist()
            for gone in written[:-1]:
                _forget(gone)
            written = written[-1:]
            if i + 1 == plan.rounds:
                break
            after = _after(rows, trees[-1], i, plan, rules.depth)
            old, targets = targets, after.persist(StorageLevel.MEMORY_AND_DISK)
            if (i + 1) % CHECKPOINT_ROUNDS == 0 and context.getCheckpointDir():
                targets.checkpoint()
                written.append(targets)
    finally:
        for rdd in (blocks, targets, old):
            if rdd is not None:
                rdd.unpersist()
        for gone in written:
            _forget(gone)
    return trees


def _after(rows: RDD, tree: Tree, i: int, plan: Boosting, depth: int) -> RDD:
    route, guess = tree.route(), tree.predictions()

    def target(block: Block) -> np.ndarray:
        _, codes, target = block
        return _next_target(target, guess.take(route.nodes(codes, depth)), i, plan)

    return _one_by_one(rows.map(target))


def _forget(rdd: RDD) -> None:
    """Delete the files of a checkpoint that nothing reads any more."""
    name = rdd.getCheckpointFile()
    if name:
        path = rdd.context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(rdd.context._jsc.hadoopConfiguration()).delete(path, True)


# Models


_NODE = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
    "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold "
    "array<double>, numCategories int>"
)


def _node_rows(tree: Tree, shape: Shape) -> list[tuple]:
    """Nodes as MLlib writes them; a split whose two leaves predict the same becomes a leaf."""
    guess = tree.predictions().tolist()
    leaf = [at < 0 for at in tree.split]
    for node in range(len(leaf) - 1, -1, -1):
        if not leaf[node]:
            a, b = tree.child[node], tree.child[node] + 1
            leaf[node] = leaf[a] and leaf[b] and guess[a] == guess[b]
    place, order = {0: 0}, [0]
    for node in order:
        if not leaf[node]:
            for child in (tree.child[node], tree.child[node] + 1):
                place[child] = len(order)
                order.append(child)
    rows = []
    for node in order:
        n, s, q = tree.sums[node]
        impurity = max(q / n - (s / n) ** 2, 0.0) if n else 0.0
        kept = place[node], guess[node], impurity, [n, s, q], round(n)
        if leaf[node]:
            rows.append((*kept, -1.0, -1, -1, (-1, [], -1)))
            continue
        at, (rest, hit) = tree.split[node], (tree.child[node], tree.child[node] + 1)
        dim, threshold = int(shape.dim[at]), float(shape.threshold[at])
        if threshold == threshold:
            split, left, right = (dim, [threshold], -1), rest, hit
        elif guess[hit] < guess[rest]:
            split, left, right = (dim, [1.0], 2), hit, rest
        else:
            split, left, right = (dim, [0.0], 2), rest, hit
        rows.append((*kept, tree.gain[node], place[left], place[right], split))
    return rows


def _params(estimator, kind: str, uid: str, values: dict | None = None, **more) -> str:
    given = {p.name: v for p, v in estimator._paramMap.items()} if values is None else values
    return json.dumps(
        {
            "class": f"org.apache.spark.ml.regression.{kind}",
            "timestamp": int(time.time() * 1000),
            "sparkVersion": SparkSession.active().version,
            "uid": uid,
            "paramMap": given,
            "defaultParamMap": {
                p.name: v for p, v in estimator._defaultParamMap.items() if values is None
            },
            **more,
        }
    )


def _model(estimator, packed: Packed, trees: list[Tree], weights: list[float] | None, reader):
    """The fitted model, by way of the files in which MLlib keeps one."""
    spark, folder, dims = packed.stage.spark, packed.stage.path("model"), packed.shape.dims
    more = {"numFeatures": dims} | ({"numTrees": len(trees)} if weights else {})
    text = _params(estimator, reader.__name__, estimator.uid, **more)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/metadata")
    if weights:
        single = DecisionTreeRegressor()
        known = {p.name for p in single.params}
        shared = {p.name: v for p, v in estimator._paramMap.items() if p.name in known}
        kind = DecisionTreeRegressionModel.__name__
        heads = [
            (i, _params(single, kind, f"{estimator.uid}_{i}", shared, numFeatures=dims), float(w))
            for i, w in enumerate(weights)
        ]
        spark.createDataFrame(heads, "_1 int, _2 string, _3 double").write.parquet(
            f"{folder}/treesMetadata"
        )
        rows = [(i, r) for i, tree in enumerate(trees) for r in _node_rows(tree, packed.shape)]
        schema = f"treeID int, nodeData struct<{_NODE}>"
        nodes = spark.createDataFrame(rows, schema)
    else:
        nodes = spark.createDataFrame(_node_rows(trees[0], packed.shape), _NODE)
    nodes.write.parquet(f"{folder}/data")
    return reader.load(folder)


def _rules(estimator, dims: int, subset: str = "all", **more) -> Rules:
    return Rules(
        depth=estimator.getMaxDepth(),
        min_instances=estimator.getMinInstancesPerNode(),
        min_gain=estimator.getMinInfoGain(),
        subset=dims if subset == "all" else -int(-float(subset) * dims // 1),
        seed=estimator.getSeed(),
        **more,
    )


def _packed(estimator, dataset: DataFrame) -> Packed:
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    return pack(dataset, features, label, estimator.getMaxBins())


def _forest(estimator, dataset: DataFrame, number: int, subset: str, reader, **draw):
    packed = _packed(estimator, dataset)
    blocks = packed.blocks().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rules = _rules(estimator, packed.shape.dims, subset, **draw)
        trees = grow(packed.shape, rules, number, _in_jobs(blocks, packed.shape, rules))
        weights = [1.0] * number if reader is RandomForestRegressionModel else None
        return _model(estimator, packed, trees, weights, reader)
    finally:
        blocks.unpersist()
        packed.stage.remove()


class PackedTree(DecisionTreeRegressor):
    def _fit(self, dataset: DataFrame) -> DecisionTreeRegressionModel:
        return _forest(self, dataset, 1, "all", DecisionTreeRegressionModel)


class PackedForest(RandomForestRegressor):
    """Every row is drawn for each tree by a Poisson count, as with a bootstrap of the full size."""

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        number, subset = self.getNumTrees(), self.getFeatureSubsetStrategy()
        draw = {"draw": "poisson"} if number > 1 else {}
        return _forest(self, dataset, number, subset, RandomForestRegressionModel, **draw)


class PackedBoosting(GBTRegressor):
    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        packed = _packed(self, dataset)
        share, plan = self.getSubsamplingRate(), Boosting(self.getMaxIter(), self.getStepSize())
        draw = {"draw": "chance", "share": share} if share < 1 else {}
        shape = packed.shape
        rules = _rules(self, shape.dims, self.getFeatureSubsetStrategy(), **draw)
        try:
            blocks = packed.blocks()
            if packed.rows <= ONE_TASK:
                in_task = _boost_in_task(shape, rules, plan)
                trees = blocks.repartition(1).mapPartitions(in_task).collect()
            else:
                trees = _boost_in_jobs(blocks, shape, rules, plan)
            weights = [plan.weight(i) for i in range(plan.rounds)]
            return _model(self, packed, trees, weights, GBTRegressionModel)
        finally:
            packed.stage.remove()
