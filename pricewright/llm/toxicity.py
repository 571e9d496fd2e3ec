"""Toxicity by a classifier chain.

Method: categories are predicted one after the other by logistic regressions over hashed word features;
each later model also sees the log odds that the earlier ones give. For training, those come from
out-of-fold models, so no model sees a prediction made with its own row; scoring uses models
fitted on all training rows. The categories are the label columns, in order; the last decides.

Features are the presence of lower-cased words and of their first four and six bytes (inflected
forms share beginnings), hashed to a fixed width. The models are fitted on at most about
``TRAIN_ROWS`` labelled documents, picked by a hash of the id; all documents are scored, whole. The
bounded training table is solved by one task: a distributed solver would send a gradient of the
full width through the driver for every step of every model.

Defined cases: null and empty texts have no features and get the prior odds; labels that are null in
any category, or whose document is missing, are not used; without any usable label, or with one class
only, probabilities are null for that category and nothing is rejected on it; repeated rows get
equal results; a null id is scored like any other; an empty table gives an empty result. Columns
other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import runs as R
from .tables import read, stage, text_of

CATEGORIES = ("quality", "toxic")
#: Bound on the labelled rows that the models are fitted on.
TRAIN_ROWS = 30_000
#: Hashed features.
WIDTH = 120_000
FOLDS = 3
#: Strength of the normal prior on the weights.
PENALTY = 0.3
#: Solver steps for the category that decides, and for the earlier ones, which only give it a feature.
STEPS, EARLIER_STEPS = 60, 20
#: Held-out rows of the sample data lose almost no clean document at this threshold.
THRESHOLD = 0.2
_PREFIXES = (4, 6)
_WORDS = 1 << 20
_FOLD = np.array(
    [
        c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c
        for c in range(256)
    ],
    np.uint8,
)


def features(text: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all features present in neighbouring texts, each once, in order."""
    text = _FOLD[text]
    starts, ends = R.word_bounds(text, edges)
    owner = np.searchsorted(edges, starts, side="right") - 1
    keys = [np.zeros(0, np.int64)]
    for at in range(0, len(starts), _WORDS):
        s, e = starts[at : at + _WORDS], ends[at : at + _WORDS]
        rows = owner[at : at + _WORDS] * WIDTH
        own = [R.word_hashes(text, s, e)]
        for size in _PREFIXES:
            own.append(R.mix(R.word_hashes(text, s, np.minimum(e, s + size)) + np.uint64(size)))
        found = [rows + (h % np.uint64(WIDTH)).astype(np.int64) for h in own]
        keys.append(np.unique(np.concatenate(found)))
    key = np.unique(np.concatenate(keys)) if len(keys) > 2 else keys[-1]
    return key // WIDTH, key % WIDTH


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, off = R.string_buffer(batch.column("text"))
    for i, j in R._groups(off):
        yield i, j, *features(data[off[i] : off[j]], off[i : j + 1] - off[i])


def _sparse(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``features``, the features of each row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for i, j, row, feature in _batches(batch):
                own = feature.astype(np.int32)
                lists += np.split(own, np.searchsorted(row, np.arange(1, j - i)))
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lists, pa.list_(pa.int32()))], [*keep, "features"]
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(each, f"{schema}, features array<int>")


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most about ``rows`` labelled documents: ``doc_id, fold, <categories>, text``.

    The picked labels are broadcast: ``rows`` of them at most, but for the chance of the hash. An id
    stands once, however often it is labelled (by the largest label of each category) or its
    text is given (by the least one in UTF-8).
    """
    usable = labels.select("doc_id", *CATEGORIES).dropna()
    share = min(1.0, rows / max(1, usable.select("doc_id").distinct().count()))
    place = F.xxhash64(F.lit("pick"), "doc_id").bitwiseAND(F.lit((1 << 31) - 1))
    picked = usable.filter(place < F.lit(int(share * (1 << 31))))
    picked = picked.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in CATEGORIES])
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    text = docs.select("doc_id", text_of(docs).alias("text"))
    # Copies of a document are combined before the texts are shuffled.
    text = text.join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi")
    text = text.groupBy("doc_id").agg(F.min("text").alias("text"))
    return text.join(F.broadcast(picked), "doc_id").withColumn("fold", fold)


class Chain:
    """Fitted weights of each category: (width + categories) each, and the intercept."""

    def __init__(self, weights: list[np.ndarray | None], intercepts: list[float]):
        self.weights, self.intercepts = weights, intercepts

    def odds(self, row: np.ndarray, feature: np.ndarray, n: int) -> list[np.ndarray | None]:
        """Log odds of each category for ``n`` rows of present features."""
        out: list[np.ndarray | None] = []
        for weights, intercept in zip(self.weights, self.intercepts):
            if weights is None:
                out.append(None)
                continue
            total = intercept + np.bincount(row, weights[feature], n)
            for i, earlier in enumerate(out):
                if earlier is not None:
                    total += weights[WIDTH + i] * earlier
            out.append(np.clip(total, -30, 30))
        return out


@dataclass
class Rows:
    """Training rows: present features, row after row, and the odds of earlier categories."""

    feature: np.ndarray
    ends: np.ndarray
    odds: np.ndarray  # rows x categories

    def take(self, keep: np.ndarray) -> Rows:
        size = np.diff(self.ends, prepend=0)
        place = R.spread((self.ends - size)[keep], size[keep])
        return Rows(self.feature[place], np.cumsum(size[keep]), self.odds[keep])

    def margins(self, weights: np.ndarray) -> np.ndarray:
        out = self.odds @ weights[WIDTH:-1] + weights[-1]
        for i, j, a, b in self._parts():
            sums = np.concatenate([[0.0], np.cumsum(weights[self.feature[a:b]])])
            out[i:j] += np.diff(sums[np.append(0, self.ends[i:j] - a)])
        return out

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        """Sum over the rows of ``slope`` times the row."""
        out = np.zeros(WIDTH + self.odds.shape[1] + 1)
        for i, j, a, b in self._parts():
            size = np.diff(self.ends[i:j], prepend=a)
            out[:WIDTH] += np.bincount(self.feature[a:b], np.repeat(slope[i:j], size), WIDTH)
        out[WIDTH:-1], out[-1] = slope @ self.odds, slope.sum()
        return out

    def _parts(self, rows: int = 2000) -> Iterator[tuple[int, int, int, int]]:
        for i in range(0, len(self.ends), rows):
            j = min(i + rows, len(self.ends))
            yield i, j, int(self.ends[i - 1]) if i else 0, int(self.ends[j - 1])


def solve(rows: Rows, label: np.ndarray, steps: int) -> np.ndarray:
    """Weights, odds' weights and intercept of a regression with a normal prior on the weights, by
    limited-memory quasi-Newton steps with backtracking."""
    n = len(label)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = rows.margins(x)
        value = (np.logaddexp(0, z) - label * z).mean() + PENALTY / n * (x[:-1] @ x[:-1]) / 2
        slope = rows.gradient((1 / (1 + np.exp(-z)) - label) / n)
        slope[:-1] += PENALTY / n * x[:-1]
        return value, slope

    x = np.zeros(WIDTH + rows.odds.shape[1] + 1)
    value, slope = loss(x)
    pairs: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=10)
    for _ in range(steps):
        way, shares = slope.copy(), []
        for s, y in reversed(pairs):
            shares.append((s @ way) / (s @ y))
            way -= shares[-1] * y
        if pairs:
            s, y = pairs[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), share in zip(pairs, reversed(shares)):
            way += (share - (y @ way) / (s @ y)) * s
        size, fall = 1.0, slope @ way
        while True:
            there = x - size * way
            next_value, next_slope = loss(there)
            if next_value <= value - 1e-4 * size * fall or size < 1e-6:
                break
            size /= 2
        s, y = there - x, next_slope - slope
        if s @ y > 1e-14:
            pairs.append((s, y))
        done = value - next_value < 1e-9
        x, value, slope = there, next_value, next_slope
        if done:
            break
    return x


def fit_rows(rows: Rows, labels: np.ndarray, fold: np.ndarray) -> list[np.ndarray | None]:
    """Weights of each category in turn; odds for later ones come from models of other folds."""
    out: list[np.ndarray | None] = []
    for c in range(labels.shape[1]):
        label = labels[:, c].astype(float)
        if len(np.unique(label)) < 2:
            out.append(None)
            continue
        last = c + 1 == labels.shape[1]
        out.append(solve(rows, label, STEPS if last else EARLIER_STEPS))
        if not last:
            odds = rows.odds.copy()
            for f in range(FOLDS):
                own, others = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                if len(own) and len(np.unique(label[others])) > 1:
                    model = solve(rows.take(others), label[others], EARLIER_STEPS)
                    odds[own, c] = np.clip(rows.take(own).margins(model), -30, 30)
            rows = Rows(rows.feature, rows.ends, odds)
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Chain:
    """Fit the chain on a bounded, written training table, in one task."""
    store = stage(docs.sparkSession)
    table = store.table(
        _sparse(training_rows(docs, labels, rows), ["doc_id", "fold", *CATEGORIES]), "train"
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [
            (
                b.column("features").flatten().to_numpy(),
                np.diff(b.column("features").offsets.to_numpy()),
                np.stack([b.column(c).to_numpy() for c in CATEGORIES], 1),
                b.column("fold").to_numpy(),
            )
            for b in batches
            if b.num_rows
        ]
        if parts:
            feature, size, label, fold = (np.concatenate(c) for c in zip(*parts))
            del parts
            own = Rows(feature, np.cumsum(size), np.zeros((len(size), len(CATEGORIES))))
            found = fit_rows(own, label, fold)
            blobs = [None if w is None else w.tobytes() for w in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(found)), pa.int32()), pa.array(blobs, pa.binary())],
                ["category", "weights"],
            )

    # One row for each category.
    ordered = table.coalesce(1).sortWithinPartitions("doc_id")
    found = ordered.mapInArrow(each, "category int, weights binary").collect()
    weights = {r.category: np.frombuffer(r.weights) for r in found if r.weights is not None}
    known = [weights.get(c) for c in range(len(CATEGORIES))]
    return Chain(
        [None if w is None else w[:-1] for w in known],
        [0.0 if w is None else float(w[-1]) for w in known],
    )


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, p_<category> ..., toxic, kept`` of every row."""
    names = [f"p_{c}" for c in CATEGORIES]
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                shared.value.odds(row, feature, j - i) for i, j, row, feature in _batches(batch)
            ]
            columns = []
            for c in range(len(CATEGORIES)):
                own = [p[c] for p in parts]
                if not own or own[0] is None:
                    columns.append(pa.nulls(batch.num_rows, pa.float64()))
                else:
                    columns.append(pa.array(1 / (1 + np.exp(-np.concatenate(own)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", *names]
            )

    schema = ", ".join(["doc_id long", *(f"{n} double" for n in names)])
    toxic = F.coalesce(F.col(names[-1]) >= threshold, F.lit(False))
    return rows.mapInArrow(each, schema).withColumn("toxic", toxic).withColumn("kept", ~toxic)


def without_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that are rejected; no shuffle, every column as it was."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    if chain.weights[-1] is None:
        return docs
    least = float(np.log(threshold / (1 - threshold)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = [
                shared.value.odds(row, feature, j - i)[-1]
                for i, j, row, feature in _batches(batch)
            ]
            keep = np.concatenate(odds) < least if odds else np.zeros(0, bool)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(each, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
