"""Quality rules by robust multivariate outliers.

Method: each document has a vector of transformed text statistics. For every language and source, a
minimum-covariance-determinant estimate finds the half to three quarters of its documents whose
covariance has the least determinant: from deterministic starts, concentration steps keep the
documents nearest by Mahalanobis distance and estimate again, until no determinant falls. A document
is rejected whose distance from its group's estimate, scaled to be consistent at the median, exceeds a
quantile of the chi-squared law.

A language and source with fewer than ``MIN_ROWS`` documents is judged by the estimate of its whole
language, and a language with fewer by that of all documents. These are more groups in the same
passes: a row stands once in its own group, and once in each wider group that some small one needs.

All groups go through a step together, in one pass over a slim written table: distances are counted in
bins per group, with the moments of each bin, so neither a group's rows nor its distances are ever
gathered, and a source that holds a third of all rows is combined before its shuffle.

Defined cases: null and empty texts have no words and fail the base rule; null language or source
is a value of its own; documents that fail the base rule take no part in the estimates; a table with fewer
than ``MIN_ROWS`` others has no estimate at all and rejects nothing; features that do not vary keep a
least spread; repeated rows count each; an empty table gives an empty result. Columns other than
``doc_id, text, lang, source`` are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..stage import Stage
from . import runs as R
from .tables import read, stage, text_of

SHARE = 0.75
MIN_ROWS = 50
#: A group's steps end where the logarithm of its determinant falls by no more than this.
LEAST_FALL = 1e-3
#: Chance of a document of the estimated law to be rejected.
CHANCE = 1e-9
REPEAT = 8
SYMBOLS = b"#*$%&|<>"
#: Least standard deviation of each feature, in its transformed unit.
FEATURES = {
    "log_words": 0.25,
    "log_word_length": 0.05,
    "root_symbol_rate": 0.04,
    "dup_line_share": 0.1,
    "repeat_share": 0.1,
}
#: Features are rounded to this grid, so sums of them and of their products are exact.
GRID = 256
_BIN = 16
_N = len(FEATURES)

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
_STAT_NAMES = [s.split()[0] for s in STATS.split(", ")]
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))


def _repeated(units: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the words inside windows of ``REPEAT`` words that occur twice or more in it."""
    n = len(bounds) - 1
    if len(units) < REPEAT:
        return np.zeros(n, np.int64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    grams = R.gram_hashes(units, REPEAT)
    at = np.flatnonzero(owner[: len(grams)] == owner[REPEAT - 1 :])
    key = grams[at] ^ R.mix(owner[at].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    near = np.flatnonzero((key[order[:-1]] == key[order[1:]]) & (owner[a] == owner[b]))
    a, b = a[near], b[near]
    same = np.ones(len(a), bool)
    for i in range(REPEAT):
        same &= units[a + i] == units[b + i]
    begins = np.unique(np.concatenate([a[same], b[same]]))
    cover = np.zeros(len(units) + 1, np.int64)
    cover[begins] += 1
    cover[begins + REPEAT] -= 1
    covered = np.cumsum(cover)[:-1] > 0
    return np.diff(np.concatenate([[0], np.cumsum(covered)])[bounds])


def text_statistics(text: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of neighbouring whole texts."""
    starts, ends = R.word_bounds(text, edges)
    bounds = np.searchsorted(starts, edges)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[edges])
    space = (text == 32) | ((text >= 9) & (text <= 13))
    lines, dups = [], []
    for a, b in zip(edges[:-1], edges[1:]):
        own = [x for x in text[a:b].tobytes().split(b"\n") if x.strip()]
        lines.append(len(own))
        dups.append(len(own) - len(set(own)))
    return {
        "n_words": np.diff(bounds),
        "word_chars": total(((text & 0xC0) != 0x80) & ~space),
        "n_symbols": total(_IS_SYMBOL[text]),
        "n_dup_lines": np.array(dups, np.int64),
        "n_repeat_words": _repeated(R.word_hashes(text, starts, ends), bounds),
        "n_lines": np.array(lines, np.int64),
    }


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the statistics of every row."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["lang"].cast("string").alias("lang"),
        docs["source"].cast("string").alias("source"),
        text_of(docs).alias("text"),
    )
    keep = ["doc_id", "lang", "source"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = R.string_buffer(batch.column("text"))
            for i, j in R._groups(off):
                found = text_statistics(data[off[i] : off[j]], off[i : j + 1] - off[i])
                own = [batch.column(c).slice(i, j - i) for c in keep]
                stats = [pa.array(found[s].astype(np.int64)) for s in _STAT_NAMES]
                yield pa.RecordBatch.from_arrays([*own, *stats], [*keep, *_STAT_NAMES])

    return rows.mapInArrow(each, f"doc_id long, lang string, source string, {STATS}")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _features() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = [
        F.log1p("n_words"),
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        F.col("n_repeat_words") / words,
    ]
    return [F.round(v * GRID) / GRID for v in values]


_X = [f"x{i}" for i in range(_N)]
_PAIRS = [(i, j) for i in range(_N) for j in range(i, _N)]
_GROUP = ["lang_key", "source_key"]
#: Stands for every language or source; keys of values begin with a plus or a minus.
_EVERY = "*"
LEVELS = ("source", "language", "all")


def _keys(df: DataFrame) -> DataFrame:
    """Null-safe group keys: a null stands apart from every value."""
    for name in ("lang", "source"):
        key = F.when(F.col(name).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), name))
        df = df.withColumn(f"{name}_key", key)
    return df


def _levels(rows: DataFrame, store: Stage) -> DataFrame:
    """For each language and source, ``level`` (of ``LEVELS``) of the estimate that judges it, and
    ``wider``, the levels beyond its own to which its rows contribute."""
    own = store.table(rows.groupBy(*_GROUP).count(), "groups")
    by_lang = own.groupBy("lang_key").agg(
        F.sum("count").alias("lang_count"), F.min("count").alias("least")
    )
    by_lang = store.table(by_lang, "languages")
    # Whether some language is too small: one row.
    scarce = bool(by_lang.filter(F.col("lang_count") < MIN_ROWS).head(1))
    enough, lang_enough = F.col("count") >= MIN_ROWS, F.col("lang_count") >= MIN_ROWS
    level = F.when(enough, 0).when(lang_enough, 1).otherwise(2)
    helps = lang_enough & (F.col("least") < MIN_ROWS)
    wider = F.array_compact(F.array(F.when(helps, 1), F.lit(2 if scarce else None).cast("int")))
    levels = own.join(by_lang, "lang_key").select(*_GROUP, level.alias("level"), wider.alias("wider"))
    return store.table(levels, "levels")


def _at_level(level: Column) -> list[Column]:
    """The group keys of a row at a level."""
    lang = F.when(level == 2, F.lit(_EVERY)).otherwise(F.col("lang_key"))
    source = F.when(level >= 1, F.lit(_EVERY)).otherwise(F.col("source_key"))
    return [lang.alias("lang_key"), source.alias("source_key")]


def _members(rows: DataFrame, levels: DataFrame) -> DataFrame:
    """One row for each document and group to whose estimate it contributes."""
    takes = F.when(F.col("level") == 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    joined = rows.join(levels, _GROUP).withColumn("at", F.explode(F.concat(takes, "wider")))
    return joined.select(*_at_level(F.col("at")), *_X)


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from ``center`` by the rows of ``inverse``."""
    off = [F.col(x) - F.col("center")[i] for i, x in enumerate(_X)]
    parts = [
        off[i] * off[j] * F.col("inverse")[i * _N + j] * (1 if i == j else 2) for i, j in _PAIRS
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.greatest(total, F.lit(0.0))


def chi_squared_quantile(tail: float) -> float:
    """Where the chi-squared law of five degrees, one for each feature, leaves ``tail`` above."""
    low, high = 0.0, 200.0
    for _ in range(100):
        x = (low + high) / 2
        above = math.erfc(math.sqrt(x / 2))
        above += math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
        low, high = (x, high) if above > tail else (low, x)
    return low


MEDIAN, CUT = chi_squared_quantile(0.5), chi_squared_quantile(CHANCE)
_FLOOR = np.array(list(FEATURES.values())) ** 2
_ESTIMATE = ", ".join(
    [
        "lang_key string, source_key string, start int, n long",
        "center array<double>, inverse array<double>, log_det double",
    ]
)


def _estimates(moments: DataFrame) -> DataFrame:
    """Centre, inverse covariance and determinant from ``n`` and the sums of x and of products."""

    def each(frames):
        for frame in frames:
            out = frame[[*_GROUP, "start", "n"]].copy()
            count = frame["kept"].to_numpy(float)
            mean = frame[[f"s{i}" for i in range(_N)]].to_numpy(float) / count[:, None]
            cov = np.zeros((len(frame), _N, _N))
            for i, j in _PAIRS:
                product = frame[f"p{i}_{j}"].to_numpy(float) / count
                cov[:, i, j] = cov[:, j, i] = product - mean[:, i] * mean[:, j]
            cov += np.diag(_FLOOR)
            out["center"] = list(mean)
            out["inverse"] = list(np.linalg.inv(cov).reshape(-1, _N * _N))
            out["log_det"] = np.linalg.slogdet(cov)[1]
            yield out

    return moments.mapInPandas(each, _ESTIMATE)


def _sums() -> list[Column]:
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)]
    return sums + [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p{i}_{j}") for i, j in _PAIRS]


def _starts(rows: DataFrame) -> DataFrame:
    """Start 0: all rows of the group. Start 1: medians and quartile spreads, no correlation."""
    every = rows.groupBy(*_GROUP).agg(
        F.count("*").alias("n"),
        *_sums(),
        *[F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, x in enumerate(_X)],
    ).filter(F.col("n") >= MIN_ROWS)
    plain = every.withColumn("kept", F.col("n")).withColumn("start", F.lit(0))
    robust = every.withColumn("kept", F.lit(1)).withColumn("start", F.lit(1))
    for i in range(_N):
        robust = robust.withColumn(f"s{i}", F.col(f"q{i}")[1])
    for i, j in _PAIRS:
        own = F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) if i == j else F.lit(0.0)
        robust = robust.withColumn(f"p{i}_{j}", F.col(f"q{i}")[1] * F.col(f"q{j}")[1] + own)
    names = [*_GROUP, "start", "n", "kept", *[f"s{i}" for i in range(_N)]]
    names += [f"p{i}_{j}" for i, j in _PAIRS]
    return _estimates(plain.select(*names).union(robust.select(*names)))


def _binned(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Counts and moments of each group's rows by bin of their distance."""
    place = F.floor(F.log2(_distance() + 2.0**-20) * _BIN).cast("int")
    joined = rows.join(estimates, _GROUP).withColumn("bin", place)
    return joined.groupBy(*_GROUP, "start", "n", "bin").agg(F.count("*").alias("kept"), *_sums())


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: the nearest ``SHARE`` of each group, whole bins, give the next estimate."""
    upto = Window.partitionBy(*_GROUP, "start").orderBy("bin")
    names = ["kept", *[f"s{i}" for i in range(_N)], *[f"p{i}_{j}" for i, j in _PAIRS]]
    sums = _binned(rows, estimates).select(
        *_GROUP, "start", "n", "bin", *[F.sum(c).over(upto).alias(c) for c in names]
    )
    first = Window.partitionBy(*_GROUP, "start").orderBy("bin")
    reached = sums.filter(F.col("kept") >= F.ceil(F.col("n") * SHARE))
    best = reached.withColumn("rank", F.row_number().over(first)).filter("rank = 1")
    return _estimates(best.select(*_GROUP, "start", "n", *names))


def _lower(now: DataFrame, found: DataFrame) -> DataFrame:
    """Each estimate, or the one of the next step where the determinant falls; ``falls`` says which."""
    key = [*_GROUP, "start"]
    values = ["center", "inverse", "log_det"]
    new = found.select(*key, *[F.col(v).alias(f"new_{v}") for v in values])
    falls = F.coalesce(F.col("new_log_det") < F.col("log_det") - LEAST_FALL, F.lit(False))
    best = [F.when(F.col("falls"), F.col(f"new_{v}")).otherwise(F.col(v)).alias(v) for v in values]
    joined = now.drop("falls").join(new, key, "left").withColumn("falls", falls)
    return joined.select(*key, "n", *best, "falls")


def estimates(rows: DataFrame, store: Stage) -> DataFrame:
    """``lang_key, source_key, center, inverse, scale``: the best estimate of each group.

    Steps go on for the groups and starts whose determinant fell. Each fall is to another set of
    rows and by more than ``LEAST_FALL``, and the least spreads bound the determinant from below.
    """
    start = store.table(_starts(rows), "start")
    now = _concentrate(rows, start).withColumn("falls", F.lit(True))
    now, step = store.table(now, "estimate-0"), 0
    while now.filter("falls").head(1):
        step += 1
        found = _concentrate(rows, now.filter("falls").drop("falls"))
        now = store.table(_lower(now, found), f"estimate-{step}")
    now = now.drop("falls")
    order = Window.partitionBy(*_GROUP).orderBy("log_det", "start")
    best = now.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank")
    best = store.table(best, "best")
    # The median distance over its value under the model makes the estimate consistent.
    upto = Window.partitionBy(*_GROUP).orderBy("bin")
    bins = _binned(rows, best).select(*_GROUP, "n", "bin", F.sum("kept").over(upto).alias("kept"))
    middle = bins.filter(2 * F.col("kept") >= F.col("n")).groupBy(*_GROUP).agg(
        F.min("bin").alias("bin")
    )
    scale = F.greatest(F.pow(2.0, (F.col("bin") + 1) / _BIN) / MEDIAN, F.lit(1.0))
    return store.table(
        best.join(middle, _GROUP).select(*_GROUP, "center", "inverse", scale.alias("scale")),
        "chosen",
    )


def judge(docs: DataFrame) -> DataFrame:
    """Statistics, ``base_failed``, ``judged_by`` (of ``LEVELS``) and ``distance`` (both null without an
    estimate) and ``kept`` of every row."""
    store = stage(docs.sparkSession)
    found = statistics(docs).withColumn("base_failed", base_failed())
    table = store.table(
        _keys(found).select("*", *[f.alias(x) for f, x in zip(_features(), _X)]), "statistics"
    )
    rows = table.filter(~F.col("base_failed")).select(*_GROUP, *_X)
    levels = _levels(rows, store)
    chosen = estimates(store.table(_members(rows, levels), "members"), store)
    chosen = chosen.withColumnsRenamed({"lang_key": "by_lang", "source_key": "by_source"})
    by_lang, by_source = _at_level(F.col("level"))
    name = F.array(*map(F.lit, LEVELS))[F.col("level")]
    verdicts = (
        levels.select(*_GROUP, name.alias("level_name"), by_lang.alias("by_lang"), by_source.alias("by_source"))
        .join(chosen, ["by_lang", "by_source"])
        .drop("by_lang", "by_source")
    )
    judged = ~F.col("base_failed")
    joined = (
        table.join(store.table(verdicts, "verdicts"), _GROUP, "left")
        .withColumn("distance", F.when(judged, _distance() / F.col("scale")))
        .withColumn("judged_by", F.when(judged, F.col("level_name")))
    )
    kept = judged & (F.coalesce("distance", F.lit(0.0)) <= CUT)
    joined = joined.withColumn("kept", kept)
    return joined.drop("center", "inverse", "scale", "level_name", *_GROUP, *_X)


def op9_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "judged_by",
    )
