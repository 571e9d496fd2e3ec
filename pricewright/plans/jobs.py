"""The jobs of the library, from source tables to results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import category, clean, encode, evaluate, facts
from ..operators.keys import SourceCounts
from ..sources import sinks
from ..sources.star import StarSchema
from ..stage import Stage
from . import presets, training

CURRENT = training.FeatureSet(tuple(schemas.NUMERIC), tuple(schemas.CATEGORICAL))
BASELINE = training.FeatureSet(
    tuple(schemas.BASELINE_NUMERIC), tuple(schemas.BASELINE_CATEGORICAL)
)


def prepare(star: StarSchema, stage: Stage) -> DataFrame:
    """Training table of the current model: 26 features, label and split.

    The wide join runs once and is written; medians, price bounds and encodings are then
    narrow column scans of that table. Each one-row statistic is written before its use.
    """
    stage = stage.sub("prepare")
    wide = stage.table(facts.build_facts(star, stage), "facts")
    medians = stage.table(clean.imputation_medians(clean.priced(wide)), "medians")
    engineered = clean.engineer(wide, medians)
    bounds = stage.table(clean.outlier_bounds(clean.complete_rows(engineered)), "bounds")
    rows = encode.with_split(clean.clean(engineered, bounds))
    encoded = encode.fit_encodings(rows, stage).apply(rows)
    return encoded.select("item_key", "split", "price", "label", *schemas.FEATURES)


def prepare_baseline(star: StarSchema, stage: Stage, trim: bool = True) -> DataFrame:
    """Training table of the older model (``trim``) or of the algorithm comparison."""
    stage = stage.sub("prepare_baseline")
    wide = stage.table(facts.build_core_facts(star, stage), "core_facts")
    means = stage.table(clean.full_category_means(wide), "category_means")
    engineered = clean.engineer_baseline(wide, means)
    bounds = None
    if trim:
        complete = clean.complete_baseline_rows(engineered)
        bounds = stage.table(clean.outlier_bounds(complete), "baseline_bounds")
    rows = encode.with_split(clean.clean_baseline(engineered, trim, bounds))
    return rows.select("item_key", "split", "price", "label", *schemas.BASELINE_FEATURES)


def prepare_counted(star: StarSchema, stage: Stage) -> tuple[DataFrame, dict[str, int]]:
    """The written training table of the current model, with the row count of every source table
    and of ``training_rows``, all taken from the jobs that write it."""
    stage, counts = stage.sub("counted"), SourceCounts()
    rows, written = stage.counted(prepare(counts.watch(star), stage), "training_rows")
    return rows, {**counts.rows(), "training_rows": written}


def prepare_baseline_counted(star: StarSchema, stage: Stage) -> tuple[DataFrame, dict[str, int]]:
    """As :func:`prepare_counted`, of the older model, which reads the four core tables."""
    stage, counts = stage.sub("counted"), SourceCounts()
    watched = counts.watch(star, schemas.CORE_TABLES)
    rows, written = stage.counted(prepare_baseline(watched, stage), "training_rows")
    return rows, {**counts.rows(), "training_rows": written}


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: DataFrame
    record: DataFrame
    search: training.Tuned
    #: Row count of every source table that was read, and of the training table.
    counts: dict[str, int]


def train(
    star: StarSchema,
    stage: Stage,
    space: dict = presets.SEARCH_SPACE,
    candidates: int = presets.SEARCH_CANDIDATES,
    model_path: str | None = None,
    result_path: str | None = None,
    folds: int = presets.FOLDS,
    parallelism: int = 2,
    scores_path: str | None = None,
) -> Trained:
    """Current model: prepare, search, evaluate, and write model and result when asked."""
    stage = stage.sub("train")
    rows, counts = prepare_counted(star, stage)
    search = training.tune(rows, CURRENT, space, candidates, folds, parallelism, scores_path)
    return _finish(rows, counts, search, CURRENT, stage, model_path, result_path)


def train_baseline(
    star: StarSchema,
    stage: Stage,
    space: dict = presets.BASELINE_SEARCH_SPACE,
    candidates: int = presets.BASELINE_SEARCH_CANDIDATES,
    model_path: str | None = None,
    result_path: str | None = None,
    folds: int = presets.FOLDS,
    parallelism: int = 2,
    scores_path: str | None = None,
) -> Trained:
    """Older model, trimmed prices and 20 features."""
    stage = stage.sub("train_baseline")
    rows, counts = prepare_baseline_counted(star, stage)
    search = training.tune(rows, BASELINE, space, candidates, folds, parallelism, scores_path)
    return _finish(rows, counts, search, BASELINE, stage, model_path, result_path)


def _finish(rows, counts, search, features, stage, model_path, result_path) -> Trained:
    metrics = stage.table(training.evaluate(rows, search.model), "metrics")
    current = features == CURRENT
    record = evaluate.result_record(
        metrics,
        "GBT",
        search.best_params,
        features.numeric,
        features.categorical,
        schemas.NEW_TABLES if current else (),
        leakage_fixed=current,
    )
    if model_path:
        sinks.save_model(search.model, model_path)
    if result_path:
        sinks.write_metrics(record, result_path)
    return Trained(search.model, metrics, record, search, counts)


def compare(
    rows: DataFrame, kinds: tuple[str, ...], sizes: dict[str, dict], results: str
) -> DataFrame:
    """Fit the named algorithms, write one record each below ``results``, and rank them."""
    for kind in kinds:
        name, full = presets.ALGORITHMS[kind]
        model = training.fit(rows, BASELINE, kind, **sizes.get(kind, full))
        record = evaluate.comparison_record(training.evaluate(rows, model), name)
        sinks.write_metrics(record, f"{results}/{kind}")
    return compare_results(rows.sparkSession, results, kinds)


def compare_results(spark: SparkSession, results: str, kinds: tuple[str, ...]) -> DataFrame:
    """Ranking of the records written by :func:`compare`."""
    return evaluate.comparison_table(sinks.read_metrics(spark, [f"{results}/{k}" for k in kinds]))


def categories(
    star: StarSchema, stage: Stage, seed_path: str | None = None, table_path: str | None = None
) -> DataFrame:
    """Category statistics, written as an SQL seed and into a table when asked."""
    stage = stage.sub("categories")
    stats = stage.table(category.category_stats(star, stage), "category_stats")
    if seed_path:
        sinks.write_seed(stats, seed_path)
    if table_path:
        sinks.insert_missing(stats, table_path)
    return stats
