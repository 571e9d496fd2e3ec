"""MLlib pipelines: one-hot encoding, estimators, random search and evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from ..functions.features import price_of
from ..operators.encode import fold, test_rows, train_rows
from ..operators.evaluate import regression_metrics
from ..stage import shared_dir
from . import presets
from .search import run_name, sample_candidates, search
from .trees import PackedBoosting, PackedForest, PackedTree


@dataclass(frozen=True)
class FeatureSet:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]

    def stages(self) -> list[Estimator]:
        """One-hot blocks behind the numeric columns.

        A level not seen in training takes the index that the encoder drops, so it becomes
        an all-zero block. A missing number is an error, not a silent zero.
        """
        indexed = [f"{c}__index" for c in self.categorical]
        encoded = [f"{c}__onehot" for c in self.categorical]
        assemble = VectorAssembler(
            inputCols=[*self.numeric, *encoded], outputCol="features", handleInvalid="error"
        )
        if not self.categorical:
            return [assemble]
        return [
            StringIndexer(inputCols=list(self.categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            assemble,
        ]


def _share(fraction: float) -> str:
    return "all" if fraction >= 1 else str(fraction)


def boosting_params(values: dict[str, float]) -> dict[str, object]:
    """Translate boosting parameter names to those of the MLlib learner."""
    translate = {
        "n_estimators": ("maxIter", int),
        "max_depth": ("maxDepth", int),
        "learning_rate": ("stepSize", float),
        "subsample": ("subsamplingRate", float),
        "colsample_bytree": ("featureSubsetStrategy", _share),
        "min_child_weight": ("minInstancesPerNode", int),
        "gamma": ("minInfoGain", float),
    }
    return {translate[k][0]: translate[k][1](v) for k, v in values.items()}


def estimator(kind: str, **values: float) -> Estimator:
    """A seeded regressor on the log price."""
    if kind == "linear":
        return LinearRegression(labelCol="label", regParam=0.0, **values)
    if kind == "tree":
        return PackedTree(
            labelCol="label", seed=presets.SEED, maxDepth=int(values["max_depth"])
        )
    if kind == "forest":
        return PackedForest(
            labelCol="label",
            seed=presets.SEED,
            numTrees=int(values["n_estimators"]),
            maxDepth=int(values["max_depth"]),
            featureSubsetStrategy="all",
        )
    if kind == "gbt":
        # Residuals depend on all earlier rounds: the checkpoint keeps that chain short.
        return PackedBoosting(
            labelCol="label",
            seed=presets.SEED,
            maxBins=256,
            checkpointInterval=10,
            **boosting_params(values),
        )
    raise ValueError(f"unknown model kind {kind!r}")


def fit(rows: DataFrame, features: FeatureSet, kind: str, **values: float) -> PipelineModel:
    """Fit one model on the training rows."""
    shared_dir(rows.sparkSession)
    return Pipeline(stages=[*features.stages(), estimator(kind, **values)]).fit(train_rows(rows))


def predict(rows: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(rows).withColumn("predicted_price", price_of(F.col("prediction")))


def evaluate(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Price-scale metrics on the test rows."""
    scored = predict(test_rows(rows), model).withColumn("actual_price", price_of(F.col("label")))
    return regression_metrics(scored, "actual_price", "predicted_price")


@dataclass(frozen=True)
class Tuned:
    model: PipelineModel
    best_params: dict[str, float]
    candidates: list[dict[str, float]]
    scores: list[float]
    #: Boosted chains fitted for the scores, and those whose scores were already written.
    fitted: int = 0
    reused: int = 0

    def summary(self, spark) -> DataFrame:
        """One row per candidate: parameters, mean fold R² on the log scale, and the winner."""
        rows = [
            (i, {k: float(v) for k, v in values.items()}, float(score), values == self.best_params)
            for i, (values, score) in enumerate(zip(self.candidates, self.scores))
        ]
        return spark.createDataFrame(
            rows, "candidate int, params map<string,double>, mean_r2 double, best boolean"
        )


def tune(
    rows: DataFrame,
    features: FeatureSet,
    space: dict[str, list[float]] = presets.SEARCH_SPACE,
    candidates: int = presets.SEARCH_CANDIDATES,
    folds: int = presets.FOLDS,
    parallelism: int = 2,
    scores_path: str | None = None,
) -> Tuned:
    """Seeded random search with cross-validation, best candidate refitted on all of train.

    Features are assembled once, before the folds, not once per candidate and fold. A level
    that one fold does not contain is a constant column there, which no tree can split on;
    only the columns a column sample may draw differ from an encoder fitted per fold.

    With ``scores_path`` every score is written there as soon as it is known, and a search that
    was stopped goes on; see :mod:`pricewright.plans.search`.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    train = train_rows(rows)
    encoder = Pipeline(stages=features.stages()).fit(train)
    coders = len(encoder.stages) - 1 and 1
    coded = PipelineModel(encoder.stages[:coders]).transform(train)
    indexed = [f"{c}__index" for c in features.categorical]
    # Columns are kept, a tenth of the vectors, which are built where they are scored.
    kept = coded.select(*features.numeric, *indexed, "label", fold(folds).alias("fold"))
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    assembled = PipelineModel(encoder.stages[coders:]).transform(kept)
    drawn = sample_candidates(space, candidates)
    used = [*features.numeric, *features.categorical]
    run = run_name(train.select("item_key", "label", *used), folds) if scores_path else ""
    try:
        found = search(
            assembled, drawn, folds, lambda c: estimator("gbt", **c), parallelism, scores_path, run
        )
        best = estimator("gbt", **drawn[found.best]).fit(assembled)
    finally:
        kept.unpersist()
    return Tuned(
        model=PipelineModel(stages=[*encoder.stages, best]),
        best_params=drawn[found.best],
        candidates=drawn,
        scores=found.scores,
        fitted=found.fitted,
        reused=found.reused,
    )
