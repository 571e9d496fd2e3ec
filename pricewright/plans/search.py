"""Random search over boosting parameters by staged prefixes.

The first k trees of a boosted chain are the model of k rounds. So candidates that differ in the number
of rounds only share one chain, fitted with the most rounds any of them asks for, and each is scored from
the chain's cumulated tree predictions, all prefixes in one pass over the validation rows.

Each scored (chain, fold) is written at once. A search that was stopped and is started again with the
same rows, seed and folds goes on with what is missing.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from . import presets

ROUNDS = "n_estimators"
Candidate = dict[str, float]
SCORES = "run string, chain string, fold int, rounds int, r2 double"


def sample_candidates(
    space: dict[str, list[float]], n: int, seed: int = presets.SEED
) -> list[Candidate]:
    """``n`` different parameter combinations, the same for the same seed."""
    size = 1
    for choices in space.values():
        size *= len(choices)
    drawn = []
    for position in random.Random(seed).sample(range(size), min(n, size)):
        combination = {}
        for name, choices in space.items():
            position, pick = divmod(position, len(choices))
            combination[name] = choices[pick]
        drawn.append(combination)
    return drawn


@dataclass(frozen=True)
class Chain:
    """Candidates that differ in the number of rounds only."""

    params: tuple[tuple[str, float], ...]
    rounds: tuple[int, ...]

    @property
    def name(self) -> str:
        text = json.dumps([[k, float(v)] for k, v in self.params])
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    def longest(self) -> Candidate:
        return {**dict(self.params), ROUNDS: max(self.rounds)}


def chain_of(candidate: Candidate) -> tuple[tuple[str, float], ...]:
    return tuple(sorted((k, v) for k, v in candidate.items() if k != ROUNDS))


def chains(candidates: list[Candidate]) -> list[Chain]:
    """The chains of the candidates, longest first, so that none is left to wait for at the end."""
    rounds: dict[tuple, set[int]] = {}
    for candidate in candidates:
        rounds.setdefault(chain_of(candidate), set()).add(int(candidate[ROUNDS]))
    found = [Chain(params, tuple(sorted(asked))) for params, asked in rounds.items()]
    return sorted(found, key=lambda c: (-max(c.rounds), c.name))


def prefix_scores(model: GBTRegressionModel, rows: DataFrame, rounds: tuple[int, ...]) -> list[float]:
    """R² on ``rows`` of the model's first k trees, for each k."""
    losses = model.evaluateEachIteration(rows, "squared")
    spread = rows.agg(F.var_pop("label")).first()[0]
    return [1 - losses[k - 1] / spread if spread else math.nan for k in rounds]


class Scores:
    """The written (chain, fold, rounds, score) table of a search."""

    def __init__(self, spark: SparkSession, path: str | None, run: str):
        self.spark, self.path, self.run = spark, path, run
        self.known: dict[tuple[str, int, int], float] = {}
        if path:
            try:
                # One short row for each score of a search; other runs' rows stay out.
                rows = spark.read.schema(SCORES).json(f"{path}/*").filter(F.col("run") == run)
                for r in rows.collect():
                    self.known[r["chain"], r["fold"], r["rounds"]] = r["r2"]
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise

    def missing(self, chain: Chain, fold: int) -> bool:
        return any((chain.name, fold, k) not in self.known for k in chain.rounds)

    def add(self, chain: Chain, fold: int, values: list[float]) -> None:
        """Keep the scores of a chain and fold. Each has a folder of its own, because writers that
        share one clear away each other's unfinished files."""
        rows = [(self.run, chain.name, fold, k, v) for k, v in zip(chain.rounds, values)]
        if self.path:
            folder = f"{self.path}/{self.run}-{chain.name}-{fold}-{max(chain.rounds)}"
            table = self.spark.createDataFrame(rows, SCORES).coalesce(1)
            table.write.mode("overwrite").json(folder)
        for _, name, at, k, v in rows:
            self.known[name, at, k] = v

    def mean(self, candidate: Candidate, folds: int) -> float:
        name, k = Chain(chain_of(candidate), ()).name, int(candidate[ROUNDS])
        return sum(self.known[name, f, k] for f in range(folds)) / folds


def run_name(rows: DataFrame, folds: int, seed: int = presets.SEED) -> str:
    """A name for what scores depend on besides their parameters: the rows, the folds and the seed."""
    content = rows.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*sorted(rows.columns))).alias("h")
    ).first()
    parts = sorted(rows.columns), content["n"], content["h"], folds, seed
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Found:
    best: int
    scores: list[float]
    #: Chains and folds fitted by this call, and those taken from the written table.
    fitted: int
    reused: int


def search(
    assembled: DataFrame,
    candidates: list[Candidate],
    folds: int,
    learner: Callable[[Candidate], GBTRegressor],
    parallelism: int = 2,
    path: str | None = None,
    run: str = "",
) -> Found:
    """Mean R² over the folds of every candidate, and the best one; of equals the first.

    ``assembled`` has ``features``, ``label`` and ``fold``. Scores are written to ``path``, under the
    name ``run`` (:func:`run_name`). A score that is no number (labels of a fold all equal) loses to
    any other.
    """
    spark = assembled.sparkSession
    scores = Scores(spark, path, run)
    work = [(c, f) for c in chains(candidates) for f in range(folds)]
    todo = [(c, f) for c, f in work if scores.missing(c, f)]

    def score(task: tuple[Chain, int]) -> None:
        chain, held_out = task
        model = learner(chain.longest()).fit(assembled.filter(F.col("fold") != held_out))
        held = assembled.filter(F.col("fold") == held_out)
        scores.add(chain, held_out, prefix_scores(model, held, chain.rounds))

    if todo:
        with ThreadPoolExecutor(max(1, min(parallelism, len(todo)))) as pool:
            list(pool.map(inheritable_thread_target(spark)(score), todo))
    means = [scores.mean(c, folds) for c in candidates]
    best = max(range(len(means)), key=lambda i: -math.inf if math.isnan(means[i]) else means[i])
    return Found(best, means, len(todo), len(work) - len(todo))
