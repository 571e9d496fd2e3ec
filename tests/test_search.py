"""Search by staged prefixes: scores of separate fits, and searches that go on after a stop."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pricewright.plans import presets, search, training

SAMPLED = {"max_depth": 3, "learning_rate": 0.2, "subsample": 0.7, "colsample_bytree": 0.6}


@pytest.fixture(scope="module")
def assembled(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr(
        "CAST(l_quantity AS DOUBLE) AS x", "CAST(l_partkey % 7 AS DOUBLE) AS y",
        "CAST(l_suppkey AS DOUBLE) AS z", "CAST(l_orderkey % 3 AS INT) AS fold",
        "ln(3 + l_quantity * (1 + l_partkey % 7) + l_orderkey % 11) AS label",
    )
    vectors = VectorAssembler(inputCols=["x", "y", "z"], outputCol="features").transform(rows)
    return vectors.select("features", "label", "fold").repartition(2, "fold").cache()


def learner(values):
    return training.estimator("gbt", **values)


def test_chains_hold_every_candidate_once():
    drawn = search.sample_candidates(presets.SEARCH_SPACE, 400)
    found = search.chains(drawn)
    assert sum(len(c.rounds) for c in found) == 400 and len(found) < 400
    assert {(c.params, k) for c in found for k in c.rounds} == {
        (search.chain_of(d), d["n_estimators"]) for d in drawn
    }
    assert len({c.name for c in found}) == len(found)
    assert [max(c.rounds) for c in found] == sorted((max(c.rounds) for c in found), reverse=True)


def test_prefixes_score_as_separate_fits(assembled):
    rounds = (1, 4, 9)
    train, held = assembled.filter("fold <> 0"), assembled.filter("fold = 0")
    chain = learner({**SAMPLED, "n_estimators": 9}).fit(train)
    r2 = RegressionEvaluator(labelCol="label", metricName="r2")
    alone = [
        r2.evaluate(learner({**SAMPLED, "n_estimators": k}).fit(train).transform(held)) for k in rounds
    ]
    assert search.prefix_scores(chain, held, rounds) == pytest.approx(alone, abs=1e-9)
    assert len(set(alone)) == 3


CANDIDATES = [
    {**SAMPLED, "n_estimators": 2},
    {**SAMPLED, "n_estimators": 5},
    {**SAMPLED, "max_depth": 2, "n_estimators": 3},
]


def test_a_stopped_search_goes_on(spark, assembled, tmp_path):
    path, fits = str(tmp_path / "scores"), []

    def stops(values):
        if len(fits) == 4:
            raise RuntimeError("stopped")
        fits.append(values["n_estimators"])
        return learner(values)

    with pytest.raises(RuntimeError, match="stopped"):
        search.search(assembled, CANDIDATES, 3, stops, 1, path, "one")
    again = search.search(assembled, CANDIDATES, 3, learner, 2, path, "one")
    assert (again.fitted, again.reused) == (2, 4)
    fresh = search.search(assembled, CANDIDATES, 3, learner, 2)
    assert (fresh.fitted, fresh.reused) == (6, 0)
    assert again.scores == pytest.approx(fresh.scores, abs=1e-12) and again.best == fresh.best
    assert fresh.best == max(range(3), key=fresh.scores.__getitem__)
    # Candidates with rounds that were not scored need their chain; another run shares nothing.
    more = [*CANDIDATES, {**SAMPLED, "max_depth": 2, "n_estimators": 4}]
    assert search.search(assembled, more, 3, learner, 2, path, "one").fitted == 3
    assert search.search(assembled, more, 3, learner, 2, path, "one").fitted == 0
    assert search.search(assembled, more[:1], 3, learner, 2, path, "two").fitted == 3


def test_runs_are_named_by_their_rows(spark, assembled):
    rows = spark.range(100).selectExpr("id", "id * 2D AS label")
    name = search.run_name(rows, 3)
    assert name == search.run_name(rows.repartition(7), 3)
    others = [rows.filter("id > 0"), rows.withColumn("label", F.col("label") + 1), rows.drop("id")]
    assert len({name, search.run_name(rows, 4), *(search.run_name(o, 3) for o in others)}) == 5


def test_scores_that_are_no_number_lose(spark, assembled):
    flat = assembled.withColumn("label", F.when(F.col("fold") == 1, 1.0).otherwise(F.col("label")))
    found = search.search(flat, CANDIDATES[:1], 2, learner, 1)
    assert found.best == 0 and found.scores[0] != found.scores[0]
