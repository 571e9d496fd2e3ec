"""Trees on packed rows: the rules of MLlib, in one task and in jobs, and how little a row takes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from pricewright.plans import training, trees
from pricewright.stage import Stage

FEATURES = training.FeatureSet(("a", "b"), ("c", "d"))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.range(3000).selectExpr(
        "CAST(id * 7919 % 1009 AS DOUBLE) AS a", "CAST(id * 31 % 17 AS DOUBLE) AS b",
        "concat('level ', id * 13 % 11) AS c", "concat('other ', id % 4) AS d", "id",
    )
    label = F.expr("sqrt(a) + b * if(c = 'level 3', 2, -1) + if(d = 'other 1', 5, 0) + id * 37 % 101 / 20D")
    rows = Stage(spark).table(rows.withColumn("label", label).repartition(3, "id"), "rows")
    encoder = Pipeline(stages=FEATURES.stages()).fit(rows)
    return Stage(spark).table(encoder.transform(rows), "vectors")


def far(ours, theirs, rows) -> int:
    """Rows on which two models differ."""
    first = ours.transform(rows).withColumnRenamed("prediction", "ours")
    return theirs.transform(first).filter(F.abs(F.col("ours") - F.col("prediction")) > 1e-9).count()


def test_a_tree_is_that_of_mllib(vectors):
    values = dict(labelCol="label", seed=1, maxDepth=6, maxBins=64, minInstancesPerNode=4)
    ours = trees.PackedTree(**values).fit(vectors)
    theirs = DecisionTreeRegressor(**values).fit(vectors)
    assert far(ours, theirs, vectors) == 0
    assert (ours.numNodes, ours.depth, ours.numFeatures) == (theirs.numNodes, theirs.depth, theirs.numFeatures)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())


def test_boosting_is_that_of_mllib_in_a_task_and_in_jobs(vectors, monkeypatch):
    values = dict(labelCol="label", seed=1, maxDepth=4, maxBins=256, maxIter=12, stepSize=0.3, minInfoGain=0.01)
    theirs = GBTRegressor(**values).fit(vectors)
    ours = trees.PackedBoosting(**values).fit(vectors)
    assert far(ours, theirs, vectors) == 0 and ours.treeWeights == theirs.treeWeights
    monkeypatch.setattr(trees, "ONE_TASK", 0)
    monkeypatch.setattr(trees, "TASK_ROWS", 500)
    assert far(trees.PackedBoosting(**values).fit(vectors), theirs, vectors) == 0
    # Histograms summed by executors, the nodes of a level in several jobs.
    monkeypatch.setattr(trees, "DIRECT_BYTES", 0)
    monkeypatch.setattr(trees, "GROUP_BYTES", 1 << 15)
    monkeypatch.setattr(trees, "CHUNK_BYTES", 1 << 13)
    assert far(trees.PackedBoosting(**values).fit(vectors), theirs, vectors) == 0


def test_sampled_boosting_and_forest_learn_as_much(vectors):
    def error(model):
        return model.transform(vectors).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]

    sampled = dict(maxDepth=4, maxIter=10, stepSize=0.3, subsamplingRate=0.7, featureSubsetStrategy="0.7")
    forest = dict(numTrees=20, maxDepth=6, featureSubsetStrategy="all")
    for ours, theirs, values in (
        (trees.PackedBoosting, GBTRegressor, sampled),
        (trees.PackedForest, RandomForestRegressor, forest),
    ):
        got, wanted = (error(k(labelCol="label", seed=3, **values).fit(vectors)) for k in (ours, theirs))
        assert got == pytest.approx(wanted, rel=0.2)


def test_vectors_without_their_columns_give_the_same_tree(vectors):
    values = dict(labelCol="label", seed=1, maxDepth=5)
    alone = vectors.select("features", "label")
    assert all(c.source is None for c in trees.columns_of(alone, "features"))
    both = [trees.PackedTree(**values).fit(rows) for rows in (vectors, alone)]
    assert far(*both, vectors) == 0


def test_a_row_takes_a_byte_a_column(vectors):
    packed = trees.pack(vectors, "features", "label", 256)
    blocks = packed.blocks().collect()
    assert sum(codes.nbytes for _, codes, _ in blocks) == 4 * 3000
    assert [c.source for c in packed.shape.columns] == ["a", "b", "c__index", "d__index"]
    packed.stage.remove()


def test_a_block_of_many_levels_takes_several_columns(spark):
    rows = spark.range(1200).selectExpr("concat('k', id % 600) AS c", "CAST(id % 600 * 3 % 7 AS DOUBLE) AS label")
    wide = Pipeline(stages=training.FeatureSet((), ("c",)).stages()).fit(rows).transform(rows)
    assert [(c.first, c.levels, c.before) for c in trees.columns_of(wide, "features")] == [
        (0, 255, 0), (255, 255, 255), (510, 90, 510),
    ]
    values = dict(labelCol="label", maxDepth=3, seed=1)
    found = [k(**values).fit(wide) for k in (trees.PackedTree, DecisionTreeRegressor)]
    gains = [m.transform(wide).agg(F.var_pop("prediction")).first()[0] for m in found]
    assert gains[0] == pytest.approx(gains[1])


def test_missing_numbers_and_labels_are_errors(vectors, spark):
    for column in ("a", "label"):
        bad = vectors.withColumn(column, F.when(F.col("id") != 5, F.col(column)))
        with pytest.raises(Exception, match="must not be null or NaN"):
            trees.PackedTree(labelCol="label", seed=1).fit(bad)
    with pytest.raises(ValueError, match="no rows"):
        trees.PackedTree(labelCol="label", seed=1).fit(vectors.filter("id < 0"))


def test_cut_points_of_few_and_many_values():
    assert trees.cut_points(np.array([1.0, 2.0, 5.0]), np.ones(3), 3).tolist() == [1.5, 3.5]
    values = np.random.default_rng(0).normal(size=200_000)
    parts = [trees._thinned(*trees._counted(p)) for p in np.split(values, 8)]
    seen = parts[0]
    for part in parts[1:]:
        seen = trees._joined(seen, part)
    cuts = trees.cut_points(*seen, 256)
    assert seen[1].sum() == 200_000 and len(cuts) == 255
    share = np.histogram(values, np.r_[-np.inf, cuts, np.inf])[0] / len(values) * 256
    assert share.min() > 0.6 and share.max() < 1.5
