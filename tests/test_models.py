from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pricewright import schemas
from pricewright.operators import encode, evaluate, score
from pricewright.plans import jobs, presets, search, training
from pricewright.sources import sinks
from pricewright.sources.sample import sample_requests
from pricewright.streaming.scoring import read_request_table, read_requests, score_stream


@pytest.fixture(scope="module")
def model(prepared):
    return training.fit(prepared, jobs.CURRENT, "tree", max_depth=4)


def test_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 18.0), (30.0, 33.0)], "y double, p double")
    row = evaluate.regression_metrics(df, "y", "p").first()
    assert row.r2 == pytest.approx(1 - 17 / 200)
    assert row.mae == pytest.approx(7 / 3) and row.mse == pytest.approx(17 / 3)
    assert row.rmse == pytest.approx((17 / 3) ** 0.5)
    assert row.mape == pytest.approx((0.2 + 0.1 + 0.1) / 3 * 100)
    flat = spark.createDataFrame([(5.0, 5.0), (5.0, 6.0)], "y double, p double")
    assert evaluate.regression_metrics(flat, "y", "p").first().r2 == 0.0


def test_published_delta_and_ranking(spark):
    metrics = spark.createDataFrame([(0.8332058, 18.2337427, 1.0)], "r2 double, mae double, mape double")
    row = evaluate.baseline_delta(metrics).first()
    assert row.r2_delta == pytest.approx(0.0501058) and row.mae_delta == pytest.approx(-2.2662573)
    assert row.improved
    records = spark.createDataFrame(
        [("low", 0.2402, 65.55, 168.54, 62.66), ("high", 0.6877, 30.684, 108.06, 23.84)],
        schemas.METRICS,
    )
    ranked = evaluate.comparison_table(records).collect()
    assert [r.algorithm for r in ranked] == ["high", "low"] and ranked[0].r2 == 0.69


def test_result_record_roundtrip(spark, tmp_path):
    metrics = spark.createDataFrame([(0.8, 18.0, 16.0)], "r2 double, mae double, mape double")
    record = evaluate.result_record(metrics, "GBT", presets.BEST_PARAMS)
    sinks.write_metrics(record, str(tmp_path / "r"))
    row = spark.read.schema(record.schema).json(str(tmp_path / "r")).first()
    assert row.features_count == 26 and row.features_numeric == schemas.NUMERIC
    assert row.best_params["n_estimators"] == 1200.0 and row.leakage_fixed
    assert row.vs_baseline.mae_delta == pytest.approx(-2.5)


def test_unseen_level_is_a_zero_block(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "train"), ("b", 2.0, "train"), ("zzz", 3.0, "test")], "c string, x double, split string"
    )
    from pyspark.ml import Pipeline

    features = training.FeatureSet(("x",), ("c",))
    fitted = Pipeline(stages=features.stages()).fit(encode.train_rows(df))
    vectors = [r.features.toArray().tolist() for r in fitted.transform(df).orderBy("x").collect()]
    assert vectors == [[1.0, 1.0, 0.0], [2.0, 0.0, 1.0], [3.0, 0.0, 0.0]]


def test_search_candidates():
    drawn = search.sample_candidates(presets.SEARCH_SPACE, 25)
    assert drawn == search.sample_candidates(presets.SEARCH_SPACE, 25)
    assert len({tuple(d.items()) for d in drawn}) == 25
    assert all(d[k] in presets.SEARCH_SPACE[k] for d in drawn for k in d)
    assert len(search.sample_candidates({"a": [1, 2], "b": [1, 2]}, 99)) == 4
    assert training.boosting_params({"colsample_bytree": 1.0, "gamma": 0}) == {
        "featureSubsetStrategy": "all", "minInfoGain": 0.0,
    }


@pytest.fixture(scope="module")
def signal(spark):
    """Rows whose price follows from two product attributes."""
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    rows = items.join(part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "CAST(p_size AS DOUBLE) AS size", "CAST(l_partkey % 6 AS STRING) AS kind",
        "20 + 3 * p_size + 5 * (l_partkey % 6) + 0.02D * (l_orderkey % 100) AS price",
        "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS item_key",
    )
    return encode.with_split(rows).cache()


SIGNAL = training.FeatureSet(("size",), ("kind",))


@pytest.mark.parametrize("kind", ["tree", "forest", "gbt", "linear"])
def test_models_find_the_signal(signal, kind):
    fitted = training.fit(signal, SIGNAL, kind, **presets.QUICK[kind])
    assert training.evaluate(signal, fitted).first().r2 > 0.8


def test_search_keeps_the_best_candidate(spark, signal):
    space = {"n_estimators": [2, 6], "max_depth": [2, 5], "learning_rate": [0.3]}
    tuned = training.tune(signal, SIGNAL, space, candidates=3, folds=3)
    assert tuned.best_params == tuned.candidates[tuned.scores.index(max(tuned.scores))]
    summary = tuned.summary(spark).collect()
    assert len(summary) == 3 and sum(r.best for r in summary) == 1
    assert training.evaluate(signal, tuned.model).first().r2 > 0.5


def test_reloaded_model_predicts_the_same(prepared, model, tmp_path):
    sinks.save_model(model, str(tmp_path / "m"))
    again = sinks.load_model(str(tmp_path / "m"))
    rows = encode.test_rows(prepared)
    before = training.predict(rows, model).select("item_key", "predicted_price").collect()
    after = training.predict(rows, again).select("item_key", "predicted_price").collect()
    assert sorted(before) == sorted(after) and before


def _request(**changes):
    row = dict(
        freight_value=13.2, product_photos_qty=1, product_weight_g=500.0, product_length_cm=10.0,
        product_height_cm=10.0, product_width_cm=10.0, product_description_lenght=300,
        product_name_lenght=40, product_category_name_english="small", purchase_month=11,
    )
    row.update(changes)
    return row


def _frame(spark, requests):
    columns = ["id"] + [f.name for f in schemas.REQUEST]
    rows = [tuple([i] + [r.get(c) for c in columns[1:]]) for i, r in enumerate(requests)]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.REQUEST)
    return spark.createDataFrame(rows, f"id int, {kinds}")


BAD = [
    (dict(freight_value=-0.1), ["freight_value: must be >= 0"]),
    (dict(product_weight_g=0.0), ["product_weight_g: must be > 0"]),
    (dict(purchase_month=13), ["purchase_month: must be <= 12"]),
    (dict(purchase_month=0), ["purchase_month: must be >= 1"]),
    (dict(product_category_name_english=None), ["product_category_name_english: required"]),
    (dict(product_avg_review=5.5, max_installments=25),
     ["product_avg_review: must be <= 5", "max_installments: must be <= 24"]),
]


def test_validation(spark):
    checked = score.validate(_frame(spark, [_request()] + [_request(**c) for c, _ in BAD]))
    found = [r.violations for r in checked.orderBy("id").collect()]
    assert found == [[]] + [reasons for _, reasons in BAD]
    assert score.valid_rows(checked).count() == 1
    assert score.quarantined_rows(checked).filter("error = ''").count() == 0


def test_defaults_and_shared_size_rule(spark):
    filled = score.apply_defaults(score.validate(_frame(spark, [_request()])))
    row = score.request_features(filled).first()
    assert (row.product_avg_review, row.max_installments, row.seller_state) == (4.0, 1, "SP")
    assert (row.payment_type_mode, row.category_avg_price) == ("credit_card", 100.0)
    assert row.product_volume_cm3 == 1000.0 and row.size_category == "small"
    assert row.is_peak_season == 1


def test_scoring_loses_no_row(spark, model):
    scored = score.score(
        _frame(spark, [_request()] + [_request(**c) for c, _ in BAD]), model, ("id",)
    )
    rows = scored.orderBy("id").collect()
    assert rows[0].predicted_price > 0 and rows[0].error is None
    assert all(r.predicted_price is None and r.error for r in rows[1:]) and len(rows) == 7


def test_stream_equals_batch(spark, star, model, tmp_path):
    requests = sample_requests(star.items, star)
    folder = str(tmp_path / "in")
    requests.repartition(3).write.json(folder)
    stream = read_requests(spark, folder, keep=["request_id"], max_files_per_trigger=1)
    out = str(tmp_path / "out")
    query = score_stream(stream, model, out, str(tmp_path / "log"), ("request_id",))
    query.awaitTermination()
    streamed = sorted(map(str, spark.read.parquet(out).collect()))
    batch = sorted(map(str, score.score(requests, model, ("request_id",)).collect()))
    assert streamed == batch and len(batch) == 6000


NAN, INF = float("nan"), float("inf")
UNUSABLE = [
    dict(freight_value=NAN), dict(product_weight_g=NAN), dict(product_width_cm=INF),
    dict(product_avg_review=NAN), dict(category_avg_price=NAN), dict(seller_avg_price=-INF),
]


def test_numbers_that_are_none_are_rejected(spark, model):
    rows = score.score(_frame(spark, [_request()] + [_request(**c) for c in UNUSABLE]), model, ("id",))
    found = {r.id: r for r in rows.collect()}
    assert found[0].error is None and found[0].predicted_price > 0
    for i, changes in enumerate(UNUSABLE, 1):
        assert f"{next(iter(changes))}: must be a finite number" in found[i].error
        assert found[i].predicted_price is None


def test_columns_of_another_type_are_cast_with_care(spark, model):
    frame = _frame(spark, [_request(), _request()]).withColumn(
        "product_weight_g", F.when(F.col("id") == 0, "500").otherwise("heavy")
    )
    rows = {r.id: r for r in score.score(frame, model, ("id",)).collect()}
    assert rows[0].error is None and "product_weight_g: is no double" in rows[1].error


def test_broken_records_are_rejected_in_batch_and_stream(spark, model, tmp_path):
    import json

    folder = tmp_path / "in"
    folder.mkdir()
    lines = [
        json.dumps({"id": "good", **_request()}),
        json.dumps({"id": "text", **_request(max_installments="abc")}),
        json.dumps({"id": "score", **_request(product_avg_review="x")}),
        "{broken",
    ]
    (folder / "a.json").write_text("\n".join(lines))
    batch = score.score(read_request_table(spark, str(folder), keep=["id"]), model, ("id",)).collect()
    stream = read_requests(spark, str(folder), keep=["id"], max_bytes_per_trigger="1000000")
    out = str(tmp_path / "out")
    score_stream(stream, model, out, str(tmp_path / "log"), ("id",)).awaitTermination()
    for rows in (batch, spark.read.parquet(out).collect()):
        assert len(rows) == 4
        assert [r.id for r in rows if r.error is None] == ["good"]
        assert sum("cannot be parsed" in (r.error or "") for r in rows) == 3


def test_division_by_zero_gives_null(spark):
    from pricewright.functions.features import with_physical_features

    row = _frame(spark, [_request(product_weight_g=-1.0, product_length_cm=-0.001,
                                  product_height_cm=10.0, product_width_cm=100.0)])
    found = with_physical_features(row).first()
    assert found.density is None and found.shipping_ratio is None


def test_record_of_the_older_model(spark, stage, star):
    space = {"n_estimators": [2], "max_depth": [2], "learning_rate": [0.3]}
    trained = jobs.train_baseline(star, stage, space, 1, folds=2, result_path=stage.path("result"))
    row = spark.read.schema(trained.record.schema).json(stage.path("result")).first()
    assert row.features_count == 20 and row.features_numeric == schemas.BASELINE_NUMERIC
    assert row.new_tables_used == [] and not row.leakage_fixed
    assert trained.search.summary(spark).count() == 1
