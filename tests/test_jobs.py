"""The command line jobs, end to end on the smallest sample."""

from __future__ import annotations

import json
import os

import pytest

from pricewright import schemas
from pricewright.__main__ import main
from pricewright.sources.sample import sample_requests
from pricewright.stage import shared_dir


def staged(spark) -> set[str]:
    folder = shared_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(folder) if n.startswith("pricewright-")}


@pytest.fixture(scope="module")
def data(spark, star, tmp_path_factory):
    """The sample star as one Parquet folder per table."""
    folder = tmp_path_factory.mktemp("star")
    for name, df in star.tables().items():
        df.write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def trained(spark, data, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("train"))
    before = staged(spark)
    size = ["--quick", "--candidates", "1", "--folds", "2", "--parallelism", "1"]
    main(["train", "--data", data, "--out", out, "--format", "parquet", *size])
    assert staged(spark) == before
    return out


def test_train(spark, trained):
    assert sorted(os.listdir(trained)) == ["model", "result"]
    (row,) = spark.read.json(f"{trained}/result").collect()
    assert row.features_count == 26 and row.leakage_fixed
    assert row.new_tables_used == schemas.NEW_TABLES


def test_baseline(spark, data, tmp_path):
    before = staged(spark)
    size = ["--quick", "--candidates", "1", "--folds", "2"]
    main(["baseline", "--data", data, "--out", str(tmp_path), "--format", "parquet", *size])
    (row,) = spark.read.json(str(tmp_path / "result")).collect()
    assert row.features_count == 20 and not row.leakage_fixed and row.new_tables_used == []
    assert staged(spark) == before


def test_compare_and_ranking(spark, data, tmp_path, capsys):
    before = staged(spark)
    main(["compare", "--data", data, "--out", str(tmp_path), "--format", "parquet", "--quick"])
    assert sorted(os.listdir(tmp_path)) == ["forest", "gbt", "linear", "tree"]
    capsys.readouterr()
    main(["ranking", "--results", str(tmp_path)])
    text = capsys.readouterr().out
    assert "Random Forest" in text and "Gradient Boosting" in text
    assert staged(spark) == before


def test_categories_twice(spark, data, tmp_path):
    args = ["categories", "--data", data, "--out", str(tmp_path), "--format", "parquet"]
    main(args)
    first = spark.read.parquet(str(tmp_path / "category_stats")).count()
    main(args)
    assert spark.read.parquet(str(tmp_path / "category_stats")).count() == first == 91
    seed = "\n".join(r.value for r in spark.read.text(str(tmp_path / "category_stats_seed")).collect())
    assert "''s brand#" in seed and seed.rstrip().endswith("ON CONFLICT (category) DO NOTHING;")


def test_score_and_stream(spark, star, trained, tmp_path):
    folder = tmp_path / "requests"
    sample_requests(star.items, star).limit(200).write.json(str(folder))
    (folder / "broken.json").write_text('{"request_id": "broken", "freight_value": "much"}\n{')
    paths = ["--requests", str(folder), "--model", f"{trained}/model", "--keep", "request_id"]
    main(["score", *paths, "--out", str(tmp_path / "batch")])
    stream = ["--checkpoint", str(tmp_path / "log"), "--max-files", "1", "--once"]
    main(["stream", *paths, "--out", str(tmp_path / "stream"), *stream])
    found = []
    for name in ("batch", "stream"):
        rows = spark.read.parquet(str(tmp_path / name)).collect()
        assert len(rows) == 202 and sum("cannot be parsed" in (r.error or "") for r in rows) == 2
        assert all((r.error is None) != (r.predicted_price is None) for r in rows)
        found.append(sorted(json.dumps(r.asDict(), sort_keys=True) for r in rows))
    assert found[0] == found[1]
