"""Priced and rejected requests in two folders, each once, whatever fails in between."""

from __future__ import annotations

import json

import pytest
from test_models import _request, model  # noqa: F401

from pricewright.operators import score
from pricewright.streaming import scoring
from pricewright.streaming.scoring import read_requests, score_into_sinks


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        lines = [
            json.dumps({"id": f"good{i}", **_request()}),
            json.dumps({"id": f"bad{i}", **_request(purchase_month=13)}),
            "{broken",
        ]
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(lines))
    return tmp_path


def start(spark, model, folder):  # noqa: F811
    requests = read_requests(spark, str(folder / "in"), keep=["id"], max_files_per_trigger=1)
    paths = [str(folder / name) for name in ("priced", "rejected", "log")]
    return score_into_sinks(requests, model, *paths, ("id",))


def found(spark, folder):
    priced = spark.read.parquet(str(folder / "priced"))
    rejected = spark.read.parquet(str(folder / "rejected"))
    assert "error" not in priced.columns and "predicted_price" not in rejected.columns
    return (
        sorted(r.id for r in priced.collect()),
        sorted((r.id or "", r.error) for r in rejected.collect()),
    )


def check(spark, folder):
    good, bad = found(spark, folder)
    assert good == ["good0", "good1", "good2"]
    assert [i for i, _ in bad if i] == ["bad0", "bad1", "bad2"] and len(bad) == 6
    assert sum("cannot be parsed" in e for _, e in bad) == 3


def test_each_request_is_in_one_sink(spark, model, folder):  # noqa: F811
    start(spark, model, folder).awaitTermination()
    check(spark, folder)
    start(spark, model, folder).awaitTermination()
    check(spark, folder)


@pytest.mark.parametrize("sink", ["priced", "rejected"])
def test_a_batch_repeated_after_a_failure(spark, model, folder, monkeypatch, sink):  # noqa: F811
    write, failed = scoring._write_sink, []

    def fails_after_writing(rows, path, batch_id):
        write(rows, path, batch_id)
        if path.endswith(sink) and batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    monkeypatch.setattr(scoring, "_write_sink", fails_after_writing)
    with pytest.raises(Exception, match="lost"):
        start(spark, model, folder).awaitTermination()
    assert failed == [1]
    start(spark, model, folder).awaitTermination()
    check(spark, folder)


def test_a_request_is_scored_once(spark, model, folder, monkeypatch):  # noqa: F811
    calls = []
    monkeypatch.setattr(
        scoring, "score", lambda *a: calls.append(1) or score.score(*a)
    )
    start(spark, model, folder).awaitTermination()
    assert len(calls) == 3


def test_a_backlog_without_a_limit_is_cut(spark, folder, monkeypatch):
    monkeypatch.setattr(scoring, "FILES_PER_BATCH", 2)
    stream = read_requests(spark, str(folder / "in"), keep=["id"])
    out = folder / "out"
    query = stream.writeStream.format("parquet").option("path", str(out)).option(
        "checkpointLocation", str(folder / "log")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(query.recentProgress) >= 2
