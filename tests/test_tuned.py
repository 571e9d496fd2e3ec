"""The tuned fit runs with the published parameters, none of them cut."""

from __future__ import annotations

import pytest

from pricewright.plans import jobs, presets, sample_queries


def test_the_tuned_fit_has_the_published_size(spark, prepared, monkeypatch):
    asked = {}

    def fit(rows, features, kind, **values):
        asked.update(values, kind=kind, features=features)
        raise InterruptedError

    monkeypatch.setattr(sample_queries.training, "fit", fit)
    monkeypatch.setattr(sample_queries, "_training_rows", lambda *_: (prepared, None))
    with pytest.raises(InterruptedError):
        sample_queries.QUERIES["fit_gbt_tuned"](spark, "")
    assert asked == {**presets.BEST_PARAMS, "kind": "gbt", "features": jobs.CURRENT}
