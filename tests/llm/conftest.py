from __future__ import annotations

import os

import pytest
from cases import DOCUMENTS, ODD, REPO, SMALL


@pytest.fixture(autouse=True)
def code_path(spark):
    """Python workers find the package wherever the tests are started."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if REPO not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            filter(None, [REPO, *paths])
        )


@pytest.fixture
def documents(spark):
    """A document table from (doc_id, text) pairs, or (doc_id, text, lang, source)."""

    def make(rows, extra=False):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, "en", "web")[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, len(text) if text is not None else None))
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            # Names that the operators use inside themselves.
            for name in ("id", "version", "spans", "bucket", "fp", "length", "lane", "features"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """(doc_id, text) of the smallest sample."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


@pytest.fixture
def odd():
    return list(ODD)
