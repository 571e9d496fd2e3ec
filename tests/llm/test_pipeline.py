"""The pipeline, stage by stage against brute force, and as a whole."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from cases import DOCUMENTS, ODD, REPO, SMALL
from test_simhash import brute
from test_texts import check_packing

import corpus_pipeline
from pricewright.llm import decontaminate, pii, toxicity
from pricewright.llm.tables import keyed


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Every stage's result on the smallest sample with odd rows added, written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    rows = [(None if d is None else d + 10**6, t, None, "web", None) for d, t in ODD]
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    rows += [(2 * 10**6, f"before {bench} after", "en", "web", 0)]
    rows += [(2 * 10**6 + 1, "Write to someone@example.org or +49 30 1234567.", "en", "web", 0)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(docs.columns).union(docs)
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(folder / name))
        docs = out[name] = spark.read.parquet(str(folder / name))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(results):
    for name in ("toxicity", "near_duplicates", "decontamination", "personal_data"):
        assert results[name].columns == results["documents"].columns
        assert results[name].dtypes == results["documents"].dtypes


def test_toxic_documents_go(spark, results):
    docs = results["documents"]
    chain = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = [r.doc_id for r in toxicity.score(docs, chain).filter("kept").collect()]
    assert sorted(kept, key=str) == sorted((d for d, _ in pairs(results["toxicity"])), key=str)
    assert len(kept) < docs.count()


def test_one_document_of_each_group_stays(results):
    before = pairs(results["toxicity"])
    expected = {c for _, _, c in brute(before)}
    after = [d for d, _ in pairs(results["near_duplicates"])]
    assert len(after) == len(set(after)) and set(after) == expected and len(after) < len(before)


def test_contaminated_documents_go(spark, results):
    before, after = pairs(results["near_duplicates"]), pairs(results["decontamination"])
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    normal = lambda t: decontaminate.normal((t or "").encode())
    parts = [p for t in items for _, p in decontaminate.segments(normal(t))]
    holding = {d for d, t in before if any(p in normal(t) for p in parts)}
    gone = {d for d, _ in before} - {d for d, _ in after}
    assert holding <= gone and 2 * 10**6 in gone
    index = decontaminate.Index([(i, normal(t)) for i, t in enumerate(items)])
    assert gone == {d for d, t in before if decontaminate.matches_in(index, (t or "").encode())}


def test_texts_are_sanitized(results):
    before = dict(pairs(results["decontamination"]))
    after = {r.doc_id: r for r in results["personal_data"].collect()}
    assert after.keys() == before.keys()
    found = pii.spans(keyed(results["decontamination"])).select("id", "all_spans")
    spans = {r.id: r.all_spans for r in found.collect()}
    for doc_id, text in before.items():
        out, at = "", 0
        for s in spans[doc_id if doc_id is not None else -(2**63)]:
            if s.start >= at:
                label = f"[{s.kind.upper()}]"
                if s.kind == "term" and float(s.value) >= 1 - 1e-9:
                    label = ""
                out += text[at : s.start] + label
            at = max(at, s.end)
        assert after[doc_id].text == (None if text is None else out + text[at:])
        assert after[doc_id].n_chars == (None if text is None else len(after[doc_id].text))
    if 2 * 10**6 + 1 in after:
        assert after[2 * 10**6 + 1].text == "Write to [EMAIL] or [PHONE]."


def test_packed_sequences(results):
    texts = [t for _, t in pairs(results["personal_data"])]
    check_packing(results["packing"].collect(), texts)


def test_run_is_its_stages(spark, results):
    whole = corpus_pipeline.run(spark, SMALL)
    assert whole.columns == results["packing"].columns and whole.count() > 0


def test_entry_without_this_folder(tmp_path):
    """The rest imports when this folder and the pipeline are gone."""
    import shutil

    shutil.copytree(
        f"{REPO}/pricewright", tmp_path / "pricewright", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print('op1_suffix_dedup' in q, 'pipeline' in q, len(q) > 50)"
    env = {**os.environ, "PYTHONPATH": ""}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert said.stdout.split() == ["False", "False", "True"], said.stderr
