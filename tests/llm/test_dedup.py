"""Repeated byte strings and word windows against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pricewright.llm import runs, suffix_dedup, window_dedup
from pricewright.llm.queries import QUERIES
from pricewright.llm.tables import keyed

NULL = -(2**63)


def brute_bytes(rows, length=100):
    texts = [(NULL if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in texts:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, (d, i)), (d, i))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (d, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append(
            (None if d == NULL else d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
        )
    return out


def brute_words(rows, window=50):
    texts = [(NULL if d is None else d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, d), d)
    out = []
    for d, w in texts:
        gone = [0] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [1] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append(
            (None if d == NULL else d, len(w), sum(gone), hashlib.sha256(kept).hexdigest())
        )
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


def digest_bytes(df):
    return ordered(
        df.selectExpr(
            "doc_id",
            "n_bytes",
            "n_bytes - octet_length(text)",
            "CAST(size(removed) AS LONG)",
            "sha2(text, 256)",
        ).collect()
    )


def digest_words(df):
    return ordered(
        df.selectExpr("doc_id", "n_words", "n_removed", "sha2(CAST(text AS BINARY), 256)").collect()
    )


def test_registered_queries(spark, sample):
    found = QUERIES["op1_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert ordered(found) == ordered(brute_bytes(sample))
    found = QUERIES["op5_window_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert ordered(found) == ordered(brute_words(sample))


@pytest.mark.parametrize("piece", [1 << 20, 1500])
def test_odd_rows(documents, odd, monkeypatch, piece):
    monkeypatch.setattr(runs, "PIECE", piece)
    docs = documents(odd, extra=True)
    assert digest_bytes(suffix_dedup.dedup(docs)) == ordered(brute_bytes(odd))
    assert digest_words(window_dedup.dedup(docs)) == ordered(brute_words(odd))


def test_empty_table(documents):
    docs = documents([])
    assert suffix_dedup.dedup(docs).count() == 0
    assert window_dedup.dedup(docs).count() == 0


def test_versions_of_one_id(documents):
    base = " ".join(f"a{i}" for i in range(300))
    rows = [(1, base), (1, "head " + base), (1, base), (2, base[200:] + " tail")]
    docs = documents(rows)
    assert digest_bytes(suffix_dedup.dedup(docs)) == ordered(brute_bytes(rows))
    assert digest_words(window_dedup.dedup(docs)) == ordered(brute_words(rows))


def shared(n):
    """Documents of their own words around one passage, copies, and one id with many rows."""
    passage = " ".join(f"p{i}" for i in range(70))
    own = [(i, " ".join(f"d{i}w{j}" for j in range(60))) for i in range(n)]
    rows = [(i, f"{text} {passage} {text[::-1]}") for i, text in own]
    rows += [(n + i, f"{passage} copy {passage}") for i in range(n)]
    return rows + [(2 * n, f"{passage} version {i}") for i in range(n)]


@pytest.mark.parametrize("lot", [40, 1 << 21])
def test_hot_passage(documents, monkeypatch, lot):
    monkeypatch.setattr(window_dedup, "LOT", lot)
    rows = shared(30)
    table = documents(rows).repartition(5)
    found = window_dedup.dedup(table).selectExpr(
        "doc_id", "n_words", "n_removed", "sha2(CAST(text AS BINARY), 256)"
    )
    assert ordered(found.collect()) == ordered(brute_words(rows))


def test_a_window_of_copies_is_sent_on_once_a_batch(documents):
    text = " ".join(f"w{i}" for i in range(150))
    table = keyed(documents([(i, text) for i in range(200)]).repartition(4))
    sent = window_dedup.candidates(table).filter("hashes IS NOT NULL")
    per_window = sent.selectExpr("explode(sequence(pos, pos + length - 1)) AS at").groupBy("at")
    counts = [r["count"] for r in per_window.count().collect()]
    assert len(counts) == 101 and max(counts) <= 4


def test_spans_are_those_removed(documents):
    rows = [(1, "k" * 20 + "".join(chr(97 + i % 26) * 7 for i in range(40))), (2, "y" * 50)]
    rows.append((3, "!" * 10 + rows[0][1][20:180] + "?" * 30))
    got = {r.doc_id: r for r in suffix_dedup.dedup(documents(rows)).collect()}
    assert [tuple(s) for s in got[3].removed] == [(10, 170)]
    assert bytes(got[3].text) == b"!" * 10 + b"?" * 30


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_longest_previous_factors(text):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        common.append(n)
    got = np.zeros(len(text), int)
    if text:
        got[order] = suffix_dedup.longest_previous_factor(np.array(order), np.array(common))
    for i in range(len(text)):
        best = 0
        for j in range(i):
            n = 0
            while i + n < len(text) and text[j + n] == text[i + n]:
                n += 1
            best = max(best, n)
        assert got[i] == best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=300), st.integers(16, 40))
def test_repeated_starts(units, length):
    text = np.array(units, np.uint8)
    starts = np.arange(max(0, len(text) - length + 1))
    found, first = suffix_dedup.repeated_starts(text, starts, length)
    seen = {}
    for i in starts:
        w = text[i : i + length].tobytes()
        assert found[i] == (w in seen)
        assert first[i] == seen.setdefault(w, i)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=80), st.integers(1, 60))
def test_rolling_hash(units, window):
    if len(units) < window:
        return
    got = window_dedup.rolling(np.array(units, np.uint64), window)
    for i in range(len(units) - window + 1):
        value = 0
        for u in units[i : i + window]:
            value = (value * window_dedup._BASE + u) % window_dedup.PRIME
        assert int(got[i]) == value


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \n\té", max_size=90), max_size=12))
def test_word_bounds_and_hashes(texts):
    data = [t.encode() for t in texts]
    edges = np.cumsum([0, *map(len, data)])
    text = np.frombuffer(b"".join(data), np.uint8)
    starts, ends = runs.word_bounds(text, edges)
    words = [w for d in data for w in d.split()]
    assert [text[a:b].tobytes() for a, b in zip(starts, ends)] == words
    hashes = runs.word_hashes(text, starts, ends)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
