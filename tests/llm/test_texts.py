"""Personal data, decontamination, packing, outliers and toxicity."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pricewright.llm import decontaminate, outliers, packing, pii, runs, toxicity
from pricewright.llm.queries import QUERIES
from pricewright.llm.tables import keyed

SMALL = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
        "card": 12 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def base_spans(text):
    found = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    ]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def found_bases(spark, documents, texts):
    docs = keyed(documents(list(enumerate(texts))))
    text = pii._text_of_spans(F.col("spans"))
    return {r.id: r.s for r in pii.detect(docs).select("id", text.alias("s")).collect()}


TRICKY = [
    "a@b.c_d@e.f x@y. q@w..e @a.b a@b a@-.- me+you%x.y@sub-1.example.co.uk.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.03.4 1..2.3.4.5 999.999.999.999 12.34",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 0 0 0 378282246310005x",
    "+49 (30) 123-45.67 +1 +12345678 ++49301234567 +(1)23456789 +1 (830) 555-5433) +123456789012345678",
    "é漢🙂 a@b.cc é +49 30 1234567 🙂 10.0.0.1é",
    "1" * 5000,
    "1 " * 5000,
    "a" * 20000,
    "a@" * 3000,
    "+1" * 3000 + " " + "5" * 16,
    "a.b@c.d," * 2000,
    None,
    "",
]


def test_base_spans(spark, documents):
    got = found_bases(spark, documents, TRICKY)
    for i, text in enumerate(TRICKY):
        assert got[i] == base_spans(text), text and text[:60]


def test_base_spans_of_random_texts(spark, documents):
    rng = np.random.default_rng(5)
    alphabet = list("aB1.@+- ()0459_%é")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 120))) for _ in range(400)]
    digits = list("0123456789 -.+()")
    texts += ["".join(rng.choice(digits, rng.integers(0, 120))) for _ in range(400)]
    got = found_bases(spark, documents, texts)
    assert [got[i] for i in range(len(texts))] == [base_spans(t) for t in texts]


def test_registered_pii(spark, sample):
    got = {r.doc_id: r for r in QUERIES["op2_pii"](spark, SMALL).collect()}
    assert len(got) == len(sample)
    for doc_id, text in sample:
        base, row = base_spans(text), got[doc_id]
        assert row.base_sha256 == digest(base)
        kinds = Counter(s.split(":")[0] for s in base.split(",") if s)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds[k] for k in PATTERNS]
        rest = ",".join(s for s in row.spans.split(",") if not s.startswith("term:"))
        assert rest == base


def test_disclosing_terms(documents):
    filler = "plain words of no note at all "
    # Copies count once, so all texts differ.
    rows = [(i, filler * 3 + f" {i}") for i in range(20)]
    rows += [(20 + i, f"{filler} Quillfeather wrote bob@x.org the words {filler} {i}") for i in range(3)]
    rows += [(30, "the plain words wrote and wrote"), (31, "zebra once eve@y.org")]
    rows += [(40, None), (None, "?")]
    docs = keyed(documents(rows))
    n = len(rows)
    term = lambda t: {w.lower() for w in re.findall(r"[^\W\d_][^\W_]{2,}", t or "")}
    held = {r.id: r for r in pii.spans(docs).collect()}
    found = pii.disclosures(docs, pii.detect(docs)).collect()
    share = {(r.entity, r.term): r.share for r in found}
    # "wrote" stands in one more document: less than all of the information.
    both, entity, df = 3, 3, 4
    wrote = math.log2(both * n / (entity * df)) / math.log2(n / entity)
    assert share[("email:bob@x.org", "quillfeather")] == pytest.approx(1)
    assert (("email:bob@x.org", "wrote") in share) == (wrote >= pii.THRESHOLD)
    assert not any(t in ("plain", "words") for _, t in share)
    assert not any(e == "email:eve@y.org" for e, _ in share)
    kinds = [s.kind for s in held[20].all_spans]
    assert "term" in kinds and "email" in kinds and [s.kind for s in held[31].all_spans] == ["email"]
    assert term("a Quillfeather 12") == {"quillfeather"}


def test_sanitized_texts(documents, odd):
    rows = odd + [
        (50, "Call +49 (30) 123-45.67 now, " + "x" * 9000 + " mail a@b.cc. Or 4111 1111 1111 1111"),
        (51, "+4111111111111111"),
    ]
    docs = documents(rows, extra=True)
    clean = pii.sanitize(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[50] == "Call [PHONE] now, " + "x" * 9000 + " mail [EMAIL]. Or [CARD]"
    assert got[51] in ("[PHONE]", "+[CARD]") and got[1] is None and got[2] == ""
    assert got[7] == dict(rows)[7]
    assert pii.sanitize(documents([])).count() == 0


def brute_matches(doc, item, rate=decontaminate.RATE):
    """Segments of an item that occur in a document with at most ``rate`` edits; free text ends."""
    text, hits = decontaminate.normal(doc), 0
    for _, part in decontaminate.segments(decontaminate.normal(item)):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(part, 1):
            now = [i]
            for j, d in enumerate(text, 1):
                now.append(min(row[j - 1] + (c != d), row[j] + 1, now[-1] + 1))
            row = now
        hits += min(row) <= int(len(part) * rate)
    return hits


def damaged(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at = int(rng.integers(0, len(out)))
        kind = rng.integers(0, 3)
        if kind == 0:
            out[at] = "#"
        elif kind == 1:
            out.insert(at, "#")
        else:
            del out[at]
    return "".join(out)


def test_decontamination_finds_all_within_the_budget(spark, documents):
    rng = np.random.default_rng(3)
    letters = list("abcdefghij ")
    make = lambda n: "".join(rng.choice(letters, n))
    items = [make(n) for n in (45, 80, 100, 130, 260)]
    docs = []
    for i in range(40):
        item = items[i % len(items)]
        part = damaged(item, int(rng.integers(0, 14)), rng)
        docs.append(make(int(rng.integers(0, 150))) + part + make(int(rng.integers(0, 150))))
    docs += ["", None, items[0].upper() + "\n\t", items[1][:30]]
    bench = spark.createDataFrame(list(enumerate(items)) + [(99, None), (98, "short")], "item_id long, text string")
    found = decontaminate.matches(documents(list(enumerate(docs))), bench).collect()
    got = {(r.doc_id, r.item_id): r.n_segments for r in found}
    expected = {}
    for (i, doc), (k, item) in itertools.product(enumerate(docs), enumerate(items)):
        n = brute_matches((doc or "").encode(), item.encode())
        if n:
            expected[i, k] = n
    assert got == expected and len(expected) > 10
    kept = decontaminate.without_matches(documents(list(enumerate(docs))), bench)
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {i for i, _ in expected}


def test_decontamination_in_blocks_and_pieces(spark, sample, monkeypatch):
    query = QUERIES["op3_decontaminate"]
    whole = sorted(map(tuple, query(spark, SMALL).collect()))
    assert whole
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    held = {(d, k) for d, t in sample for k, x in bench.items() if x in (t or "")}
    assert held <= {r[:2] for r in whole}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(decontaminate, "_STEP", 700)
    blocked = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = decontaminate.matches(blocked, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert {r[:2] for r in found.collect()} == {r[:2] for r in whole}


def test_decontamination_of_odd_and_empty(spark, documents, odd):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(documents(odd), empty).count() == 0
    bench = spark.createDataFrame([(None, "the same words again and again " * 4)] * 2, "item_id long, text string")
    found = decontaminate.matches(documents(odd, extra=True), bench).collect()
    assert sorted(r.doc_id for r in found) == [5, 5, 6] and {r.item_id for r in found} == {None}
    assert decontaminate.matches(documents([]), bench).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), max_size=8), st.integers(1, 4))
def test_boundaries_are_optimal(counts, buckets):
    def padding(upper):
        return sum(c * (min(u for u in upper if u >= n) - n) for n, c in counts.items())

    got = packing.boundaries(counts, buckets)
    if not counts:
        assert got == []
        return
    assert len(got) <= buckets and got[-1] == max(counts)
    lengths = sorted(counts)
    best = min(
        padding([*some, lengths[-1]])
        for k in range(buckets)
        for some in itertools.combinations(lengths[:-1], min(k, len(lengths) - 1))
    )
    assert padding(got) == best


def check_packing(rows, texts, max_tokens=2048, batch_tokens=65_536):
    length = Counter(len((t or "").encode().split()) + 1 for t in texts)
    pieces = Counter()
    for n, c in length.items():
        for start in range(0, n, max_tokens):
            pieces[min(max_tokens, n - start)] += c
    assert Counter(r.n_tokens for r in rows) == pieces
    upper = packing.boundaries(dict(pieces))
    batches = {}
    for r in rows:
        assert r.bucket_tokens == upper[r.bucket] == min(u for u in upper if u >= r.n_tokens)
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    for (bucket, batch), slots in batches.items():
        room = batch_tokens // upper[bucket]
        last = (bucket, batch + 1) not in batches
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) == room or (last and len(slots) <= room)


def test_packing(spark, sample, documents, odd):
    check_packing(QUERIES["op4_packing"](spark, SMALL).collect(), [t for _, t in sample])
    check_packing(packing.pack(documents(odd, extra=True)).collect(), [t for _, t in odd])
    assert packing.pack(documents([])).count() == 0


def statistics(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics_and_base_rule(spark, sample, documents, odd):
    registered = QUERIES["op9_outliers"](spark, SMALL).collect()
    texts = dict(sample)
    for r in registered:
        own = statistics(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        failed = own[0] < 20 or 100 * own[4] > 30 * own[0]
        assert r.base_failed == failed and not (failed and r.kept)
    rows = odd + [(60, "a\nb\na\n \n \nß|#\r\nß|#\r\n" * 3)]
    found = outliers.judge(documents(rows, extra=True)).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    got = sorted((tuple(r[n] for n in names) for r in found), key=key)
    assert got == sorted(((d, *statistics(t or "")) for d, t in rows), key=key)
    assert outliers.judge(documents([])).count() == 0


def test_outliers_are_rejected_and_others_kept(documents):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = [(i, text(int(rng.integers(60, 300))), "en", "a") for i in range(240)]
    rows += [(1000 + i, text(100) + " #$%" * 90, "en", "a") for i in range(12)]
    rows += [(2000 + i, text(80), None, None) for i in range(5)]
    found = {r.doc_id: r for r in outliers.judge(documents(rows)).collect()}
    assert all(found[i].kept for i in range(240))
    assert not any(found[1000 + i].kept for i in range(12))
    assert all(found[2000 + i].kept and found[2000 + i].judged_by == "all" for i in range(5))
    few = {r.doc_id: r for r in outliers.judge(documents(rows[:20] + [(7000, text(90) + " " + "#$%" * 90)])).collect()}
    assert all(r.kept and r.distance is None and r.judged_by is None for r in few.values())


def least_determinant(x):
    """Centre, inverse and scale of one group, by the stated rule on plain arrays."""
    def moments(rows):
        return rows.mean(0), np.cov(rows.T, bias=True) + np.diag(outliers._FLOOR)

    def distances(center, cov):
        off = x - center
        return np.maximum(np.einsum("ni,ij,nj->n", off, np.linalg.inv(cov), off), 0)

    def bins(d):
        return np.floor(np.log2(d + 2.0**-20) * outliers._BIN)

    def step(center, cov):
        place = bins(distances(center, cov))
        last = np.sort(place)[math.ceil(len(x) * outliers.SHARE) - 1]
        return moments(x[place <= last])

    low, mid, high = np.percentile(x, [25, 50, 75], axis=0)
    best = []
    for start in (moments(x), (mid, np.diag(((high - low) / 1.349) ** 2 + outliers._FLOOR))):
        now = step(*start)
        while True:
            following = step(*now)
            det = [np.linalg.slogdet(e[1])[1] for e in (now, following)]
            if not det[1] < det[0] - outliers.LEAST_FALL:
                break
            now = following
        best.append((det[0], now))
    center, cov = min(best, key=lambda b: b[0])[1]
    d = distances(center, cov)
    middle = np.sort(bins(d))[math.ceil(len(x) / 2) - 1]
    scale = max(1.0, 2.0 ** ((middle + 1) / outliers._BIN) / outliers.MEDIAN)
    return center, np.linalg.inv(cov), scale


def vector(text):
    words, chars, symbols, dups, repeats = statistics(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    values = [
        math.log1p(words),
        math.log(max(chars, 1) / max(words, 1)),
        math.sqrt(symbols / max(chars, 1)),
        dups / max(len(lines), 1),
        repeats / max(words, 1),
    ]
    return [math.floor(v * outliers.GRID + 0.5) / outliers.GRID for v in values]


def judged(rows):
    """(level, distance) of each (doc_id, text, lang, source) beyond the base rule."""
    x, groups = {}, {}
    for i, text, lang, source in rows:
        own = statistics(text or "")
        if own[0] >= 20 and 100 * own[4] <= 30 * own[0]:
            x[i] = vector(text)
            for key in ((lang, source), (lang, "*"), ("*", "*")):
                groups.setdefault(key, []).append(i)
    made, out = {}, {}
    for i, text, lang, source in rows:
        if i not in x:
            continue
        for level, key in zip(outliers.LEVELS, ((lang, source), (lang, "*"), ("*", "*"))):
            if len(groups[key]) >= outliers.MIN_ROWS:
                if key not in made:
                    made[key] = least_determinant(np.array([x[d] for d in groups[key]]))
                center, inverse, scale = made[key]
                off = np.array(x[i]) - center
                out[i] = (level, off @ inverse @ off / scale)
                break
    return out


def test_outliers_as_by_plain_arrays_at_every_level(spark, documents):
    rng = np.random.default_rng(18)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(900)]
    rows = []
    shapes = [("en", "a", 400), ("en", "b", 70), ("en", "c", 9), ("en", None, 6), ("fr", "a", 30), ("fr", "b", 31)]
    for lang, source, n in [*shapes, ("de", "a", 20), (None, "a", 8)]:
        for i in range(n):
            text = " ".join(rng.choice(words, int(rng.integers(25, 400))))
            if i % 11 == 3:
                text += " " + "#$%&" * int(rng.integers(20, 200))
            rows.append((len(rows), text, lang, source))
    rows += [(len(rows), "too short", "en", "a"), (len(rows) + 1, None, "en", "c")]
    expected = judged(rows)
    gone = {level for level, d in expected.values() if d > outliers.CUT}
    assert gone == {level for level, _ in expected.values()} == set(outliers.LEVELS)
    for r in outliers.judge(documents(rows)).collect():
        if r.base_failed:
            assert r.doc_id not in expected and r.judged_by is None and not r.kept
            continue
        level, distance = expected[r.doc_id]
        assert r.judged_by == level and r.distance == pytest.approx(distance, rel=1e-6, abs=1e-6)
        assert r.kept == (distance <= outliers.CUT)
    sample = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sample}/documents.parquet").collect()
    expected = judged([(r.doc_id, r.text, r.lang, r.source) for r in docs])
    found = QUERIES["op9_outliers"](spark, sample).collect()
    assert {r.doc_id: r.judged_by for r in found if not r.base_failed} == {
        i: level for i, (level, _) in expected.items()
    }
    assert {r.doc_id for r in found if r.kept} == {i for i, (_, d) in expected.items() if d <= outliers.CUT}


def test_concentration_steps_lower_the_determinant(documents, stage):
    rng = np.random.default_rng(9)
    rows = [(i, "word " + " ".join(str(rng.integers(0, 10**6)) for _ in range(rng.integers(25, 400)))) for i in range(300)]
    table = outliers.statistics(documents(rows)).withColumn("base_failed", outliers.base_failed())
    table = outliers._keys(table).select("*", *[f.alias(x) for f, x in zip(outliers._features(), outliers._X)])
    now = stage.table(outliers._starts(table), "s0")
    now = stage.table(outliers._concentrate(table, now), "s1")
    before = {r.start: r.log_det for r in now.collect()}
    for step in range(2, 5):
        now = stage.table(outliers._concentrate(table, now), f"s{step}")
        after = {r.start: r.log_det for r in now.collect()}
        assert all(after[s] <= before[s] + 1e-9 for s in before)
        before = after


def toxic_corpus(n=600):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text, toxic = list(rng.choice(words, 40)), i % 5 == 0
        quality = int(i % 3 != 0)
        if toxic:
            text[7] = text[21] = ("grumbul", "zwackel", "grumbulen")[i % 3]
        if not quality:
            text[11] = "spamspam"
        rows.append((i, " ".join(text)))
        labels.append((i, quality, int(toxic)))
    return rows, labels


def test_chain_on_held_out_rows(spark, documents):
    rows, labels = toxic_corpus()
    docs = documents(rows, extra=True)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.fit(docs, table.filter("doc_id % 4 <> 0"))
    found = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    held = [(i, t) for i, _, t in labels if i % 4 == 0]
    right = sum(found[i].toxic == bool(t) for i, t in held)
    assert right >= 0.97 * len(held)
    assert all(found[i].kept != found[i].toxic for i, _ in rows)
    kept = toxicity.without_toxic(docs, chain)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in found if found[i].kept}


def test_toxicity_without_usable_labels(spark, documents, odd):
    docs = documents(odd, extra=True)
    for labels in ([], [(5, None, 1)], [(77, 1, 1)], [(5, 1, 1), (6, 1, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        rows = toxicity.score(docs, toxicity.fit(docs, table)).collect()
        assert len(rows) == len(odd) and not any(r.toxic for r in rows)
        assert all(r.p_toxic is None for r in rows)
    assert toxicity.score(documents([]), toxicity.fit(docs, table)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("aBc .é\n", max_size=40), min_size=1, max_size=6))
def test_features_are_those_of_each_text(texts):
    data = [t.encode() for t in texts]
    edges = np.cumsum([0, *map(len, data)])
    row, feature = toxicity.features(np.frombuffer(b"".join(data), np.uint8), edges)
    for i, own in enumerate(data):
        _, alone = toxicity.features(np.frombuffer(own, np.uint8), np.array([0, len(own)]))
        assert feature[row == i].tolist() == alone.tolist()
    assert runs.PIECE > 0


def test_disclosing_terms_go_wherever_they_stand(documents):
    filler = "plain words of no note at all "
    # Copies count once, so all texts differ.
    rows = [(i, f"{filler * 3} {i}") for i in range(200)]
    rows += [(200 + i, f"Quillfeather {filler * 4} wrote bob@x.org {filler} {i}") for i in range(5)]
    rows += [(300, f"{filler} QUILLFEATHER alone"), (301, f"{filler} QUILLFEATHER alone 1")]
    rows += [(400, f"{filler * 5} Quillfeather, {filler}"), (401, f"{filler * 5} Quillfeather, {filler} 1")]
    docs = documents(rows)
    share = {(r.entity, r.term): r.share for r in pii.disclosures(keyed(docs), pii.detect(keyed(docs))).collect()}
    n, df, entity = len(rows), 9, 5
    expected = math.log2(5 * n / (entity * df)) / math.log2(n / entity)
    assert expected < pii.THRESHOLD and ("email:bob@x.org", "quillfeather") not in share
    rows = [r for r in rows if r[0] not in (301, 401)]
    rows += [(500 + i, f"{filler} {i} {i}") for i in range(5000)]
    docs = documents(rows)
    share = {(r.entity, r.term): r.share for r in pii.disclosures(keyed(docs), pii.detect(keyed(docs))).collect()}
    expected = math.log2(5 * len(rows) / (entity * 7)) / math.log2(len(rows) / entity)
    assert share[("email:bob@x.org", "quillfeather")] == pytest.approx(expected) and expected >= pii.THRESHOLD
    clean = {r.doc_id: r.text for r in pii.sanitize(docs).collect()}
    assert not any("quillfeather" in t.lower() for t in clean.values())
    assert clean[300] == f"{filler} [TERM] alone" and clean[400] == f"{filler * 5} [TERM], {filler}"


def brute_spans(rows):
    """All spans of (key, text) rows, from the definition: counts over different texts."""
    import regex

    term = regex.compile(r"\p{L}[\p{L}\p{N}]{2,}+")
    touching = regex.compile("[\\p{L}\\p{N}]*+\ue000[\\p{L}\\p{N}]*+")

    def parts(text):
        found = []
        for s in filter(None, base_spans(text).split(",")):
            kind, a, b = s.split(":")
            found.append((int(a), int(b), kind))
        return found

    def named(kind, value):
        return f"{kind}:{re.sub('[^0-9]', '', value) if kind in ('card', 'phone') else value.lower()}"

    texts = {t or "" for _, t in rows}
    words = {t: {w.lower() for w in term.findall(t)} for t in texts}
    df = Counter(w for t in texts for w in words[t])
    entities, outside = {}, {}
    for t in texts:
        spans = parts(t)
        entities[t] = {named(k, t[a:b]) for a, b, k in spans}
        out, at = "", 0
        for a, b, _ in spans:
            if a >= at:
                out += t[at:a] + "\ue000"
            at = max(at, b)
        outside[t] = {w.lower() for w in term.findall(touching.sub(" ", out + t[at:]))}
    held = Counter(e for t in texts for e in entities[t])
    n, share = len(texts), {}
    for e, k in held.items():
        if k < pii.SUPPORT or k == n:
            continue
        both = Counter(w for t in texts if e in entities[t] for w in outside[t])
        for w, m in both.items():
            value = math.log2(m * n / (k * df[w])) / math.log2(n / k)
            if m >= pii.SUPPORT and value >= pii.THRESHOLD:
                share[w] = max(share.get(w, 0), value)
    result = []
    for key, t in rows:
        t = t or ""
        base = parts(t)
        spans = [(a, list(PATTERNS).index(k), b, k) for a, b, k in base]
        for m in term.finditer(t):
            a, b = m.span()
            if m[0].lower() in share and not any(x < b and a < y for x, y, _ in base):
                spans.append((a, len(PATTERNS), b, "term"))
        result.append((key, ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))))
    return sorted(result, key=str), share


def test_all_spans_against_brute_force(documents, sample):
    filler = "plain words of no note at all"
    rows = [(10**6 + i, t) for i, t in sample]
    rows += [(i, f"{filler} Quillfeather Zöllner wrote bob@x.org about {i} Ostrich{i % 2}") for i in range(4)]
    rows += [(10 + i, f"QUILLFEATHER {i} and zöllner, +49 30 1234567 nearby Marble") for i in range(1)]
    # Copies of one text with an address: its rare words disclose nothing.
    rows += [(20 + i, f"{filler} uniquely oddword for eve@y.org") for i in range(5)]
    rows += [(30, "oddword uniquely again"), (31, None), (None, ""), (32, "x@y.zz x@y.zz")]
    rows += [(33, "one ip 10.0.0.1 Basalt"), (34, "Basalt two ip 10.0.0.1"), (34, "Basalt two ip 10.0.0.1")]
    expected, share = brute_spans(rows)
    assert {"quillfeather", "zöllner", "basalt"} <= share.keys() and "oddword" not in share
    found = pii.spans(keyed(documents(rows, extra=True)))
    text = pii._text_of_spans(F.col("all_spans"))
    got = [(None if r.id == -(2**63) else r.id, r.s) for r in found.select("id", text.alias("s")).collect()]
    assert sorted(got, key=str) == expected


def test_many_terms_are_met_by_a_shuffle(documents, monkeypatch):
    rows = [(i, f"filler {i} Quillfeather wrote bob@x.org") for i in range(3)]
    rows += [(10 + i, f"filler {i} only") for i in range(30)] + [(50, "the Quillfeather")]
    expected, _ = brute_spans(rows)
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    found = pii.spans(keyed(documents(rows)))
    text = pii._text_of_spans(F.col("all_spans"))
    assert sorted(((r.id, r.s) for r in found.select("id", text.alias("s")).collect()), key=str) == expected


def test_many_entities_of_one_text_form_one_class(documents):
    many = " ".join(f"name{i}@host{i}.org Word{chr(97 + i % 26)}x{i}" for i in range(1200))
    docs = keyed(documents([(1, many), (2, many + " second"), (3, "else"), (4, "more text")]))
    found = pii.disclosures(docs, pii.detect(docs)).collect()
    assert len({r.entity for r in found}) == 1 and len(found) == 1200


def test_decontamination_finds_parts_wherever_they_start():
    rng = np.random.default_rng(6)
    make = lambda n: "".join(rng.choice(list("abcdefghij "), n)).replace("  ", " a").encode()
    item, other = decontaminate.normal(make(420)), decontaminate.normal(make(90))
    index = decontaminate.Index([(1, item), (2, other), (3, b"zq forty two"), (4, b"zq"), (5, b"")])
    found = lambda text: {m[0] for m in decontaminate.matches_in(index, text)}
    for whole, k in ((item, 1), (other, 2)):
        for size in (decontaminate.FOUND, 80, 93, 110, 130):
            for at in range(len(whole) - size + 1):
                assert k in found(b"#" * 31 + whole[at : at + size] + b"#" * 17), (size, at)
    assert found(b"so ZQ\nforty two.") == {3, 4} and found(b"zq") == {4}
    assert found(b"zqs azq zq1") == set() and found(b"zqs zq") == {4}
    assert found(b"") == set() and found(make(300)) == set()


def test_decontamination_in_lots_and_windows_is_the_same(monkeypatch):
    rng = np.random.default_rng(23)
    make = lambda n, letters: bytes(rng.choice(list(letters), n).astype(np.uint8))
    items = [b"x" * 400, b"ab" * 70, make(300, b"ab"), make(150, b"abcdefgh "), b"y" * 61 + make(90, b"abc")]
    items = [(i, decontaminate.normal(t)) for i, t in enumerate(items)]
    index = decontaminate.Index(items)
    texts = [b"x" * 9000, b"ab" * 3000 + b"x" * 90, b"q" * 5000 + items[2][1] + b"y" * 7000]
    texts += [make(6000, b"ab"), items[3][1][:80] + make(4500, b"ab") + items[3][1], b"xxxxxxx!" * 900]
    for _ in range(4):
        part = damaged(items[int(rng.integers(2, 5))][1].decode(), 4, rng).encode()
        texts.append(make(5000, b"ab") + part + make(3000, b"abcdefgh ") + part)
    monkeypatch.setattr(decontaminate, "HITS", 1 << 40)
    whole = [decontaminate.matches_in(index, t) for t in texts]
    assert {m[0] for found in whole for m in found} == {0, 1, 2, 3, 4}
    for hits, window in ((60_000, 4096), (3_000, 500), (200, 250)):
        monkeypatch.setattr(decontaminate, "HITS", hits)
        monkeypatch.setattr(decontaminate, "WINDOW", window)
        # An end may be another of several with the same edits where a window cuts the band.
        for text, rows in zip(texts, whole):
            found = decontaminate.matches_in(index, text)
            assert [r[:3] for r in found] == [r[:3] for r in rows]
            assert all(abs(a[3] - b[3]) <= 2 * decontaminate.SEGMENT * decontaminate.RATE for a, b in zip(found, rows))


def test_decontamination_of_repetitive_texts_is_bounded():
    tracemalloc = pytest.importorskip("tracemalloc")
    items = [(0, b"x" * 400), (1, b"x" * 200 + b"y" * 90), (2, b"the same words " * 40)]
    index = decontaminate.Index(items)
    tracemalloc.start()
    try:
        for text in (b"x" * 3_000_000, b"the same words " * 150_000):
            assert {m[0] for m in decontaminate.matches_in(index, text)} in ({0, 1}, {2})
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 300 << 20


def test_index_holds_a_bounded_number_of_bytes():
    import tracemalloc

    rng = np.random.default_rng(24)
    items = [(i, rng.integers(97, 123, 4000).astype(np.uint8).tobytes()) for i in range(256)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    try:
        index = decontaminate.Index(items)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    fixed = index.seen.nbytes
    assert held - fixed < 30 * size and peak - fixed < 60 * size
    brute = {(i, s, t[s : s + n]) for i, t in items[:3] for n, step in ((100, 50), (60, 10)) for s in range(0, len(t) - n + 1, step)}
    assert brute == {(i, s, p) for i, t in items[:3] for s, p in decontaminate.segments(t)}


def test_training_rows_are_bounded_where_ids_repeat(spark):
    # Whichever ids the hash picks, one that holds a third of both tables counts once.
    ids = list(range(2000))
    for hot in (3, 4, 5, 6):
        labels = spark.createDataFrame(
            [(i, 1, 0) for i in ids] + [(hot, 0, 1)] * 1000, "doc_id long, quality int, toxic int"
        )
        docs = spark.createDataFrame(
            [(i, f"text {i}") for i in ids] + [(hot, "a text"), (hot, None)] * 500, "doc_id long, text string"
        )
        every = toxicity.training_rows(docs, labels, 5000).collect()
        assert sorted(r.doc_id for r in every) == ids
        own = next(r for r in every if r.doc_id == hot)
        assert (own.quality, own.toxic, own.text) == (1, 1, "")
        some = toxicity.training_rows(docs, labels, 200).collect()
        assert 100 < len(some) < 300 and len({r.doc_id for r in some}) == len(some)


def test_places_are_whole_where_rows_repeat(spark, documents, monkeypatch):
    from pricewright.llm import sharding, tables

    monkeypatch.setattr(tables, "RUN", 7)
    rows = [(i, "a b " * (i % 9)) for i in range(300)] + [(5, "same row")] * 150 + [(None, None)] * 20
    rows += [(6, f"other text {i}") for i in range(150)]
    docs = documents(rows)
    check_packing(packing.pack(docs).collect(), [t for _, t in rows])
    placed = sharding.shard(docs).collect()
    assert sorted(r.row_number for r in placed) == list(range(len(rows)))
    sized = lambda t: len((t or "").encode()) + 8
    assert Counter((r.doc_id, r.size) for r in placed) == Counter((d, sized(t)) for d, t in rows)
    for shard in range(sharding.SHARDS):
        slots = sorted(r.slot for r in placed if r.shard == shard)
        assert slots == list(range(len(slots))) and abs(len(slots) - len(rows) / sharding.SHARDS) < 1
