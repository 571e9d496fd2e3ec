"""Token counts, divergence of sources and interaction of filters."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from cases import SMALL
from hypothesis import example, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from pricewright.llm import divergence, filter_audit, token_counts
from pricewright.llm.queries import QUERIES

LABELS = T.StructType(
    [T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("quality", T.IntegerType()), ("toxic", T.IntegerType()))]
)


# --- token counts ---------------------------------------------------------------------------------


@pytest.fixture(scope="session")
def made():
    with open(token_counts.vocabulary(), encoding="utf-8") as file:
        return token_counts.tokenizer(token_counts.checked(file.read()))


def whole(made, text):
    return len(made.encode(text or "", add_special_tokens=False))


PARTS = st.sampled_from(
    [" ", "  ", "\n", "\t \n", "'", "'ll", "'s", "l", "word", "Ünï", "漢字", "🙂", "12", "3.4", "!?", "<|"]
    + ["<|endoftext|>", "endoftext|>", "|>", "\x00", " ", " ", "a" * 70, " " * 70]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=120).map("".join), st.integers(1, 40), st.integers(1, 40))
@example("a'll b'll " * 40, 7, 18)
@example("<|endoftext|>" * 40, 5, 20)
@example(" " * 400 + "x", 9, 19)
@example("x" * 400 + " y", 9, 19)
@example(("  <|endoftext|>  \n" * 30), 11, 17)
def test_spliced_counts_are_those_of_the_whole(made, text, chunk, overlap):
    assert token_counts.count_long(made, text, chunk, overlap) == whole(made, text)


def test_widening_passes_whole_chunks(made):
    text = "start " + "q" * 5000 + " middle " + "!" * 3000 + "\n" * 4000 + "end <|endoftext|>"
    assert token_counts.count_long(made, text, 64, 32) == whole(made, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS | st.sampled_from([" word", " a'll", " \x85b", " x\u180e "]), max_size=60).map("".join)))
def test_counts_by_words_are_those_of_the_whole(made, texts):
    known = {}
    for part in (texts, texts[::-1]):
        got = token_counts.count_texts(made, part, known=known)
        assert got == [whole(made, text) for text in part]
    assert all(len(word) <= token_counts.LONGEST for word in known)


class _Counting:
    """A tokenizer that notes how many characters it encodes."""

    def __init__(self, made):
        self.made, self.model, self.seen = made, made.model, 0

    def get_added_tokens_decoder(self):
        return self.made.get_added_tokens_decoder()

    def encode_batch_fast(self, texts, **given):
        self.seen += sum(map(len, texts))
        return self.made.encode_batch_fast(texts, **given)


def test_a_word_is_encoded_once(made, monkeypatch):
    monkeypatch.setattr(token_counts, "BATCH", 5000)
    texts = [f"Möwe {i}, die übermütig  über Wörter fliegt.\n" * 40 for i in range(50)]
    counting = _Counting(made)
    assert token_counts.count_texts(counting, texts) == [whole(made, text) for text in texts]
    assert counting.seen < sum(map(len, texts)) / 20


def test_few_words_are_kept(made, monkeypatch):
    monkeypatch.setattr(token_counts, "WORDS", 10)
    monkeypatch.setattr(token_counts, "BATCH", 100)
    texts, known = [f"{i} words and {i * i} more" for i in range(300)], {}
    assert token_counts.count_texts(made, texts, known=known) == [whole(made, t) for t in texts]
    assert len(known) < 60


@pytest.mark.parametrize("added", ["two words", "other"])
def test_an_added_token_across_a_cut_or_in_a_word(added):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(token_counts.vocabulary())
    made.add_tokens([added])
    texts = ["of two words and another", "two  words or two words"]
    assert token_counts.count_texts(made, texts) == [whole(made, text) for text in texts]


def test_token_counts_of_odd_rows(spark, documents, made, odd):
    rows = [*odd, (20, "<|endoftext|> and <|endoftext|>"), (21, "word " * 512), (22, "word " * 30000)]
    got = token_counts.count_tokens(documents(rows, extra=True), chunk=200, overlap=32).collect()
    expected = Counter()
    for doc_id, text in rows:
        n = whole(made, text)
        expected[(doc_id, len((text or "").encode()), n, n > 512)] += 1
    assert Counter(map(tuple, got)) == expected


def test_registered_token_counts(spark, sample, made):
    got = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, SMALL).collect()}
    assert len(got) == len(sample)
    for doc_id, text in sample:
        n = whole(made, text)
        row = got[doc_id]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 512)


def test_token_counts_of_no_rows(documents):
    assert token_counts.count_tokens(documents([])).count() == 0


def test_tokenizers_without_proof_are_refused(tmp_path, documents):
    with open(token_counts.vocabulary("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    with pytest.raises(ValueError):
        token_counts.checked(definition)


# --- divergence of sources ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_divergence(rows, support=3, top=200):
    """From (text, lang, source): the rows of both parts, by their definition."""
    rows = [(t or "", lang or "", source or "") for t, lang, source in rows]
    count, spread, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = TERM.findall(text.translate(LOWER))
        count[lang, source].update(found)
        spread[lang].update(set(found))
        langs[lang].add(source)
    out = []

    def ranked(lang, source, part, values, limit):
        values.sort(key=lambda v: (-v[1], v[0].encode()))
        for rank, (item, value) in enumerate(values[:limit], 1):
            out.append((lang, source, part, item, value, rank))

    for lang, sources in langs.items():
        kept = [t for t, n in spread[lang].items() if n >= support]
        both = {s: count[lang, s] for s in sources}
        both[None] = sum((count[lang, s] for s in sources), Counter())
        size = {s: sum(c[t] for t in kept) + len(kept) for s, c in both.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // size[s] for t in kept} for s, c in both.items()}
        for s in sources:
            terms = [
                (t, (p[s][t] - p[None][t]) ** 2 // p[None][t])
                for t in kept
                if both[s][t] and p[s][t] > p[None][t]
            ]
            ranked(lang, s, "term", terms, top)
            pairs = [
                (o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources - {s}
            ]
            ranked(lang, s, "pair", pairs, None)
    return out


def divergence_of(documents, rows, **options):
    table = documents([(i, *row) for i, row in enumerate(rows)], extra=True)
    got = divergence.audit(table, **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


def test_divergence_against_brute_force(documents):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Éa", "漢字", "ZZ"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    rows = []
    for i in range(150):
        found = rng.choice(vocabulary, rng.integers(0, 60), p=weights / weights.sum())
        glue = str(rng.choice([" ", "1", "-", "\x00", "\n"]))
        # A third of all rows are in one group.
        lang, source = ("en", "a") if i % 3 == 0 else (str(rng.choice(["en", "fr"])), f"s{i % 7}")
        rows.append((glue.join(found), lang, source))
    rows += [(None, "en", "a"), ("", "fr", "empty"), ("alone here", "xx", "only"), ("?", "yy", "one")]
    rows += [("un deux", "zz", "a"), ("un", "zz", "b"), (None, None, None), ("wa wa", None, "s1")]
    rows += [("same row same", "en", "s1")] * 4
    assert divergence_of(documents, rows) == sorted(brute_divergence(rows))


def test_ranks_among_ties(documents):
    """Many terms of one value: the first in UTF-8 order are kept, and the ranks run on."""
    names = [f"t{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{'é' * (i % 2)}" for i in range(600)]
    rows = [(" ".join(names), "en", "a")] * 3 + [("ta tb " * 5, "en", "b")] * 3
    rows += [("extra " * 3 + "more", "en", "a")] * 3
    got = divergence_of(documents, rows)
    assert got == sorted(brute_divergence(rows))
    assert max(r[5] for r in got if r[2] == "term" and r[1] == "a") == 200


def test_divergence_of_no_rows(documents):
    assert divergence_of(documents, []) == []


def test_long_texts_are_split_in_slices():
    text = ("Word é1漢字 " * 50 + "z" * 300 + " end").encode()
    expected = [t.encode() for t in TERM.findall(text.decode().translate(LOWER))]
    for size in (1, 2, 3, 7, 64, 10**6):
        assert [t for part in divergence.terms_of(text, size) for t in part] == expected


def test_counts_are_handed_on_when_too_many(documents, monkeypatch):
    rows = [(f"wa wb wc w{chr(97 + i % 5)}x", "en", f"s{i % 2}") for i in range(40)]
    held = [(t, lang, s) for t, lang, s in rows]
    batch = documents([(i, *r) for i, r in enumerate(held)]).toArrow().to_batches()
    binary = [
        b.set_column(1, "text", b.column("text").cast("binary")) for b in batch
    ]
    monkeypatch.setattr(divergence, "HELD", 3)
    totals = Counter()
    parts = list(divergence._count(iter(binary)))
    assert len(parts) > 2
    for part in parts:
        for row in part.to_pylist():
            totals[row["source"], row["term"], "n"] += row["occurrences"]
            totals[row["source"], row["term"], "d"] += row["docs"]
    assert totals["s0", "wa", "n"] + totals["s1", "wa", "d"] == 40


def test_blocks_of_pairs_give_equal_cells(spark, documents, monkeypatch):
    rows = [(f"wa wb w{chr(97 + i % 9)}", "en", f"s{i % 6}") for i in range(60)]
    terms = divergence.term_counts(documents([(i, *r) for i, r in enumerate(rows)]))
    batches = terms.select("lang", "entries").toArrow().to_batches()

    def cells():
        out = Counter()
        for part in divergence._shared(iter(batches)):
            for r in part.to_pylist():
                assert r["source"] < r["item"]
                out[r["lang"], r["source"], r["item"], r["x"], r["y"]] += r["times"]
        return out

    at_once = cells()
    monkeypatch.setattr(divergence, "PAIRS", 2)
    assert cells() == at_once


def test_shares_are_exact(spark):
    counts = [(0, 1), (0, 3), (2, 3), (10**6, 10**9 + 7), (9 * 10**15, 9 * 10**15 + 1), (6, 7)]
    df = spark.createDataFrame(counts, "count long, seen long")
    got = df.select("count", "seen", divergence.share(F.col("count"), F.col("seen")).alias("p"))
    for r in got.collect():
        assert r.p == 1 + 10**9 * (r["count"] + 1) // r.seen


def test_registered_divergence(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang", "source")
    got = sorted(map(tuple, QUERIES["op12_source_divergence"](spark, SMALL).collect()))
    assert got == sorted(brute_divergence([tuple(r) for r in rows.collect()]))


# --- interaction of filters -----------------------------------------------------------------------

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_filters(rows, labels):
    """From (doc_id, text, lang) and (doc_id, quality, toxic): the result by its definition."""
    least = {}
    for doc_id, text, _ in rows:
        i = -(2**63) if doc_id is None else doc_id
        least[text or ""] = min(least.get(text or "", i), i)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    found = defaultdict(list)
    for doc_id, text, lang in rows:
        t = text or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": (-(2**63) if doc_id is None else doc_id) > least[t],
        }
        failing = {f for f, is_so in fails.items() if is_so}
        found[lang or ""].append((failing, doc_id in good, doc_id in toxic))
    out = []
    for part, docs in found.items():
        shapley = Counter()
        mine = []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(removed)
                redundant = sum(f in d[0] and bool(d[0] & before) for d in docs)
                unique = sum(d[0] == {f} for d in docs)
                lost = sum(d[1] for d in removed), sum(d[2] for d in removed)
                mine.append(
                    (part, order, step, len(left), len(removed), redundant, unique, *lost)
                )
        out += [(*row, shapley[row[1][row[2] - 1]]) for row in mine]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails"]
COLUMNS += ["good_lost", "toxic_lost", "shapley"]


def check_filters(spark, documents, rows, labels, extra=True):
    table = documents([(d, t, lang, "web") for d, t, lang in rows], extra=extra)
    got = filter_audit.audit(table, spark.createDataFrame(labels, LABELS))
    assert got.columns == COLUMNS
    result = sorted(map(tuple, got.collect()))
    assert result == brute_filters(rows, labels)
    return result


def test_filters_against_brute_force(spark, documents):
    rng = np.random.default_rng(3)
    pieces = ["plain words here", "UPPER CASE", "a # sign", " ".join(f"w{i}" for i in range(120)), "x"]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(pieces, rng.integers(0, 4)))
        # A third of the rows are one text.
        rows.append((i, "copied text" if i % 3 == 0 else text, str(rng.choice(["en", "fr"]))))
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 160, 2)]
    result = check_filters(spark, documents, rows, labels)
    assert len(result) == 2 * 600


def test_filters_of_odd_rows(spark, documents, odd):
    rows = [(d, t, "en") for d, t in odd]
    # Null ids, rows and ids that repeat, one id with several texts and languages.
    rows += [(None, "null id " * 20, None), (None, None, "en"), (None, None, None)]
    rows += [(5, "another text of 5", "fr"), (5, "another text of 5", "en")]
    rows += [(50 + i, "", "en") for i in range(3)] + [(40, "x" * 3000, None)]
    labels = [(5, 1, 0), (5, 0, 1), (6, None, 1), (None, 1, 1), (9, 1, None), (99, 1, 1), (6, 1, 0)]
    check_filters(spark, documents, rows, labels)


def test_filters_of_no_rows_or_labels(spark, documents):
    assert check_filters(spark, documents, [], [(1, 1, 1)]) == []
    check_filters(spark, documents, [(1, "some", "en"), (2, "some", "en")], [])


def test_registered_filter_audit(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic")
    got = sorted(map(tuple, QUERIES["op13_filter_audit"](spark, SMALL).collect()))
    rows = [tuple(r) for r in docs.collect()]
    assert got == brute_filters(rows, [tuple(r) for r in labels.collect()])
