"""Source divergence audit by ranked count cells.

How far the words of a (language, source) group depart from those of its language, term by term, and
from those of the language's other sources, summed over the terms.

Method: a term's divergence depends on its count in the group and its count in the language alone, so
terms are grouped into cells of (group count, language count). The divergence is evaluated once a
cell; cells of one group are ranked by cumulative multiplicity, equal values merged, and only the cells
that reach the wanted ranks are expanded into their terms, in UTF-8 order. For pairs of sources a term
that occurs in neither, or in one of the two, is covered by the sources' own count histograms; cells
of (count here, count there) are formed only for terms that occur in both. So

    sum over terms of f(x, y) = sum f(x, 0) + sum f(0, y) + (V - n_s - n_t) f(0, 0)
        + sum over terms in both of f(x, y) - f(x, 0) - f(0, y) + f(0, 0)

Texts are split in tasks, a bounded slice at a time, and counts are combined there before they are
shuffled. A kept term is one row with its counts by source. Every further exchange carries cells.

All arithmetic is on whole numbers and exact: shares by long division in base 1000, for up to 9e15
occurrences; sums raise an error past the range of a long (possible from 2e8 kept terms a language on).

Defined cases: null texts, languages and sources are empty strings. A group without kept terms, and a
language without any, still has its pairs, with value 0 in the latter case. A source that is alone in its
language has no pairs. Rows are documents, repeated or not; ``doc_id`` and all other columns are not used.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..stage import Stage
from .tables import read, stage

#: Documents of a language that a term must occur in.
SUPPORT = 3
#: Ranks of the term part.
TOP = 200
#: Distinct entries that a task holds before it hands them on.
HELD = 400_000
#: Bytes of a text that are split at once.
SLICE = 1 << 22
#: Pairs of entries that are formed at once.
PAIRS = 1 << 21

_LETTERS = {*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)}
#: A-Z become a-z, other ASCII becomes a blank. UTF-8 bytes from 0x80 on stay, so no character is cut.
FOLD = bytes(c if c in _LETTERS else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms_of(text: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about ``size`` bytes."""
    rest, at = b"", 0
    while at < len(text):
        piece = rest + text[at : at + size].translate(FOLD)
        at += size
        cut = piece.rfind(b" ") + 1 if at < len(text) else len(piece)
        rest = piece[cut:]
        yield piece[:cut].split()


def _counted(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        terms = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([counts[t] for t in terms], pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64()),
            ],
            ["lang", "source", "term", "occurrences", "docs"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term, combined over a task."""
    held: dict = defaultdict(lambda: (Counter(), Counter()))
    entries = 0
    for batch in batches:
        langs, sources, texts = (batch.column(c) for c in ("lang", "source", "text"))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
            counts, docs = held[lang, source]
            entries -= len(counts)
            once: set[bytes] = set()
            for found in terms_of(text.as_py()):
                counts.update(found)
                once.update(found)
            docs.update(once)
            entries += len(counts)
            if entries > HELD:
                yield from _counted(held)
                held.clear()
                entries = 0
    yield from _counted(held)


def term_counts(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``lang, term, total, entries`` of every kept term; ``entries`` are its sources and counts."""
    rows = docs.select(
        *_names(docs),
        F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    schema = "lang string, source string, term string, occurrences long, docs long"
    return (
        rows.mapInArrow(_count, schema)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("occurrences").alias("count"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("count").alias("total"),
            F.sum("docs").alias("docs"),
            F.collect_list(F.struct("source", "count")).alias("entries"),
        )
        .filter(F.col("docs") >= support)
        .select("lang", "term", "total", F.sort_array("entries").alias("entries"))
    )


def _names(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def share(count: Column, seen: Column) -> Column:
    """1 + floor(10 ** 9 * (count + 1) / seen), exactly: three digits of base 1000."""
    rest, out = count + 1, F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + F.call_function("div", rest, seen)
        rest = rest % seen
    return out + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_sizes(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``lang, source, n, seen, lang_seen, v``: occurrences with one added for each kept term, in the
    group and in the language, and the numbers of kept terms that occur in the group and in all."""
    entries = terms.select("lang", F.inline("entries"))
    sizes = entries.groupBy("lang", "source").agg(
        F.sum("count").alias("size"), F.count("*").alias("n")
    )
    langs = terms.groupBy("lang").agg(F.sum("total").alias("lang_size"), F.count("*").alias("v"))
    return (
        docs.select(*_names(docs))
        .distinct()
        .join(sizes, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0)
        .selectExpr("lang", "source", "n", "size + v AS seen", "lang_size + v AS lang_seen", "v")
    )


def top_terms(terms: DataFrame, groups: DataFrame, store: Stage, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: the terms a group uses more than its language does."""
    entries = terms.select("lang", "term", "total", F.inline("entries"))
    p, q = share(F.col("count"), F.col("seen")), share(F.col("total"), F.col("lang_seen"))
    cells = (
        entries.groupBy("lang", "source", "count", "total")
        .agg(F.count("*").alias("times"))
        .join(groups, ["lang", "source"])
        .withColumn("p", p)
        .withColumn("q", q)
        .filter("p > q")
        .select("lang", "source", "count", "total", "times", divergence(F.col("p"), F.col("q")).alias("value"))
    )
    cells = store.table(cells, "cells")
    # A value stands for one term at least, so no more values than ranks are of use.
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    earlier = best.rowsBetween(Window.unboundedPreceding, -1)
    values = (
        cells.groupBy("lang", "source", "value")
        .agg(F.sum("times").alias("times"))
        .withColumn("at", F.row_number().over(best))
        .filter(F.col("at") <= top)
        .withColumn("before", F.coalesce(F.sum("times").over(earlier), F.lit(0)))
        .filter(F.col("before") < top)
        .select("lang", "source", "value", "before")
    )
    reached = store.table(cells.join(values, ["lang", "source", "value"]), "reached")
    # A value's terms are cut to the ranks before they are shuffled, however many it has.
    order = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        entries.join(reached.drop("times"), ["lang", "source", "count", "total"])
        .withColumn("at", F.row_number().over(order))
        .filter(F.col("at") <= top)
        .withColumn("rank", (F.col("before") + F.col("at")).cast("int"))
        .filter(F.col("rank") <= top)
        .select("lang", "source", F.col("term").alias("item"), "value", "rank")
    )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of (count, count) of the sources that a term occurs in, combined a block at a time."""
    for batch in batches:
        lists = batch.column("entries")
        flat = lists.flatten()
        sources = flat.field("source").dictionary_encode()
        langs = batch.column("lang").dictionary_encode()
        source = sources.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        count = flat.field("count").to_numpy(zero_copy_only=False)
        length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), length)
        # Each entry is paired with those after it in its list, which have larger sources.
        following = np.repeat(np.cumsum(length), length) - np.arange(len(source)) - 1
        blocks = np.flatnonzero(np.diff(np.cumsum(following) // PAIRS)) + 1
        for block in np.split(np.arange(len(source)), blocks):
            each = following[block]
            left = np.repeat(block, each)
            if not len(left):
                continue
            step = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each)
            right = left + 1 + step
            size = len(sources.dictionary)
            pair = (lang[left] * size + source[left]) * size + source[right]
            x, y = count[left], count[right]
            order = np.lexsort((y, x, pair))
            pair, x, y = pair[order], x[order], y[order]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            first = np.flatnonzero(new)
            pair = pair[first]
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(pair // size // size)),
                    sources.dictionary.take(pa.array(pair // size % size)),
                    sources.dictionary.take(pa.array(pair % size)),
                    pa.array(x[first]),
                    pa.array(y[first]),
                    pa.array(np.diff(np.append(first, len(new)))),
                ],
                ["lang", "source", "item", "x", "y", "times"],
            )


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank`` of all ordered pairs of sources of a language."""
    some = groups.filter("v > 0")
    here = some.select("lang", "source", F.col("seen").alias("seen_s"))
    there = some.select("lang", F.col("source").alias("item"), F.col("seen").alias("seen_t"))
    none = F.lit(0).cast("long")
    x, y = F.col("x"), F.col("y")
    p, p0 = share(x, F.col("seen_s")), share(none, F.col("seen_s"))
    q, q0 = share(y, F.col("seen_t")), share(none, F.col("seen_t"))

    def both(a: str, a0: str, b: str, b0: str) -> Column:
        f = [divergence(F.col(i), F.col(j)) for i, j in ((a, b), (a, b0), (a0, b), (a0, b0))]
        return F.col("times") * (f[0] - f[1] - f[2] + f[3])

    schema = "lang string, source string, item string, x long, y long, times long"
    cells = (
        terms.select("lang", "entries")
        .mapInArrow(_shared, schema)
        .groupBy("lang", "source", "item", "x", "y")
        .agg(F.sum("times").alias("times"))
        .join(here, ["lang", "source"])
        .join(there, ["lang", "item"])
        .select("lang", "source", "item", "times", p.alias("p"), p0.alias("p0"), q.alias("q"), q0.alias("q0"))
        .groupBy("lang", "source", "item")
        .agg(
            F.sum(both("p", "p0", "q", "q0")).alias("ahead"),
            F.sum(both("q", "q0", "p", "p0")).alias("back"),
        )
    )
    ahead = cells.select("lang", "source", "item", F.col("ahead").alias("value"))
    back = cells.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")
    )

    # One row for each count that occurs in a source, against the language's other sources.
    counts = (
        terms.select("lang", F.inline("entries"))
        .groupBy("lang", "source", F.col("count").alias("x"))
        .agg(F.count("*").alias("times"))
        .join(here, ["lang", "source"])
        .select("lang", "source", "times", p.alias("p"), p0.alias("p0"))
    )
    other = groups.select("lang", F.col("source").alias("item"), F.col("seen").alias("seen_t"))
    other = other.filter("seen_t > 0")
    alone = (
        counts.join(other, "lang")
        .filter("source <> item")
        .withColumn("q0", q0)
        .select(
            "lang",
            "source",
            "item",
            (F.col("times") * divergence(F.col("p"), F.col("q0"))).alias("own"),
            (F.col("times") * divergence(F.col("q0"), F.col("p"))).alias("others"),
        )
        .groupBy("lang", "source", "item")
        .agg(F.sum("own").alias("own"), F.sum("others").alias("others"))
    )
    own = alone.select("lang", "source", "item", F.col("own").alias("value"))
    others = alone.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("others").alias("value")
    )

    left = groups.select("lang", "source", "v", F.col("n").alias("n_s"), F.col("seen").alias("seen_s"))
    right = groups.select(
        "lang", F.col("source").alias("item"), F.col("n").alias("n_t"), F.col("seen").alias("seen_t")
    )
    neither = (F.col("v") - F.col("n_s") - F.col("n_t")) * divergence(p0, q0)
    absent = (
        left.join(right, "lang")
        .filter("source <> item")
        .select(
            "lang", "source", "item", F.when(F.col("v") > 0, neither).otherwise(0).alias("value")
        )
    )
    rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        absent.unionAll(ahead)
        .unionAll(back)
        .unionAll(own)
        .unionAll(others)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(rank))
    )


def audit(
    docs: DataFrame, support: int = SUPPORT, top: int = TOP, store: Stage | None = None
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of both parts. Tables are staged in ``store``."""
    store = store or stage(docs.sparkSession)
    terms = store.table(term_counts(docs, support), "terms")
    groups = store.table(group_sizes(docs, terms), "groups")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    single = top_terms(terms, groups, store, top).withColumn("part", F.lit("term"))
    pairs = source_pairs(terms, groups).withColumn("part", F.lit("pair"))
    return single.select(columns).unionAll(pairs.select(columns))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(CAST(lang AS VARCHAR), '') AS lang,
        coalesce(CAST(source AS VARCHAR), '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
w AS (
    SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM d),
kept AS (
    SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
size AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
counts AS (
    SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
own AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
pairing AS (SELECT DISTINCT lang, source FROM d),
dense AS (
    SELECT lang, source, term, coalesce(c, 0) AS c,
        1 + 1000000000 * (coalesce(c, 0) + 1)::HUGEINT // (coalesce(own.n, 0) + size.v)::HUGEINT AS p,
        1 + 1000000000 * (total + 1)::HUGEINT // (size.n + size.v)::HUGEINT AS q
    FROM pairing JOIN kept USING (lang) JOIN size USING (lang)
        LEFT JOIN own USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
    FROM dense WHERE c > 0 AND p > q),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM pairing a JOIN pairing b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM terms UNION ALL SELECT * FROM pairs))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
