"""Filter interaction audit by relations of failing ids.

Method: one id table is stored for each filter, holding the documents that fail it. A prefix of a filter
order is a set of filters, so the 120 orders have 32 prefixes and 80 (prefix, next filter) steps. A
prefix's survivors are the documents left after an anti join with the id tables of its filters; what the
next filter removes is its id table after the same anti join; what it would have removed, had no earlier
filter done so, is its id table after a semi join. Label losses are sums over the removed ids. The
orders then look their steps up.

The joins run on (document key, prefix) rows that are dealt out by key before they are multiplied by the
fixed prefixes, so texts are read once and never shuffled, and every key has at most five rows in
the id tables, whatever the skew. Documents that fail nothing survive everything and are counted once.

Defined cases: a null text is empty, a null ``lang`` the empty string, a null ``doc_id`` the smallest id. A
document without words passes B, an empty one passes C. Rows alike in ``doc_id``, ``lang`` and text
count as often as they occur; of equal texts those with the smallest id all pass E. A document is good
or toxic if any row of ``labels`` for its id says 1; null ids have no labels. An empty table gives an empty
result. Columns other than ``doc_id``, ``text`` and ``lang`` are not used.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..stage import Stage
from .tables import keyed, read, stage, words

FILTERS = "ABCDE"
#: A prefix is the sum of its filters' bits.
BITS = {name: 1 << i for i, name in enumerate(FILTERS)}
EVERY = (1 << len(FILTERS)) - 1
KEY = ("id", "version", "part")


def failures(text: Column) -> dict[str, Column]:
    """The conditions of the filters that need one document alone."""
    found = words(text)
    return {
        "A": F.size(found) < 100,
        "B": 100 * F.size(F.array_distinct(found)) < 80 * F.size(found),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def documents_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, version, part, n, digest, good, toxic`` and the failures A to D of every document key."""
    part = F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("part")
    rows = keyed(docs, part)
    flags = [condition.alias(name) for name, condition in failures(F.col("text")).items()]
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    # Equal keys have equal texts, so any row speaks for them.
    own = [F.first(name).alias(name) for name in ("digest", "A", "B", "C", "D")]
    kept = rows.select(*KEY, digest, *flags).groupBy(*KEY).agg(F.count("*").alias("n"), *own)
    label = [
        F.coalesce(F.max((labels[name] == 1).cast("long")), F.lit(0)).alias(to)
        for name, to in (("quality", "good"), ("toxic", "toxic"))
    ]
    known = (
        labels.filter(labels["doc_id"].isNotNull())
        .groupBy(labels["doc_id"].cast("long").alias("id"))
        .agg(*label)
    )
    return kept.join(known, "id", "left").fillna(0, ["good", "toxic"])


def id_tables(rows: DataFrame, store: Stage) -> DataFrame:
    """All id tables, stored one by one, as ``key, n, good, toxic, bit``."""
    # Only texts that occur under several ids; one row a text, however many copies it has. Written, so
    # that the join below is a broadcast of known size, or plain shuffles that split a hot text.
    repeated = (
        rows.groupBy("digest")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .filter("least < most")
        .select(F.col("digest").alias("copied"), "least")
    )
    repeated = store.table(repeated, "repeated")
    later = (F.col("digest") == F.col("copied")) & (F.col("id") > F.col("least"))
    tables = None
    for name, bit in BITS.items():
        failing = rows.join(repeated, later, "left_semi") if name == "E" else rows.filter(name)
        ids = store.table(failing.select(*KEY, "n", "good", "toxic"), f"failing_{name}")
        ids = ids.withColumn("bit", F.lit(bit))
        tables = ids if tables is None else tables.unionAll(ids)
    return tables


def _with_prefixes(rows: DataFrame, bit: Column) -> DataFrame:
    """Every row with every prefix that does not hold ``bit``; dealt out by key first."""
    prefixes = F.array(*[F.lit(p) for p in range(EVERY + 1)])
    free = F.filter(prefixes, lambda p: p.bitwiseAND(bit) == 0)
    return rows.repartition(*KEY).withColumn("prefix", F.explode(free))


def _filtered(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows whose document is in no id table of its prefix (``left_anti``), or in one (``left_semi``)."""
    left, right = rows.alias("l"), ids.select(*KEY, F.col("bit").alias("by")).alias("r")
    same = [F.col(f"l.{name}") == F.col(f"r.{name}") for name in KEY]
    applied = F.col("l.prefix").bitwiseAND(F.col("r.by")) != 0
    return left.join(right, [*same, applied], how)


def steps() -> list[tuple[str, int, int, int]]:
    """``filter_order, step, prefix before the step, bit of the step's filter`` of all orders."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for at, name in enumerate(order, 1):
            out.append((order, at, before, BITS[name]))
            before |= BITS[name]
    return out


def audit(docs: DataFrame, labels: DataFrame, store: Stage | None = None) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley`` of every part, order and step. Tables are staged in ``store``."""
    store = store or stage(docs.sparkSession)
    rows = store.table(documents_of(docs, labels), "audited")
    ids = id_tables(rows, store)
    at = _with_prefixes(ids, F.col("bit"))
    by = ("part", "prefix", "bit")
    removed = (
        _filtered(at, ids, "left_anti")
        .groupBy(*by)
        .agg(
            F.sum("n").alias("removed"),
            F.sum(F.col("n") * F.col("good")).alias("good_lost"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic_lost"),
        )
    )
    redundant = _filtered(at, ids, "left_semi").groupBy(*by).agg(F.sum("n").alias("redundant"))

    documents = rows.select(*KEY, "n")
    passing = documents.join(ids.select(*KEY), list(KEY), "left_anti")
    passing = passing.groupBy("part").agg(F.sum("n").alias("passing"))
    others = documents.join(ids.select(*KEY), list(KEY), "left_semi")
    survivors = (
        _filtered(_with_prefixes(others, F.lit(0)), ids, "left_anti")
        .groupBy("part", "prefix")
        .agg(F.sum("n").alias("survivors"))
    )

    # At most 80 and 32 rows a part.
    removed = store.table(removed, "removed")
    redundant = store.table(redundant, "redundant")
    survivors = store.table(survivors, "survivors")
    only = removed.filter(F.col("prefix") + F.col("bit") == EVERY)
    only = only.select("part", "bit", F.col("removed").alias("unique_fails"))
    every = F.array(
        *[
            F.struct(
                F.lit(order).alias("filter_order"),
                F.lit(step).alias("step"),
                F.lit(before).alias("prefix"),
                F.lit(bit).alias("bit"),
            )
            for order, step, before, bit in steps()
        ]
    )
    table = (
        rows.select("part")
        .distinct()
        .join(passing, "part", "left")
        .select("part", "passing", F.inline(every))
        .withColumn("after", F.col("prefix") + F.col("bit"))
        .join(removed, list(by), "left")
        .join(redundant, list(by), "left")
        .join(only, ["part", "bit"], "left")
        .join(survivors.withColumnRenamed("prefix", "after"), ["part", "after"], "left")
        .fillna(0)
    )
    orders = Window.partitionBy("part", "bit")
    return table.select(
        "part",
        "filter_order",
        "step",
        (F.col("passing") + F.col("survivors")).alias("kept"),
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(orders).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL = r"""
WITH seen AS (
    SELECT doc_id, coalesce(CAST(lang AS VARCHAR), '') AS part, coalesce(text, '') AS t,
        coalesce(doc_id, -9223372036854775808) AS id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS found
    FROM documents),
firsts AS (SELECT t, min(id) AS least FROM seen GROUP BY t),
label AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
cells AS (
    SELECT part,
        CAST(len(found) < 100 AS INT)
        + 2 * CAST(100 * len(list_distinct(found)) < 80 * len(found) AS INT)
        + 4 * CAST(100 * length(regexp_replace(seen.t, '[^A-Z]', '', 'g')) > 10 * length(seen.t) AS INT)
        + 8 * CAST(regexp_matches(seen.t, '[#$%&*|]') AS INT)
        + 16 * CAST(id > least AS INT) AS fails,
        count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM seen JOIN firsts ON seen.t = firsts.t LEFT JOIN label ON seen.doc_id = label.doc_id
    GROUP BY ALL),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
        [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM f a, f b, f c, f d, f e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
        AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (
    SELECT filter_order, CAST(step AS INT) AS step, bits[step] AS bit,
        CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
    FROM orders, range(1, 6) r(step)),
counted AS (
    SELECT part, filter_order, step, bit,
        sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN fails & bit <> 0 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN fails & bit <> 0 AND fails & before <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN fails & bit <> 0 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN fails & bit <> 0 AND fails & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
