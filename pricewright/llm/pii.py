"""Information-theoretic removal of personal data, in DataFrame expressions only.

Method: patterns find the protected entities (mail and IP addresses, card and phone numbers). Corpus
counts then estimate how strongly the words of its documents reveal it: with N different texts, df(e) of
which hold the entity, df(t) the term, and n(e, t) both, the pointwise
mutual information log2(n N / (df(e) df(t))) over the information content log2(N / df(e)) is the share
of the entity's information that the term discloses; it is 1 if the term occurs nowhere
else. A term that reaches ``THRESHOLD`` for an entity, with a support of ``SUPPORT`` different texts,
is a span of kind ``term`` wherever it stands, in documents without that entity too. In the
sanitised text an entity is generalised to its kind, a term to ``[TERM]``, and a term that discloses all
is removed. Copies of a text are one text to the counts: two copies of a page with an address do not make
its rare words disclose the address.

Only entities of ``SUPPORT`` texts or more are looked at, and those that stand in the same texts as
one: a text with thousands of addresses, and its other versions, form one class of entities with their
terms, not all pairs. Pairs of a text are formed only where its document frequencies allow the threshold:
n(e, t) is at most df(e), so a term past it has df(t) <= N^(1 - threshold) df(e)^threshold.

Patterns start only where a run of their characters starts or the previous match ended, and repeat
possessively. Both leave the leftmost matches as they are, and keep the search linear in the text.

Defined cases: null and empty texts have no spans; a null id is one document before all others; repeated rows
and copies count once in the corpus counts and get equal results; a corpus in which every text holds
the entity gives it no information, so no term discloses it; an empty table gives an empty result.
A very long text is searched whole; its places are counted in one pass.
Columns other than ``doc_id`` and ``text`` are not used for detection; sanitising keeps them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..stage import Stage
from .tables import NULL_ID, doc_id, keyed, read, repeats_ids, stage, version_of

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9
SUPPORT = 2
#: Terms, of some 100 bytes each in memory, that are sent to every task; more are met by a shuffle.
BROADCAST_TERMS = 300_000
#: Documents, two numbers each, whose keys are sent to every task; more are met by a shuffle of the texts.
BROADCAST_KEYS = 1_000_000

_LOCAL = r"[A-Za-z0-9._%+-]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Every text with a match that holds passes this search as well; it spares the others the rest.
_GUARDS = {
    "email": PATTERNS["email"],
    "ip": PATTERNS["ip"],
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9][\x20().0-9-]{7}",
}
#: Stands for an entity where the rest of its text is searched.
_MARK = "\uE000"
_TERM = r"\p{L}[\p{L}\p{N}]{2,}+"


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: str, holds=lambda value: F.lit(True)) -> Column:
    """``start, end, value`` of the matches of a pattern in ``text`` that hold, in code points.

    The text is split at the matches; lengths of the parts and matches so far give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    empty = F.lit([]).cast("array<struct<start:bigint,end:bigint,value:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["parts"])
        end = begin + F.coalesce(F.length(x["found"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), x["found"].alias("value"))
        kept = F.coalesce(x["found"].isNotNull() & holds(x["found"]), F.lit(False))
        out = F.when(kept, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    pairs = F.arrays_zip(parts.alias("parts"), found.alias("found"))
    return F.aggregate(pairs, start, step, lambda state: state["out"])


_SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string>"


def base_spans(text: Column) -> Column:
    """All base spans in order of start, then kind: ``start, rank, end, kind, value``."""

    def of_kind(rank: int, kind: str) -> Column:
        spans = F.transform(
            located(text, PATTERNS[kind], lambda value: _holds(kind, value)),
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(rank).alias("rank"),
                s["end"].alias("end"),
                F.lit(kind).alias("kind"),
                s["value"].alias("value"),
            ),
        )
        none = F.lit([]).cast(f"array<{_SPAN}>")
        return F.when(text.rlike(_GUARDS[kind]), spans).otherwise(none)

    return F.array_sort(F.concat(*[of_kind(rank, kind) for rank, kind in enumerate(KINDS)]))


def _words(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    found = F.regexp_extract_all(text, F.lit(_TERM), F.lit(0))
    return F.array_distinct(F.transform(found, lambda t: F.lower(t)))


def detect(docs: DataFrame) -> DataFrame:
    """``id, version, digest, spans, entities, terms`` of every row of :func:`tables.keyed`: a hash of its
    text, its distinct entities and, where it holds some, its distinct terms outside of all."""
    found = docs.select("id", "version", "text", base_spans(F.col("text")).alias("spans"))

    def entity(span: Column) -> Column:
        value = F.when(span["kind"].isin("card", "phone"), F.regexp_replace(span["value"], "[^0-9]", ""))
        return F.concat_ws(":", span["kind"], F.coalesce(value, F.lower(span["value"])))

    # A word that touches an entity goes with it.
    rest = sanitized(F.col("text"), F.col("spans"), lambda s: F.lit(_MARK))
    rest = F.regexp_replace(rest, rf"[\p{{L}}\p{{N}}]*+{_MARK}[\p{{L}}\p{{N}}]*+", " ")
    none = F.lit([]).cast("array<string>")
    return found.select(
        "id",
        "version",
        F.unhex(F.md5("text")).alias("digest"),
        "spans",
        F.array_distinct(F.transform("spans", entity)).alias("entities"),
        F.when(F.size("spans") > 0, _words(rest)).otherwise(none).alias("terms"),
    )


def _copies(found: DataFrame, store: Stage) -> DataFrame:
    """``id, version`` of the documents whose text an earlier one has as well."""
    first = found.groupBy("digest").agg(
        F.min(F.struct("id", "version")).alias("first"), F.count("*").alias("rows")
    )
    # Written, so that the join is a broadcast of known size, or shuffles that split a hot text.
    repeated = store.table(first.filter("rows > 1").select("digest", "first"), "repeated")
    return (
        found.select("id", "version", "digest")
        .join(repeated, "digest")
        .filter(F.struct("id", "version") != F.col("first"))
        .select("id", "version")
        .distinct()
    )


def _with(words: DataFrame, terms: DataFrame, how: str) -> DataFrame:
    """The rows of ``words`` whose term is among the written ``terms``. Up to ``BROADCAST_TERMS`` of them
    the words stay where they are."""
    small = terms.count() <= BROADCAST_TERMS
    return words.join(F.broadcast(terms) if small else terms, "term", how)


def disclosures(
    docs: DataFrame,
    found: DataFrame,
    threshold: float = THRESHOLD,
    support: int = SUPPORT,
    store: Stage | None = None,
) -> DataFrame:
    """``entity, term, share`` of the terms that disclose ``threshold`` or more of an entity. Of entities
    that stand in the same texts, the first speaks for all. Tables are staged in ``store``."""
    store = store or stage(docs.sparkSession)
    # Two numbers for each further copy. Below the broadcast threshold texts stay where they are; above
    # it they are shuffled once, by their unique keys.
    copies = store.table(_copies(found, store), "copies")
    one = ["id", "version"]
    held = found.filter(F.size("entities") > 0).dropDuplicates(one).join(copies, one, "left_anti")
    held = store.table(held.select(*one, "entities", "terms"), "held")
    own = held.select(*one, F.explode("entities").alias("entity"))
    where = [F.xxhash64(F.lit(seed), *one) for seed in (0, 1)]
    entities = (
        own.groupBy("entity")
        .agg(F.count("*").alias("df_entity"), *[F.bit_xor(h).alias(f"at{i}") for i, h in enumerate(where)])
        .filter(F.col("df_entity") >= support)
        .groupBy("df_entity", "at0", "at1")
        .agg(F.min("entity").alias("entity"))
        .select("entity", "df_entity")
    )
    entities = store.table(entities, "entities")
    most = entities.agg(F.max("df_entity")).first()[0]
    if most is None:
        return docs.sparkSession.createDataFrame([], "entity string, term string, share double")
    total = F.lit(found.select("digest").distinct().count())

    def bound(df_entity: Column) -> Column:
        return F.pow(total, 1 - threshold) * F.pow(df_entity, threshold) * (1 + 1e-9)

    # Only the terms of texts that hold such an entity are of use.
    left = store.table(own.join(entities, "entity"), "holders")
    near = (
        held.join(left.select(*one).distinct(), one, "left_semi")
        .select(*one, F.explode("terms").alias("term"))
    )
    near = store.table(near, "near")
    wanted = store.table(near.select("term").distinct(), "wanted")
    every = docs.join(copies, one, "left_anti").select(
        *one, F.explode(_words(F.col("text"))).alias("term")
    )
    if repeats_ids(docs, "id"):
        every = every.distinct()
    counted = (
        _with(every, wanted, "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("df_term"))
        .filter(F.col("df_term").between(F.lit(support), bound(F.lit(most))))
    )
    terms = store.table(counted, "terms")
    joined = (
        left.join(near.join(terms, "term"), one)
        .filter(F.col("df_term") <= bound(F.col("df_entity")))
        .groupBy("entity", "term", "df_entity", "df_term")
        .agg(F.count("*").alias("both"))
        .filter(F.col("both") >= support)
    )
    content = F.log2(total / F.col("df_entity"))
    mutual = F.log2(F.col("both") * total / (F.col("df_entity") * F.col("df_term")))
    share = F.when(content > 0, mutual / content)
    return joined.select("entity", "term", share.alias("share")).filter(
        F.col("share") >= threshold
    )


def _text_of_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _placed(text: Column, shares: Column) -> Column:
    """``start, end, value`` of the terms of a text that are keys of ``shares``."""
    return located(text, _TERM, lambda value: F.map_contains_key(shares, F.lower(value)))


def spans(
    docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT
) -> DataFrame:
    """``id, version, spans, all_spans`` of every row of a keyed table. ``all_spans`` adds the terms,
    with their disclosed share as value."""
    store = stage(docs.sparkSession)
    found = store.table(detect(docs), "found")
    known = disclosures(docs, found, threshold, support, store)
    # A term that discloses several entities has the largest share.
    known = store.table(known.groupBy("term").agg(F.max("share").alias("share")), "disclosing")
    if not known.head(1):
        return found.select("id", "version", "spans", F.col("spans").alias("all_spans"))
    holding = (
        _with(docs.select("id", "version", F.explode(_words(F.col("text"))).alias("term")), known, "inner")
        .groupBy("id", "version")
        .agg(F.map_from_entries(F.collect_set(F.struct("term", "share"))).alias("shares"))
    )
    holding = store.table(holding, "holding")
    # Only the texts that hold a term are shuffled to their terms.
    keys = holding.select("id", "version").distinct()
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    touched = docs.join(keys, ["id", "version"], "left_semi")
    terms = (
        touched.hint("merge")
        .join(holding, ["id", "version"])
        .select("id", "version", "shares", _placed(F.col("text"), F.col("shares")).alias("placed"))
        .dropDuplicates(["id", "version"])
    )
    terms = terms.select(
        "id",
        "version",
        F.transform(
            "placed",
            lambda t: F.struct(
                t["start"].alias("start"),
                F.lit(len(KINDS)).alias("rank"),
                t["end"].alias("end"),
                F.lit("term").alias("kind"),
                F.col("shares")[F.lower(t["value"])].cast("string").alias("value"),
            ),
        ).alias("placed"),
    )
    outside = F.filter(
        "placed",
        lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    every = F.array_sort(
        F.concat("spans", F.coalesce(outside, F.lit([]).cast(f"array<{_SPAN}>")))
    )
    return found.join(terms, ["id", "version"], "left").select(
        "id", "version", "spans", every.alias("all_spans")
    )


def _label(span: Column) -> Column:
    value = span["value"].cast("double")
    return (
        F.when(span["kind"] != "term", F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        .when(value >= 1 - 1e-9, "")
        .otherwise("[TERM]")
    )


def sanitized(text: Column, spans: Column, label=_label) -> Column:
    """The text with its spans generalised or removed; overlapping spans are one."""
    block = 4096
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{block}}}"), F.lit(0))

    def part(a: Column, b: Column, blocks: Column) -> Column:
        first = F.floor(a / block).cast("int")
        last = F.floor((b - 1) / block).cast("int")
        joined = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        own = F.substring(joined, (a - first * block + 1).cast("int"), (b - a).cast("int"))
        return F.when(b > a, own).otherwise("")

    def step(state: Column, s: Column) -> Column:
        kept = part(state["at"], s["start"], state["blocks"])
        added = F.when(s["start"] >= state["at"], F.array(kept, label(s))).otherwise(
            F.lit([]).cast("array<string>")
        )
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(state["out"], added).alias("out"),
            state["blocks"].alias("blocks"),
        )

    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.lit([]).cast("array<string>").alias("out"),
        blocks.alias("blocks"),
    )
    return F.aggregate(
        spans,
        start,
        step,
        lambda state: F.concat(
            F.array_join(state["out"], ""),
            part(state["at"], F.length(text).cast("long"), state["blocks"]),
        ),
    )


def sanitize(docs: DataFrame) -> DataFrame:
    """``docs`` with every column, its text sanitised. A null text stays null."""
    known = spans(keyed(docs)).filter(F.size("all_spans") > 0)
    known = known.select("id", "version", "all_spans").dropDuplicates(["id", "version"])
    known = known.toDF("_pii_id", "_pii_version", "_pii_spans")
    same = (F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)) == F.col("_pii_id")) & (
        version_of(docs) == F.col("_pii_version")
    )
    clean = F.when(F.col("_pii_spans").isNull(), docs["text"]).otherwise(
        sanitized(docs["text"], F.col("_pii_spans"))
    )
    columns = [clean.alias("text") if c == "text" else docs[f"`{c}`"] for c in docs.columns]
    return docs.join(known, same, "left").select(*columns)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(keyed(read(spark, sf_dir, "documents")))

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        doc_id("id").alias("doc_id"),
        *counts,
        F.sha2(_text_of_spans(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        _text_of_spans(F.col("all_spans")).alias("spans"),
    )
