"""Token counts by overlap resynchronisation.

Method: a text longer than a chunk is cut into chunks that overlap, each is encoded on its own with
offsets, and neighbours are spliced at a boundary of pre-tokens that both have in their overlap. Where
they have none, the overlap is doubled, past whole chunks if need be, and the left one encoded anew.

Why such a boundary is stable. The tokenizer first takes out added tokens, leftmost first, then cuts what
lies between into pre-tokens by a pattern that is matched from left to right and looks ahead, never
behind; each pre-token is encoded alone. So (1) from a true boundary on, pre-tokens depend on what
follows alone; (2) a chunk that starts at a true boundary has true pre-tokens up to ``margin``
characters before its end: no match that ends earlier has looked at the end (the pattern looks at most
three characters past a pre-token's start, or one past its end), nor can an added token that the end
cuts start there. By (1) a boundary that is true and that the next chunk has as well makes all that
follows in that chunk true, whatever stands before it. Splices go from the first chunk on, so by
induction every count equals the whole text's.

This holds for byte-level BPE with the standard pattern, no normaliser, no space put in front and
added tokens that do not overlap or swallow white space; another tokenizer is refused.

Texts up to a chunk are counted in batches, by words. A space that something else than white space follows
begins a pre-token whatever stands before it, as the pattern takes it as the start of a word, a number or
signs, and white space in front ends before it either way. Cut there, both sides have the pre-tokens of the whole
text, if no added token holds white space. So a worker encodes a word once and keeps its number of tokens; of a word
of ASCII letters, which is one pre-token that byte level leaves as it is, the library's model is asked without
the steps before it. Both need added tokens that no such cut or word can hold; with others, short texts are
encoded whole.

Texts never leave their task: there is no shuffle, and a task holds the encodings of one chunk and its
neighbour, and up to ``WORDS`` words and those of a batch.

Defined cases: null and empty texts have no tokens; repeated rows and ids keep their rows; an added
token's string inside a text counts as that token; an empty table gives an empty result. Columns other
than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import read, text_of

VOCABULARY = "byte_bpe_50k.json"
#: Documents with more tokens are over the limit.
LIMIT = 512
#: Characters between the starts of two chunks, and of their overlap.
CHUNK = 1 << 16
OVERLAP = 256
#: Characters of short texts that are encoded at once.
BATCH = 1 << 20
#: Words that a worker keeps before it starts anew, and the longest that it keeps.
WORDS = 1 << 18
LONGEST = 32
#: A space that begins a pre-token (white space to Python, or to any version of Unicode, is left alone).
CUT = re.compile(r" (?=[^\s\u180e])")
#: Characters that the pre-token pattern looks at past a pre-token's start.
AHEAD = 3


def vocabulary(name: str = VOCABULARY) -> str:
    """Where the file of a public tokenizer lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def checked(definition: str) -> str:
    """The definition of a tokenizer, if the proof above holds for it."""
    parts = json.loads(definition)
    cut = parts["pre_tokenizer"] or {}
    added = parts["added_tokens"]
    texts = [token["content"] for token in added]
    plain = not any(token[flag] for token in added for flag in ("lstrip", "rstrip", "single_word"))
    # No beginning of one may be an end of another, or two could lie across each other.
    apart = not any(
        a[-size:] == b[:size] or (a != b and b in a)
        for a in texts
        for b in texts
        for size in range(1, min(len(a), len(b)) + (a != b))
    )
    standard = cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
    if not (standard and not cut.get("add_prefix_space") and plain and apart):
        raise ValueError("a tokenizer without provably stable boundaries")
    if parts["model"]["type"] != "BPE" or parts["normalizer"] or parts["model"].get("dropout"):
        raise ValueError("a tokenizer without provably stable boundaries")
    return definition


@lru_cache(maxsize=2)
def tokenizer(definition: str):
    # Spark runs a task a core; threads of the library would compete with the other tasks.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(definition)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=2)
def words_of(definition: str) -> dict[str, int]:
    """Tokens of the words that this worker has met, each with a space in front."""
    return {}


def cut_by_words(made) -> bool:
    """Whether no added token can lie across a cut, or within a word of ASCII letters."""
    added = [token.content for token in made.get_added_tokens_decoder().values()]
    return not any(re.search(r"\s", text) or re.fullmatch("[A-Za-z]*", text) for text in added)


def margin_of(made) -> int:
    added = made.get_added_tokens_decoder().values()
    return AHEAD + max((len(token.content) for token in added), default=0)


class Chunk:
    """An encoded part of a text: its tokens and its boundaries of pre-tokens."""

    def __init__(self, made, text: str, start: int, end: int):
        self.start, self.end = start, min(end, len(text))
        encoded = made.encode(text[start:end], add_special_tokens=False)
        self.tokens = len(encoded)
        word = np.array([-1 if w is None else w for w in encoded.word_ids], np.int64)
        new = np.flatnonzero(np.diff(word, prepend=-2))
        #: Tokens before each boundary, and the boundary's place in the text.
        self.before = new
        offsets = encoded.offsets
        self.places = np.array([offsets[i][0] for i in new.tolist()], np.int64) + start


def splice(left: Chunk, right: Chunk, since: int, margin: int) -> tuple[int, int, int] | None:
    """The last common stable boundary: its place, and the tokens before it on both sides."""
    stable = left.places[(left.places >= since) & (left.places <= left.end - margin)]
    common = np.intersect1d(stable, right.places)
    if not len(common):
        return None
    at = common[-1]
    i, j = np.searchsorted(left.places, at), np.searchsorted(right.places, at)
    return int(at), int(left.before[i]), int(right.before[j])


def count_long(made, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, from chunks."""
    margin, size = margin_of(made), len(text)
    left = Chunk(made, text, 0, chunk + overlap)
    # The place from which on the left chunk is known to be true, and its tokens before it.
    since, skipped, total = 0, 0, 0
    while left.end < size:
        start, wide = left.end - min(overlap, left.end - left.start), overlap
        right = Chunk(made, text, start, start + chunk + overlap)
        while (found := splice(left, right, max(since, start), margin)) is None:
            if left.end == size:
                return total + left.tokens - skipped
            wide *= 2
            left = Chunk(made, text, left.start, start + wide)
            if left.end >= right.end and right.end < size:
                # The wider chunk has swallowed its neighbour; the next one takes over.
                start = left.end - min(wide, left.end - left.start)
                right = Chunk(made, text, start, start + wide + chunk)
        since, upto, begin = found
        total += upto - skipped
        left, skipped = right, begin
    return total + left.tokens - skipped


def meet(made, starts: list[str], words: set[str], known: dict[str, int]) -> list[int]:
    """Tokens of each start of a text; those of the words, with a space in front, become known."""
    plain = {word for word in words if word.isascii() and word.isalpha()}
    model = made.model
    # Byte level writes a space so.
    known.update((word, len(model.tokenize("\u0120" + word))) for word in plain)
    rest = list(words - plain)
    texts = starts + [" " + word for word in rest]
    tokens = [len(one) for one in made.encode_batch_fast(texts, add_special_tokens=False)]
    known.update(zip(rest, tokens[len(starts) :]))
    return tokens[: len(starts)]


def count_texts(
    made,
    texts: list[str],
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    known: dict[str, int] | None = None,
) -> list[int]:
    """Tokens of each text. ``known`` has those of words met before, and gets new ones."""
    out = [0] * len(texts)
    known = {} if known is None else known
    cut = CUT.split if cut_by_words(made) else lambda text: [text]
    waiting: list[tuple[int, str, list[str]]] = []
    held = 0

    def encode() -> None:
        if len(known) > WORDS:
            known.clear()
        new = set(chain.from_iterable(words for _, _, words in waiting)).difference(known)
        starts = meet(made, [start for _, start, _ in waiting], new, known)
        for (i, _, words), tokens in zip(waiting, starts):
            out[i] = tokens + sum(map(known.__getitem__, words))
        for word in new:
            if len(word) > LONGEST:
                del known[word]
        waiting.clear()

    for i, text in enumerate(texts):
        if len(text) > chunk + overlap:
            out[i] = count_long(made, text, chunk, overlap)
            continue
        start, *words = cut(text)
        waiting.append((i, start, words))
        held += len(text)
        if held >= BATCH:
            encode()
            held = 0
    if waiting:
        encode()
    return out


def count_tokens(
    docs: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``path`` is read on the driver; the definition (1.6 MB, whatever the data) is broadcast.
    """
    with open(path or vocabulary(), encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(checked(file.read()))
    text = text_of(docs)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, known = tokenizer(definition.value), words_of(definition.value)
            counts = count_texts(made, batch.column("text").to_pylist(), chunk, overlap, known)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))
