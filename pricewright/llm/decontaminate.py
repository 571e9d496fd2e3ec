"""Benchmark decontamination by q-gram lemma filtering.

Method: a text of length m that holds a passage with at most e edits shares at least m - q + 1 - q * e
of its q-grams with it, all on diagonals no more than e apart. Shared q-grams of document and
benchmark are counted in diagonal bands of width 2e that overlap by e, so some band holds them all;
bands that reach the bound are retained, and banded alignment of the passage against the text along the
band verifies them, with both ends of the text free.

Benchmark items are cut into overlapping segments of ``SEGMENT`` bytes (shorter items are one) and of
``PART`` bytes every ``PART_STRIDE``. Any verbatim part of ``FOUND`` bytes or more holds one of the latter
whole, wherever it starts, so a document that holds it is found. Items under ``SHORTEST`` bytes are
found where they stand exactly, not inside a longer ASCII word. Both sides are compared in lower case
(ASCII) with white space collapsed, as UTF-8 bytes.

The benchmark is the stated query set. It is sent to the tasks in blocks of about ``BLOCK_BYTES``
(a larger single item makes a block of its own); a benchmark of many blocks takes as many passes
over the documents. Documents are never shuffled. A worker indexes a block once: one entry for each
byte of it, of which the segments that cover a shared q-gram are found by arithmetic.

Where a text shares more than ``HITS`` q-grams with segments, as repetitive ones do, it is cut into
overlapping windows of ``WINDOW`` bytes, and the benchmark into ranges of bytes that segments begin in, until
each lot is below that number. A window that reads like an earlier one of its text is skipped: it has the same matches, which
end later. So memory is bounded, and a repetitive text costs what its different windows do.

Defined cases: null and empty texts hold nothing; null and empty items match
nothing; repeated items count once; repeated rows each get their matches;
empty tables give an empty result. Columns other than ``doc_id, text`` and ``item_id, text`` are not
used.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import runs as R
from .tables import NULL_ID, doc_id, read, text_of

SEGMENT = 100
STRIDE = 50
SHORTEST = 40
PART = 60
PART_STRIDE = 10
#: Bytes of the shortest verbatim part of a longer item that is found wherever it starts.
FOUND = PART + PART_STRIDE - 1
Q = 12
#: Edits allowed in a segment, as a share of its length.
RATE = 0.06
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 24
_STEP = 1 << 20
#: Shared q-grams that are held at once, unless segments of one start have more in one window.
HITS = 1 << 19
#: No q-gram of an item is in more segments.
_COVER = -(-SEGMENT // STRIDE) + -(-PART // PART_STRIDE) + 2
WINDOW = 4096
#: No match, edits included, is longer.
_OVERLAP = 2 * SEGMENT
#: Candidates aligned at once.
_LOT = 1 << 14


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def _starts(n: int, size: int, stride: int) -> np.ndarray:
    """Where the segments of a size begin in ``n`` bytes; the last one ends with them."""
    last = max(0, n - size)
    return np.unique(np.append(np.arange(0, last + 1, stride), last))


def _kinds(n: int) -> list[tuple[int, int]]:
    """(size, stride) of the segments of an item of ``n`` bytes."""
    if n < SHORTEST:
        return []
    return [(SEGMENT, STRIDE), (PART, PART_STRIDE)][: 2 if n > PART else 1]


def segments(text: bytes) -> list[tuple[int, bytes]]:
    """(start, bytes) of the segments of a normal item text."""
    places = [
        (int(s), min(size, len(text)))
        for size, stride in _kinds(len(text))
        for s in _starts(len(text), size, stride)
    ]
    return [(s, text[s : s + size]) for s, size in sorted(places)]


def _in_word(text: bytes, at: int) -> bool:
    """Whether an ASCII word goes on across a place of the text."""
    pair = text[at - 1 : at + 1] if at else b""
    return len(pair) == 2 and pair.isalnum()


class Index:
    """The q-grams of a block of items, sorted by hash, and the segments that cover them.

    Segments are numbered by kind, then by where they begin in the items' joined bytes, so the ones
    of a kind that cover a q-gram are neighbours.
    """

    def __init__(self, items: list[tuple[int, bytes]], rate: float = RATE):
        long = [(item, text) for item, text in items if len(text) >= SHORTEST]
        self.data = np.frombuffer(b"".join(text for _, text in long), np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(text) for _, text in long])]).astype(np.int64)
        found: list[list[tuple[np.ndarray, int, int]]] = [[], []]
        for (item, text), begin in zip(long, begins):
            for kind, (size, stride) in enumerate(_kinds(len(text))):
                starts = begin + _starts(len(text), size, stride)
                found[kind].append((starts, min(size, len(text)), item))
        flat = [f for kind in found for f in kind]
        counts = [len(f[0]) for f in flat]
        self.start = np.concatenate([f[0] for f in flat]) if flat else np.zeros(0, np.int64)
        self.size = np.repeat(np.array([f[1] for f in flat], np.int64), counts)
        self.item = np.repeat(np.array([f[2] for f in flat], np.int64), counts)
        self.edits = np.floor(self.size * rate).astype(np.int64)
        self.bound = self.size - Q + 1 - Q * self.edits
        if flat and self.bound.min() < 1:
            raise ValueError("the edit rate leaves no shared q-grams to count")
        #: First segment of each kind, and of none.
        self.kinds = np.cumsum([0, *(sum(len(f[0]) for f in kind) for kind in found)])
        grams = R.byte_grams(self.data, Q) if long else np.zeros(0, np.uint64)
        # A q-gram across two items is in no segment.
        inside = np.ones(len(grams), bool)
        for border in begins[1:-1]:
            inside[max(0, border - Q + 1) : border] = False
        place = np.flatnonzero(inside)
        order = np.argsort(grams[place], kind="stable")
        self.place = place[order].astype(np.int64 if len(grams) >> 31 else np.int32)
        self.hash = grams[self.place]
        self.short: dict[int, dict[bytes, list[int]]] = {}
        for item, text in items:
            if 0 < len(text) < SHORTEST:
                self.short.setdefault(len(text), {}).setdefault(text, []).append(item)
        gram = lambda text: R.byte_grams(np.frombuffer(text, np.uint8), len(text))[0]
        self.short_hash = {n: np.array([gram(t) for t in own]) for n, own in self.short.items()}
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self.hash >> np.uint64(64 - _FILTER_BITS)] = True

    def _shared(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the text's q-grams that the index holds, and their entries from and to."""
        grams = R.byte_grams(text, Q)
        at = np.flatnonzero(self.seen[grams >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.hash, grams[at], side="left")
        high = np.searchsorted(self.hash, grams[at], side="right")
        held = high > low
        return at[held], low[held], high[held]

    def _first_entry(self, low: np.ndarray, high: np.ndarray, place: int) -> np.ndarray:
        """In each range of entries, the first at ``place`` or behind; a q-gram's are in order."""
        low, high = low.copy(), high.copy()
        while len(x := np.flatnonzero(low < high)):
            middle = (low[x] + high[x]) >> 1
            before = self.place[middle] < place
            low[x] = np.where(before, middle + 1, low[x])
            high[x] = np.where(before, high[x], middle)
        return low

    def _hits(
        self, at: np.ndarray, low: np.ndarray, high: np.ndarray, first: int, last: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position, segment, offset) of the shared q-grams of the segments that begin in bytes
        ``first .. last - 1`` of the items, in lots of whole segments."""
        low = self._first_entry(low, high, first)
        high = self._first_entry(low, high, last + SEGMENT)
        held = high > low
        at, low, high = at[held], low[held], high[held]
        if int((high - low).sum()) * _COVER > HITS and last - first > 1:
            middle = (first + last) >> 1
            yield from self._hits(at, low, high, first, middle)
            yield from self._hits(at, low, high, middle, last)
            return
        place = self.place[R.spread(low, high - low)].astype(np.int64)
        position = np.repeat(at, high - low)
        segments, positions, places = [], [], []
        for a, b in zip(self.kinds[:-1], self.kinds[1:]):
            a, b = a + np.searchsorted(self.start[a:b], [first, last])
            start, size = self.start[a:b], self.size[a:b]
            # Of neighbours in order, those that begin at or before a q-gram and end behind it.
            begin = np.searchsorted(start + size - Q, place, side="left")
            count = np.maximum(np.searchsorted(start, place, side="right") - begin, 0)
            segments.append(R.spread(a + begin, count))
            positions.append(np.repeat(position, count))
            places.append(np.repeat(place, count))
        segment = np.concatenate(segments)
        yield np.concatenate(positions), segment, np.concatenate(places) - self.start[segment]

    def bands(
        self, text: np.ndarray, seen: set[bytes]
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(start, bytes, segment, band) with enough shared q-grams, of the whole text or of its windows.

        Band b holds diagonals b*e .. b*e + 2e. Windows in ``seen``, which it adds to, are left out.
        """
        at, low, high = self._shared(text)
        starts, size = np.zeros(1, np.int64), len(text)
        if int((high - low).sum()) * _COVER > HITS and len(text) > WINDOW + _OVERLAP:
            starts, size = np.arange(0, len(text) - _OVERLAP, WINDOW), WINDOW + _OVERLAP
        for start in starts.tolist():
            part = text[start : start + size]
            if len(starts) > 1:
                digest = hashlib.blake2b(part.tobytes(), digest_size=16).digest()
                if digest in seen:
                    continue
                seen.add(digest)
            a, b = np.searchsorted(at, [start, start + len(part) - Q + 1])
            for hits in self._hits(at[a:b] - start, low[a:b], high[a:b], 0, len(self.data)):
                yield (start, part, *self._counted(*hits))

    def _counted(
        self, position: np.ndarray, segment: np.ndarray, offset: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(segment, band) of the bands that hold enough of the shared q-grams."""
        width = np.maximum(self.edits[segment], 1)
        band = (position - offset) // width
        shift = np.int64(1 << 32)
        key = np.concatenate([segment * shift + band + (shift >> 1)] * 2)
        key[len(band) :] -= 1
        keys, counts = np.unique(key, return_counts=True)
        found = keys // shift
        enough = counts >= self.bound[found]
        return found[enough], (keys[enough] % shift) - (shift >> 1)

    def exact(self, text: bytes) -> dict[int, int]:
        """Item and end of the first match of the items under ``SHORTEST`` bytes."""
        found: dict[int, int] = {}
        data = np.frombuffer(text, np.uint8)
        for n, items in self.short.items():
            for start in range(0, len(data) - n + 1, _STEP):
                grams = R.byte_grams(data[start : start + _STEP + n - 1], n)
                for at in np.flatnonzero(np.isin(grams, self.short_hash[n])) + start:
                    own = items.get(text[at : at + n], [])
                    if own and not _in_word(text, int(at)) and not _in_word(text, int(at) + n):
                        for item in own:
                            found.setdefault(item, int(at) + n)
        return found

    def verify(
        self, text: np.ndarray, segment: np.ndarray, band: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each segment along its band, and where the match ends in the text."""
        edits = np.zeros(len(segment), np.int64)
        ends = np.zeros(len(segment), np.int64)
        for size in np.unique(self.size[segment]):
            x = np.flatnonzero(self.size[segment] == size)
            e = int(max(1, self.edits[segment[x[0]]]))
            for lot in np.array_split(x, -(-len(x) // _LOT)):
                patterns = self.data[self.start[segment[lot], None] + np.arange(size)]
                edits[lot], ends[lot] = _align(text, patterns, band[lot] * e, 2 * e)
        return edits, ends


def _align(
    text: np.ndarray, patterns: np.ndarray, first: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Edit distances of patterns to the text on diagonals ``first .. first + width``."""
    n, size = patterns.shape
    lane = np.arange(width + 1)
    cost = np.zeros((n, width + 1), np.int64)
    for j in range(size):
        place = first[:, None] + lane + j
        inside = (place >= 0) & (place < len(text))
        same = inside & (text[np.clip(place, 0, max(0, len(text) - 1))] == patterns[:, j : j + 1])
        step = cost + ~same
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        # An inserted byte of the text stays in the row: a running minimum with a slope of one.
        cost = np.minimum.accumulate(step - lane, axis=1) + lane
    best = cost.argmin(1)
    return cost[np.arange(n), best], first + best + size


def matches_in(index: Index, text: bytes) -> list[tuple[int, int, int, int]]:
    """(item, segments, least edits, end of the first match) for one document's text."""
    data = np.frombuffer(normal(text), np.uint8)
    best: dict[int, tuple[int, int]] = {}
    seen: set[bytes] = set()
    for at in range(0, max(1, len(data) - _OVERLAP), _STEP):
        piece = data[at : at + _STEP + _OVERLAP]
        if len(piece) < Q:
            continue
        for start, part, segment, band in index.bands(piece, seen):
            edits, ends = index.verify(part, segment, band)
            ok = edits <= index.edits[segment]
            own, x = np.unique(segment[ok], return_inverse=True)
            least = np.full(len(own), SEGMENT, np.int64)
            first = np.full(len(own), len(data), np.int64)
            np.minimum.at(least, x, edits[ok])
            np.minimum.at(first, x, ends[ok] + at + start)
            for s, k, end in zip(own.tolist(), least.tolist(), first.tolist()):
                k0, end0 = best.get(s, (k, end))
                best[s] = (min(k, k0), min(end, end0))
    found: dict[int, tuple[int, int, int]] = {}
    for s, (k, end) in best.items():
        item = int(index.item[s])
        n, k0, end0 = found.get(item, (0, k, end))
        found[item] = (n + 1, min(k, k0), min(end, end0))
    rows = [(item, *m) for item, m in found.items()]
    # A null id may stand for several items, short ones among them.
    short = {item: end for item, end in index.exact(data.tobytes()).items() if item not in found}
    return sorted(rows + [(item, 1, 0, end) for item, end in short.items()])


#: The index that this worker process used last.
_LAST: list = [None, None]


def _index(block: tuple[str, list[tuple[int, bytes]]], rate: float) -> Index:
    """The index of a named block, built once by a worker process; it holds one at a time."""
    if _LAST[0] != (block[0], rate):
        _LAST[:] = [None, None]
        _LAST[:] = [(block[0], rate), Index(block[1], rate)]
    return _LAST[1]


def blocks(
    benchmark: DataFrame, limit: int | None = None
) -> Iterator[tuple[str, list[tuple[int, bytes]]]]:
    """A name of its own and the items, of about ``limit`` bytes (else ``BLOCK_BYTES``), of each block."""
    limit = limit or BLOCK_BYTES
    items = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("long"), F.lit(NULL_ID)).alias("item"),
        text_of(benchmark).alias("text"),
    ).distinct()
    size, count = items.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")
    ).first()
    n = max(1, -(-size // limit))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n if count else 0):
        rows = items.filter(block == i).collect()
        yield uuid.uuid4().hex, sorted((r["item"], normal(r["text"].encode())) for r in rows)


_MATCH = "id long, item long, n_segments long, least_edits long, first_end long"


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id, item_id, n_segments, least_edits, first_end``: one row for each document row and
    item of which it holds a segment; the end is a byte offset in the normal text."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("id"),
        text_of(docs).alias("text"),
    )
    out = spark.createDataFrame([], _MATCH)
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def each(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value, rate)
            for batch in batches:
                data, off = R.string_buffer(batch.column("text"))
                ids, found = R.longs(batch, "id"), []
                for i in range(len(ids)):
                    text = data[off[i] : off[i + 1]].tobytes()
                    found += [(int(ids[i]), *m) for m in matches_in(index, text)]
                columns = list(zip(*found)) or [()] * 5
                names = [f.split()[0] for f in _MATCH.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        out = out.union(rows.mapInArrow(each, _MATCH))
    return out.select(
        doc_id("id").alias("doc_id"),
        doc_id("item").alias("item_id"),
        "n_segments",
        "least_edits",
        "first_end",
    )


def without_matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` without the rows that hold a benchmark segment; no shuffle, every column as it was."""
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def each(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value, rate)
            for batch in batches:
                data, off = R.string_buffer(batch.column("text"))
                texts = (data[a:b].tobytes() for a, b in zip(off[:-1], off[1:]))
                yield batch.filter(pa.array([not matches_in(index, t) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(each, docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
