"""Finding windows that repeat anywhere in a corpus, without shuffling every window.

Every window of ``window`` units (bytes or words) is assigned to its smallest ``gram``-unit
hash. Equal windows have equal smallest hashes, so they meet in one bucket; neighbouring windows
mostly share theirs, so a document becomes a few runs of windows. A first exchange counts the run
hashes alone and flags the runs whose hash occurs twice; only flagged runs are shipped with
their content to be compared. Runs that occur often in one task are combined before each exchange.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .tables import BUCKETED, NULL_ID, buckets

#: Units worked on at a time; bounds the memory of a task whatever the length of a text.
PIECE = 1 << 20
#: Bytes whose word hashes are computed at a time.
SEGMENT = 1 << 18
#: Words from this length on are hashed one by one.
LONG_WORD = 64

_BASE = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
_BYTE = np.random.default_rng(20_240_607).integers(1, _M64, 256, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of a polynomial hash over all its bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def pack(*arrays: np.ndarray) -> bytes:
    head = struct.pack(f"<{len(arrays)}q", *(a.nbytes for a in arrays))
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + body)


class Steps:
    """Marks an array of 64-bit integers packed as differences, which compress better."""


def steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = struct.unpack_from(f"<{len(kinds)}q", raw), 8 * len(kinds), []
    for size, kind in zip(sizes, kinds):
        plain = np.int64 if kind is Steps else kind
        values = np.frombuffer(raw, plain, size // np.dtype(plain).itemsize, at)
        out.append(np.cumsum(values) if kind is Steps else values)
        at += size
    return out


def unpack_all(blobs: pa.ChunkedArray, *kinds: type) -> list[np.ndarray]:
    parts = [unpack(b.as_py(), *kinds) for b in blobs]
    return [np.concatenate([p[i] for p in parts]) for i in range(len(kinds))]


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them, without a copy."""
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, np.int64, n + 1, 8 * column.offset) if n else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), off


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all members of the given ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return first + np.arange(total)


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all ``k`` neighbours, built by doubling."""
    level, size, levels = units, 1, {1: units}
    while size * 2 <= k:
        level = level[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + level[size:]
        size *= 2
        levels[size] = level
    have, out = size, level
    for step in sorted(levels, reverse=True):
        if step < size and have + step <= k:
            left = out[: len(units) - have - step + 1]
            out = left * np.uint64(pow(_BASE, step, 1 << 64)) + levels[step][have : have + len(left)]
            have += step
    return mix(out)


def byte_grams(text: np.ndarray, k: int) -> np.ndarray:
    return gram_hashes(_BYTE[text], k)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if width > size else h


@dataclass
class Piece:
    """Units of some documents, or of a part of one long document."""

    units: np.ndarray
    starts: np.ndarray  # of each document's units in ``units``
    ends: np.ndarray
    doc: np.ndarray  # row of the batch
    base: np.ndarray  # position of the first unit in its document


@dataclass
class Runs:
    """Runs of windows with one smallest hash; positions are window starts."""

    least: np.ndarray  # uint64
    start: np.ndarray  # in the piece's units
    length: np.ndarray  # windows
    doc: np.ndarray  # row of the batch
    pos: np.ndarray  # window start in the document
    again: np.ndarray  # whether the smallest hash occurs more than once within the run


def find_runs(piece: Piece, window: int, gram: int, inner: bool = True) -> Runs:
    """The runs of a piece; without ``inner``, repeats within a run are not looked for."""
    n = len(piece.units)
    none = np.zeros(0, np.int64)
    if n < window:
        return Runs(none.astype(np.uint64), none, none, none, none, none.astype(bool))
    width = window - gram + 1
    grams = gram_hashes(piece.units, gram)
    least = sliding_min(grams, width)
    cut = np.zeros(len(least) + 1, bool)
    cut[0] = cut[-1] = True
    cut[1:-1] = least[1:] != least[:-1]
    for edge in (piece.starts, np.maximum(piece.ends - window + 1, piece.starts)):
        cut[edge[edge < len(least)]] = True
    at = np.flatnonzero(cut)
    start, end = at[:-1], at[1:]
    owner = np.searchsorted(piece.ends, start, side="right")
    whole = (start + window <= piece.ends[owner]) & (start >= piece.starts[owner])
    again = np.zeros(len(start), bool)
    if inner:
        again = _again(grams, least, start, end, piece, owner, window, width)
    start, end, owner = start[whole], end[whole], owner[whole]
    return Runs(
        least[start],
        start,
        end - start,
        piece.doc[owner],
        piece.base[owner] + start - piece.starts[owner],
        again[whole],
    )


def batch_runs(
    pieces: Iterator[Piece], window: int, gram: int, inner: bool, choose: Callable | None = None
) -> Runs:
    """The runs of all pieces of a batch together, of those that ``choose(piece, runs)`` keeps."""
    parts = []
    for piece in pieces:
        runs = find_runs(piece, window, gram, inner)
        if choose:
            x = choose(piece, runs)
            runs = Runs(*(getattr(runs, f.name)[x] for f in fields(Runs)))
        parts.append(runs)
    if not parts:
        parts = [find_runs(Piece(*[np.zeros(0, np.uint64)] * 5), window, gram)]
    return Runs(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Runs)))


def _again(grams, least, start, end, piece, owner, window, width) -> np.ndarray:
    """Whether the smallest hash of each run stands at more than one place of it.

    A run that ends because its smallest hash leaves has each place as the first gram of one of
    its windows; one that begins because the hash enters, as the last gram. Only runs
    between smaller neighbours or edges of the text are searched.
    """
    value, last = least[start], end - 1
    leads, trails = grams[: len(least)] == least, grams[width - 1 :] == least
    ended = (end + window <= piece.ends[owner]) & leads[last]
    ended &= least[np.minimum(end, len(least) - 1)] > value
    begun = (start > piece.starts[owner]) & trails[start]
    begun &= least[np.maximum(start - 1, 0)] > value
    places = np.where(
        ended, np.add.reduceat(leads.astype(np.int64), start), np.add.reduceat(
            trails.astype(np.int64), start
        )
    )
    rest = np.flatnonzero(~ended & ~begun)
    if len(rest):
        size = end[rest] - start[rest] + width - 1
        same = grams[spread(start[rest], size)] == np.repeat(value[rest], size)
        places[rest] = np.add.reduceat(same.astype(np.int64), np.cumsum(size) - size)
    return places > 1


def _parts(size: int, window: int) -> Iterator[tuple[int, int]]:
    """Overlapping parts of a long document that hold each window once."""
    for at in range(0, max(1, size - window + 1), PIECE):
        yield at, min(size, at + PIECE + window - 1)


def _groups(off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows whose texts are worked on together."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + PIECE, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def byte_pieces(batch: pa.RecordBatch, window: int) -> Iterator[Piece]:
    data, off = string_buffer(batch.column("text"))
    for i, j in _groups(off):
        text, bounds = data[off[i] : off[j]], off[i : j + 1] - off[i]
        if j == i + 1:
            for a, b in _parts(len(text), window):
                yield Piece(
                    _BYTE[text[a:b]],
                    np.array([0]),
                    np.array([b - a]),
                    np.array([i]),
                    np.array([a]),
                )
        else:
            yield Piece(
                _BYTE[text], bounds[:-1], bounds[1:], np.arange(i, j), np.zeros(j - i, np.int64)
            )


def word_bounds(text: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words of neighbouring texts; ``edges`` are the n + 1 offsets."""
    inner = np.ones(len(text) + 2, bool)
    inner[0] = inner[-1] = False
    inner[1:-1] = (text != 32) & ((text < 9) | (text > 13))
    begins = inner[1:-1] & ~inner[:-2]
    cuts = edges[(edges > 0) & (edges < len(text))]
    begins[cuts] |= inner[1:-1][cuts]
    ends = inner[1:-1] & ~inner[2:]
    ends[cuts - 1] |= inner[1:-1][cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS: list[np.ndarray] = []


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of ``text``."""
    if not _POWERS:
        _POWERS.extend(_powers(SEGMENT + LONG_WORD + 1))
    up, down = _POWERS
    out = np.empty(len(starts), np.uint64)
    long = ends - starts >= LONG_WORD
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(starts, starts[i] + SEGMENT, side="left"))
        at = starts[i]
        stop = min(int(ends[j - 1]), int(at) + SEGMENT + LONG_WORD)
        sums = np.zeros(stop - at + 1, np.uint64)
        np.cumsum(_BYTE[text[at:stop]] * up[: stop - at], out=sums[1:])
        s, e = starts[i:j] - at, np.minimum(ends[i:j], stop) - at
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    out = mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh64_intdigest(text[starts[i] : ends[i]].tobytes(), 1)
    return out


def word_pieces(batch: pa.RecordBatch, window: int) -> Iterator[Piece]:
    data, off = string_buffer(batch.column("text"))
    for i, j in _groups(off):
        text, edges = data[off[i] : off[j]], off[i : j + 1] - off[i]
        starts, ends = word_bounds(text, edges)
        units = word_hashes(text, starts, ends)
        bounds = np.searchsorted(starts, edges)
        if j == i + 1:
            for a, b in _parts(len(units), window):
                yield Piece(
                    units[a:b], np.array([0]), np.array([b - a]), np.array([i]), np.array([a])
                )
        else:
            yield Piece(
                units, bounds[:-1], bounds[1:], np.arange(i, j), np.zeros(j - i, np.int64)
            )


def bucket_of(least: np.ndarray, n: int) -> np.ndarray:
    return ((mix(least) >> np.uint64(20)) % np.uint64(n)).astype(np.int32)


def bucket_slices(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by bucket, and (bucket, from, to) of each in that order."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(order) else []
    ends = [*at[1:], len(order)]
    return order, [(int(ordered[a]), int(a), int(b)) for a, b in zip(at, ends)]


def emit(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
        ["bucket", "blob"],
    )


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


Pieces = Callable[[pa.RecordBatch, int], Iterator[Piece]]


def flag_repeats(
    docs: DataFrame, pieces: Pieces, window: int, gram: int, inner: bool = True
) -> DataFrame:
    """``id, version, flags``: starts of the runs whose smallest hash occurs more than once,
    with ``inner`` also if that is within the run. ``docs`` is :func:`tables.keyed`."""
    n = buckets(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = longs(batch, "id"), longs(batch, "version")
            runs = batch_runs(pieces(batch, window), window, gram, inner)
            order = np.argsort(runs.least, kind="stable")
            equal = np.zeros(len(order) + 1, bool)
            equal[1:-1] = runs.least[order][1:] == runs.least[order][:-1]
            # All but the first of equal hashes are known to repeat; the first stands for them.
            new, sure = np.empty(len(order), bool), runs.again.copy()
            new[order] = ~equal[:-1]
            sure[order] |= equal[:-1] | equal[1:]
            # Those need not meet their equals, so a hot hash does not fill the bucket of its own.
            place = ids[runs.doc].view(np.uint64) ^ mix(runs.pos.astype(np.uint64))
            by, slices = bucket_slices(bucket_of(np.where(new, runs.least, place), n))
            rows = []
            for b, i, j in slices:
                x = by[i:j]
                d = runs.doc[x]
                columns = new[x], sure[x], steps(ids[d]), versions[d], runs.pos[x]
                rows.append((b, pack(runs.least[x][new[x]], *columns)))
            if rows:
                yield emit(rows)

    def count(table: pa.Table) -> pa.Table:
        least, new, sure, ids, versions, pos = unpack_all(
            table.column("blob"), np.uint64, bool, bool, Steps, np.int64, np.int64
        )
        shipped = np.flatnonzero(new)
        order = np.argsort(least, kind="stable")
        ordered = least[order]
        equal = np.zeros(len(ordered) + 1, bool)
        equal[1:-1] = ordered[1:] == ordered[:-1]
        sure = sure.copy()
        sure[shipped[order]] |= equal[1:] | equal[:-1]
        return pa.table({"id": ids[sure], "version": versions[sure], "pos": pos[sure]})

    found = (
        docs.mapInArrow(gather, BUCKETED)
        .groupBy("bucket")
        .applyInArrow(count, "id long, version long, pos long")
    )
    return found.groupBy("id", "version").agg(F.collect_list("pos").alias("flags"))


def flagged(runs: Runs, flag_docs: np.ndarray, flag_pos: np.ndarray) -> np.ndarray:
    """Which runs of a piece are flagged; flags are (row of the batch, position), any order."""
    if not len(runs.doc) or not len(flag_pos):
        return np.zeros(len(runs.doc), bool)
    near = (flag_docs >= runs.doc.min()) & (flag_docs <= runs.doc.max())
    key = (flag_docs[near].astype(np.int64) << 44) | flag_pos[near]
    return np.isin((runs.doc << 44) | runs.pos, key)


def flags_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("flags")
    lengths = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy()


def with_flags(docs: DataFrame, flags: DataFrame) -> DataFrame:
    return docs.join(flags, ["id", "version"])


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with ``spans``: the (start, windows) to be removed, in any order; or null."""
    per = spans.groupBy("id", "version").agg(
        F.collect_list(F.struct("pos", "length")).alias("spans")
    )
    return docs.join(per, ["id", "version"], "left")


SPANS = "id long, version long, pos long, length long"


def span_table(ids, versions, pos, length) -> pa.Table:
    return pa.table({"id": ids, "version": versions, "pos": pos, "length": length})


def merged(pos: np.ndarray, length: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal unit runs that the windows starting in the spans cover."""
    order = np.argsort(pos, kind="stable")
    start, end = pos[order], np.maximum.accumulate((pos + length + window - 1)[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return start[new], end[last]


def span_arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pos, length) of each row's spans."""
    column = batch.column("spans")
    at = np.cumsum(np.concatenate([[0], [0 if n is None else n for n in _sizes(column)]]))
    inner = column.flatten()
    pos = inner.field("pos").to_numpy(zero_copy_only=False)
    length = inner.field("length").to_numpy(zero_copy_only=False)
    for a, b in zip(at[:-1], at[1:]):
        yield pos[a:b], length[a:b]


def _sizes(column: pa.ListArray) -> list[int | None]:
    return pc.list_value_length(column).to_pylist()


def intervals(found, owner, ids, versions, pos, count) -> list[np.ndarray]:
    """Marks of single starts as (id, version, start, length) of their runs."""
    edge = np.zeros(len(found) + 1, np.int8)
    edge[:-1] += found
    edge[1:] -= found
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    begins = found & (np.concatenate([[False], ~found[:-1]]) | first)
    ends = found & np.concatenate([~found[1:] | first[1:], [True]])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    base = np.cumsum(count) - count
    who = owner[a]
    return [ids[who], versions[who], pos[who] + a - base[who], b - a + 1]
