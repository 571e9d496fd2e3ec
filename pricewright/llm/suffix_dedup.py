"""Removal of repeated byte strings by longest-previous-factor arrays.

Method: suffixes are sorted, and for every position the previous and the next smaller position in
suffix order give the longest match that starts earlier (its longest previous factor). A position
whose factor reaches ``length`` bytes starts a string that was seen before; all bytes such strings
cover are removed, so the first copy stays.

A suffix array of the whole corpus would be one structure. Only ``length`` bytes of a suffix
matter here, so the corpus is cut into runs of neighbouring windows that equal windows always share
(see :mod:`runs`), runs without a partner are left out, and each bucket sorts the suffixes of its
own runs. Every pair of equal windows meets in one bucket, so the result is that of one array.

Defined cases: null and empty texts give no bytes; a text shorter than ``length`` loses none; null
ids are one document before all others; rows that share an id are versions of one document, where
only an earlier start counts as earlier; repeated rows get equal results; an empty table gives an
empty result. Columns other than ``doc_id`` and ``text`` are not used, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import runs as R
from .tables import BUCKETED, buckets, keyed, read

LENGTH = 100
GRAM = 24
#: Packed rows sent on at a time.
ROWS = 64
_KINDS = (np.uint64, R.Steps, np.int64, np.int64, bool, np.int64, np.uint8)
_LOCAL = (R.Steps, np.int64, np.int64, np.int64)


def ranks(text: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Dense ranks of the substrings at every position, by doubling up to ``length``.

    Returns (size, ranks) of each step; positions too near the end for a size have no rank in it.
    """
    size, key, out = 1, text.astype(np.uint64), []
    while size < min(8, length):
        step = min(size, length - size)
        key = (key[: len(key) - step] << np.uint64(8 * step)) | (
            key[step:] & np.uint64((1 << (8 * step)) - 1)
        )
        size += step
    while True:
        values, rank = np.unique(key, return_inverse=True)
        out.append((size, rank.astype(np.uint64)))
        if size >= length:
            return out
        step = min(size, length - size)
        rank = out[-1][1]
        if len(rank) <= step:
            return out
        key = (rank[: len(rank) - step] << np.uint64(32)) | rank[step:]
        size += step


def previous_smaller(
    values: np.ndarray, shared: np.ndarray, floor: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest earlier place with a smaller value (-1: none), and the least of
    ``shared`` on the way; ``shared[i]`` belongs to the step from ``i`` to ``i - 1``. A search
    ends early, with what it has, where the least falls below ``floor``.

    All places jump at once: what lies between a place and its candidate is larger than the
    place, so the candidate's own candidate is the next to try.
    """
    at = np.arange(len(values)) - 1
    least = shared.copy()
    todo = np.flatnonzero((at >= 0) & (least >= floor))
    while len(todo := todo[values[at[todo]] > values[todo]]):
        jump = at[todo]
        least[todo] = np.minimum(least[todo], least[jump])
        at[todo] = at[jump]
        todo = todo[(at[todo] >= 0) & (least[todo] >= floor)]
    return at, np.where(at >= 0, least, 0)


def longest_previous_factor(order: np.ndarray, lcp: np.ndarray, floor: int = 0) -> np.ndarray:
    """The longest previous factor of each suffix, by place in ``order``; those below ``floor``
    are not exact, but below it.

    ``order`` holds text positions in suffix order, ``lcp[i]`` the common prefix of the
    suffixes at places ``i`` and ``i - 1`` (``lcp[0]`` is 0).
    """
    _, before = previous_smaller(order, lcp, floor)
    back = np.concatenate([[0], lcp[:0:-1]]) if len(lcp) else lcp
    _, after = previous_smaller(order[::-1], back, floor)
    return np.maximum(before, after[::-1])


def repeated_starts(
    text: np.ndarray, starts: np.ndarray, length: int, rank: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``starts`` have a previous factor of ``length`` bytes or more among them, and the
    first start (as an index) with the same ``length`` bytes.

    ``rank`` says which start counts as earlier; by default they are in order. Common prefixes below ``length`` are rounded down to a doubling step.
    """
    if not len(starts):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    levels = ranks(text, length)
    classes = levels[-1][1][starts]
    rank = np.arange(len(starts)) if rank is None else rank
    # Within a class the order of suffixes is not known beyond ``length``, and does not matter.
    order = np.lexsort((rank, classes))
    suffixes = starts[order]
    lcp = np.zeros(len(order), np.int64)
    for size, level in levels:
        here = level[suffixes]
        lcp[1:][here[1:] == here[:-1]] = size
    found, first = np.zeros(len(starts), bool), np.empty(len(starts), np.int64)
    found[order] = longest_previous_factor(rank[order], lcp, length) >= length
    heads = np.flatnonzero(lcp < length)
    first[order] = order[np.repeat(heads, np.diff(np.append(heads, len(order))))]
    return found, first


def first_copies(text, start, size, least, ids, pos) -> tuple[np.ndarray, np.ndarray]:
    """(kept, removed): runs to go on with, and runs that are copies of an earlier kept one.

    Runs are classed by length and three samples of their text; equality is then checked byte by
    byte, so a run that only looks alike is kept.
    """
    n = len(start)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    words = np.zeros(n, np.uint64)
    for place in (0 * size, size // 2 - 4, size - 8):
        for i in range(8):
            words = words * np.uint64(0x100000001B3) + text[start + place + i]
    label = R.mix(words ^ least ^ (size.astype(np.uint64) << np.uint64(40)))
    order = np.lexsort((pos, ids, label))
    new = np.ones(n, bool)
    new[1:] = label[order][1:] != label[order][:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    rest = np.flatnonzero(~new)
    kept, removed = np.ones(n, bool), np.zeros(n, bool)
    if len(rest):
        lead, own = order[first[rest]], order[rest]
        same = (size[lead] == size[own]) & ((ids[lead] != ids[own]) | (pos[lead] != pos[own]))
        rest, first_of = rest[same], first[rest][same]
        if len(rest):
            equal = _same(text, start, size, order[rest], order[first_of])
            gone = order[rest[equal]]
            kept[gone], removed[gone] = False, True
    return kept, removed


def _same(text, start, size, own, lead) -> np.ndarray:
    n = size[own]
    differ = text[R.spread(start[own], n)] != text[R.spread(start[lead], n)]
    return np.add.reduceat(differ, np.concatenate([[0], np.cumsum(n)[:-1]])) == 0


def _laid_out(size: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Where the windows of runs start when the texts of the runs are joined."""
    return R.spread(np.cumsum(size) - size, count)


def _hashed_twice(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which starts share the hash of their ``length`` bytes with another."""
    out = np.zeros(len(starts), bool)
    if len(starts):
        hashes = R.byte_grams(text, length)[starts]
        order = np.argsort(hashes)
        equal = hashes[order][1:] == hashes[order][:-1]
        out[order[1:][equal]] = out[order[:-1][equal]] = True
    return out


def removed_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``id, version, pos, length``: runs of window starts whose ``length`` bytes start earlier."""
    if length < 16:
        raise ValueError("strings of less than 16 bytes are no sign of a copy")
    gram = min(GRAM, length // 2)
    n = buckets(docs.sparkSession)
    flags = R.flag_repeats(docs, R.byte_pieces, length, gram)

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = R.longs(batch, "id"), R.longs(batch, "version")
            marks = R.flags_of(batch)
            data, off = R.string_buffer(batch.column("text"))
            runs = R.batch_runs(
                R.byte_pieces(batch, length),
                length,
                gram,
                True,
                lambda piece, found: R.flagged(found, *marks),
            )
            doc, pos, count = runs.doc, runs.pos, runs.length
            start, size = off[doc] + pos, count + length - 1
            kept, gone = first_copies(data, start, size, runs.least, ids[doc], pos)
            by, slices = R.bucket_slices(R.bucket_of(runs.least, n))
            rows = []
            for b, i, j in slices:
                y = by[i:j]
                k, g = y[kept[y]], y[gone[y]]
                text = data[R.spread(start[k], size[k])]
                whole = (runs.least[k], R.steps(ids[doc[k]]), versions[doc[k]], pos[k])
                local = (R.steps(ids[doc[g]]), versions[doc[g]], pos[g], count[g])
                rows.append((b, R.pack(*whole, runs.again[k], count[k], text, *local)))
                if len(rows) == ROWS:
                    yield R.emit(rows)
                    rows = []
            if rows:
                yield R.emit(rows)

    def compare(table: pa.Table) -> pa.Table:
        least, ids, versions, pos, again, count, text, *local = R.unpack_all(
            table.column("blob"), *_KINDS, *_LOCAL
        )
        size = count + length - 1
        start = np.cumsum(size) - size
        kept, gone = first_copies(text, start, size, least, ids, pos)
        out = [local, [ids[gone], versions[gone], pos[gone], count[gone]]]
        k = np.flatnonzero(kept)
        _, inverse, seen = np.unique(least[k], return_inverse=True, return_counts=True)
        k = k[(seen[inverse] > 1) | again[k]]
        # Equal strings have equal hashes: runs without such a pair are not sorted.
        starts = _laid_out(size[k], count[k])
        twin = _hashed_twice(text[R.spread(start[k], size[k])], starts, length)
        if len(k):
            k = k[np.logical_or.reduceat(twin, np.cumsum(count[k]) - count[k])]
        k = k[np.lexsort((versions[k], pos[k], ids[k]))]
        starts = _laid_out(size[k], count[k])
        owner = np.repeat(np.arange(len(k)), count[k])
        place, who = R.spread(pos[k], count[k]), ids[k][owner]
        rank = None
        if versions.any():
            rank = np.empty(len(starts), np.int64)
            rank[np.lexsort((versions[k][owner], place, who))] = np.arange(len(starts))
        joined = text[R.spread(start[k], size[k])]
        found, first = repeated_starts(joined, starts, length, rank)
        # The same place in another version of the document is not an earlier start.
        found &= (who != who[first]) | (place != place[first])
        out.append(R.intervals(found, owner, ids[k], versions[k], pos[k], count[k]))
        return R.span_table(*(np.concatenate(c) for c in zip(*out)))

    return (
        R.with_flags(docs, flags)
        .mapInArrow(ship, BUCKETED)
        .groupBy("bucket")
        .applyInArrow(compare, R.SPANS)
    )


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text, n_bytes, removed`` of every row; ``removed`` holds the maximal byte runs
    (start, end exclusive) that were taken out, ``text`` is what is left, as bytes."""
    rows = keyed(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = R.string_buffer(batch.column("text"))
            ids, out = R.longs(batch, "id"), []
            for i, (pos, count) in enumerate(R.span_arrays(batch)):
                text = data[off[i] : off[i + 1]]
                if not len(pos):
                    out.append((text.tobytes(), []))
                    continue
                start, end = R.merged(pos, count, length)
                keep = np.ones(len(text), bool)
                keep[R.spread(start, end - start)] = False
                runs = [{"start": int(a), "end": int(b)} for a, b in zip(start, end)]
                out.append((text[keep].tobytes(), runs))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=ids == R.NULL_ID),
                    pa.array([t for t, _ in out], pa.binary()),
                    pa.array(np.diff(off)),
                    pa.array([r for _, r in out], kind),
                ],
                ["doc_id", "text", "n_bytes", "removed"],
            )

    return R.with_spans(rows, removed_windows(rows, length)).mapInArrow(
        cut,
        "doc_id long, text binary, n_bytes long, removed array<struct<start:long,end:long>>",
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        "n_bytes",
        "n_bytes - octet_length(text) AS n_removed",
        "CAST(size(removed) AS LONG) AS n_spans",
        "sha2(text, 256) AS kept_sha256",
    )
