"""Removal of repeated token windows by Rabin-Karp hashes counted in Spark.

Method: every window of ``window`` consecutive words has a rolling polynomial hash modulo
2^61 - 1; hashes are grouped, and a window whose hash also occurs in a document with a smaller id is
removed. Neighbouring removed windows merge into maximal word intervals.

Equal windows share their smallest word-gram hash (see :mod:`runs`), so only windows whose gram repeats
in the corpus are hashed and written, once a batch. Spark aggregates the least id of each run of windows
(gram hash and hash of the run), so copies go as whole runs; of runs that share their gram only, it aggregates
the least id of each window (gram hash and window hash, 125 bits in all). Both are joined back to their rows:
a gram, a passage or a document that a third of all rows share is no group of one task.

Defined cases: null and empty texts have no words; texts shorter than a window lose none; null ids
are one document before all others; rows that share an id are one document, so they never remove
words from each other; an empty table gives an empty result. Columns other than ``doc_id`` and
``text`` are not used, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import runs as R
from .tables import keyed, read, stage

WINDOW = 50
GRAM = 8
PRIME = (1 << 61) - 1
_BASE = 0x1B873593CC9E2D51 % PRIME
#: Windows of a batch that are sorted at a time.
LOT = 1 << 21
NAMES = ["id", "version", "pos", "length", "least", "hashes"]


def mulmod(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo 2^61 - 1, for a < 2^61, by 32-bit halves."""
    p, low = np.uint64(PRIME), np.uint64((1 << 32) - 1)
    s32, s29, s61, s3 = (np.uint64(n) for n in (32, 29, 61, 3))
    bh, bl = np.uint64(b >> 32), np.uint64(b & ((1 << 32) - 1))
    ah, al = a >> s32, a & low
    mid = ah * bl + al * bh  # < 2^62
    low_part = al * bl
    # a * b = ah * bh * 2^64 + mid * 2^32 + low_part, and 2^61 = 1 modulo p.
    total = (ah * bh << s3) + (mid >> s29) + ((mid & np.uint64((1 << 29) - 1)) << s32)
    total = (total & p) + (total >> s61)
    total += (low_part & p) + (low_part >> s61)
    total = (total & p) + (total >> s61)
    return np.where(total >= p, total - p, total)


def rolling(units: np.ndarray, window: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``window`` units, modulo 2^61 - 1, by doubling."""
    p = np.uint64(PRIME)

    def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        c = a + b
        return np.where(c >= p, c - p, c)

    level = units % p
    size, levels = 1, {1: level}
    while size * 2 <= window:
        level = add(mulmod(level[:-size], pow(_BASE, size, PRIME)), level[size:])
        size *= 2
        levels[size] = level
    have, out = size, level
    for step in sorted(levels, reverse=True):
        if step < size and have + step <= window:
            left = out[: len(units) - have - step + 1]
            out = add(
                mulmod(left, pow(_BASE, step, PRIME)), levels[step][have : have + len(left)]
            )
            have += step
    return out


def _lots(count: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring runs of about ``LOT`` windows together; a run is never cut."""
    lot = (np.cumsum(count) - count) // LOT
    at = np.flatnonzero(np.diff(lot, prepend=-1, append=lot[-1] + 1)) if len(lot) else []
    yield from zip(at[:-1], at[1:])


def _known(hashes, least, ids, count) -> tuple[np.ndarray, np.ndarray]:
    """Of each window, the run that owns it and whether a smaller id here has it too."""
    owner = np.repeat(np.arange(len(ids)), count)
    order = np.lexsort((ids[owner], hashes, least[owner]))
    h, o = hashes[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (least[o][1:] != least[o][:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    known = np.empty(len(order), bool)
    known[order] = ids[o] > ids[o[first]]
    return owner, known


def candidates(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, version, pos, length, least, hashes``: runs of starts of windows whose gram repeats.

    A run has its gram hash and the hash of each of its windows; without hashes it is one of
    windows that a smaller id of the same batch has too, so a window of a group of copies is sent
    on once a batch.
    """
    gram = min(GRAM, max(1, window // 2))
    flags = R.flag_repeats(docs, R.word_pieces, window, gram, inner=False)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = R.longs(batch, "id"), R.longs(batch, "version")
            marks = R.flags_of(batch)
            parts = []

            def choose(piece: R.Piece, found: R.Runs) -> np.ndarray:
                x = R.flagged(found, *marks)
                own = rolling(piece.units, window) if x.any() else np.zeros(0, np.uint64)
                parts.append(own[R.spread(found.start[x], found.length[x])])
                return x

            runs = R.batch_runs(R.word_pieces(batch, window), window, gram, False, choose)
            hashes = np.concatenate([np.zeros(0, np.uint64), *parts])
            edge = np.concatenate([[0], np.cumsum(runs.length)])
            for i, j in _lots(runs.length):
                doc, pos, count = runs.doc[i:j], runs.pos[i:j], runs.length[i:j]
                least, own = runs.least[i:j], hashes[edge[i] : edge[j]]
                owner, known = _known(own, least, ids[doc], count)
                for marked, open_ in ((known, False), (~known, True)):
                    who, _, at, length = R.intervals(
                        marked, owner, np.arange(j - i), versions[doc], pos, count
                    )
                    columns = [ids[doc][who], versions[doc][who], at, length]
                    if open_:
                        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                        inner = pa.array(own[marked].view(np.int64))
                        columns += [least[who].view(np.int64), pa.ListArray.from_arrays(ends, inner)]
                    else:
                        columns += [pa.nulls(len(who), t) for t in (pa.int64(), pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], NAMES)

    return R.with_flags(docs, flags).mapInArrow(
        find, f"{R.SPANS}, least long, hashes array<long>"
    )


def removed_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, version, pos, length``: runs of starts of windows that a smaller id has too."""
    tables = stage(docs.sparkSession)
    found = candidates(docs, window).withColumn("run", F.xxhash64("hashes"))
    found = tables.table(found, "windows")
    start = ["id", "version", "pos", "length"]
    # Equal runs first: all but those of the least id go whole.
    runs = found.filter("hashes IS NOT NULL")
    least = runs.groupBy("least", "run").agg(F.min("id").alias("first"))
    several = least.groupBy("least").agg((F.count("run") > 1).alias("several"))
    judged = runs.join(least.join(several, "least"), ["least", "run"])
    judged = judged.filter("several OR id > first").select(
        *start, "least", F.when(F.col("id") == F.col("first"), F.col("hashes")).alias("hashes")
    )
    judged = tables.table(judged, "runs")
    # Then single windows, where different runs have one gram in common.
    windows = judged.filter("hashes IS NOT NULL").select(
        "id", "version", "pos", "least", F.posexplode("hashes").alias("at", "hash")
    )
    owners = windows.groupBy("least", "hash").agg(F.min("id").alias("first"))
    later = windows.join(owners, ["least", "hash"]).filter("id > first")
    single = later.selectExpr("id", "version", "pos + at AS pos", "1L AS length")
    whole = [t.filter("hashes IS NULL").select(start) for t in (found, judged)]
    return whole[0].unionByName(whole[1]).unionByName(single)


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text, n_words, removed`` of every row; ``removed`` holds the maximal word
    intervals (start, end exclusive) that were taken out, ``text`` the kept words, one space apart."""
    rows = keyed(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = R.string_buffer(batch.column("text"))
            ids, out = R.longs(batch, "id"), []
            for i, (pos, count) in enumerate(R.span_arrays(batch)):
                words = data[off[i] : off[i + 1]].tobytes().split()
                kept, runs = words, []
                if len(pos):
                    start, end = R.merged(pos, count, window)
                    runs = [{"start": int(a), "end": int(b)} for a, b in zip(start, end)]
                    kept, at = [], 0
                    for a, b in zip(start, end):
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                out.append((b" ".join(kept), len(words), runs, len(words) - len(kept)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=ids == R.NULL_ID),
                    pa.array([t[0] for t in out], pa.binary()).cast(pa.string()),
                    pa.array([t[1] for t in out], pa.int64()),
                    pa.array([t[3] for t in out], pa.int64()),
                    pa.array([t[2] for t in out], kind),
                ],
                ["doc_id", "text", "n_words", "n_removed", "removed"],
            )

    return R.with_spans(rows, removed_windows(rows, window)).mapInArrow(
        cut,
        "doc_id long, text string, n_words long, n_removed long, "
        "removed array<struct<start:long,end:long>>",
    )


def op5_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_words", "n_removed", "sha2(CAST(text AS BINARY), 256) AS kept_sha256"
    )
