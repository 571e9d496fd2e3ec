"""SQL of the registered queries that another engine can run over whole tables.

Documents are told apart by ``doc_id``, which is unique in the tables this SQL is run on.
"""

from __future__ import annotations

from . import divergence, filter_audit

#: Runs of overlapping or touching units are told apart by a gap before them.
_RUNS = """
    marked AS (
        SELECT doc_id, i, coalesce(i - lag(i) OVER w > {size}, TRUE) AS fresh
        FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    numbered AS (
        SELECT doc_id, i, sum(fresh::INT) OVER (
            PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM marked),
    runs AS (
        SELECT doc_id, min(i) AS a, max(i) + {size} AS b FROM numbered GROUP BY doc_id, run),
    gaps AS (
        SELECT doc_id, a, b, coalesce(lag(b) OVER w, 1) AS since FROM runs
        WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
    ends AS (
        SELECT doc_id, max(b) AS since, sum(b - a) AS removed, count(*) AS n FROM runs
        GROUP BY doc_id)"""

#: Every 100-byte string, as 200 hexadecimal digits, and the first place it starts at.
SUFFIX_DEDUP = f"""
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
    SELECT doc_id, i, substring(h, 2 * i - 1, 200) AS s
    FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 98)) AS i FROM d)),
firsts AS (
    SELECT s, min(doc_id::HUGEINT * 4294967296 + i) AS least FROM windows
    GROUP BY s HAVING count(*) > 1),
hit AS (
    SELECT doc_id, i FROM windows JOIN firsts USING (s)
    WHERE doc_id::HUGEINT * 4294967296 + i > least),
{_RUNS.format(size=100)},
kept AS (
    SELECT doc_id, string_agg(substring(h, 2 * since - 1, 2 * (a - since)), '' ORDER BY a) AS k
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
    coalesce(n, 0) AS n_spans,
    sha256(unhex(CASE WHEN n IS NULL THEN h ELSE k || substring(h, 2 * since - 1) END)) AS kept_sha256
FROM d LEFT JOIN ends USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: Every window of 50 words, and the smallest document it starts in.
WINDOW_DEDUP = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
hit AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE doc_id > least),
{_RUNS.format(size=50)},
kept AS (
    SELECT doc_id, string_agg(array_to_string(w[since:a - 1], ' '), ' ' ORDER BY a)
        FILTER (WHERE a > since) AS k
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
    sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
        WHEN since > len(w) THEN coalesce(k, '')
        ELSE concat_ws(' ', k, array_to_string(w[since:len(w)], ' ')) END) AS kept_sha256
FROM d LEFT JOIN ends USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

WARC = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id > least THEN least END AS refers_to
FROM f
"""

ORACLES = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op5_window_dedup": WINDOW_DEDUP,
    "op8_warc": WARC,
    "op12_source_divergence": divergence.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
