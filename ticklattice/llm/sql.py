"""DuckDB SQL for the training-data queries that SQL can express exactly. It goes over whole tables and all pairs that share
something, so it is for small tables.

The other operators' results depend on zstandard sizes, on fitted probes, on a tokenizer or on Spark's row hashes.
"""

from __future__ import annotations

import string

_WORDS = f"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+')"


def _shingles(table: str, key: str, width: int) -> str:
    """(key, s): the different shingles of each row; with fewer words, all of them are one."""
    runs = f"list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))"
    return (
        f"SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {width} THEN {runs} WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s "
        f"FROM (SELECT {key}, {_WORDS} AS w FROM {table} WHERE text IS NOT NULL)"
    )


#: Every pair of a document and an item of which it holds at least 80 % of the five-word shingles.
CONTAINED = f"""
    WITH i AS ({_shingles("benchmark", "item_id", 5)}), d AS ({_shingles("documents", "doc_id", 5)}), n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
    m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i ON d.s = i.s GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_item, n_shared, CAST(n_shared AS DOUBLE) / n_item AS containment FROM m JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""



def _linked(num: int) -> str:
    """f: components of the documents under 100 * intersection >= num * union of four-word shingles; n: the sizes of their sets."""
    return f"""
    WITH RECURSIVE d AS ({_shingles("documents", "doc_id", 4)}), n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM d AS x JOIN d AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    e AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * m >= {num} * (na.n + nb.n - m)),
    r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
    f AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)"""


NEAR = f"{_linked(80)} SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM f LEFT JOIN n USING (doc_id)"
JOINED = f"{_linked(85)} SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM f LEFT JOIN n USING (doc_id)"

#: Bytes covered by 100-byte strings that also start earlier.
REPEATS = """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    w AS (SELECT doc_id, i, md5(t[i + 1:i + 100]) AS k FROM (SELECT doc_id, t, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
    c AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
    g AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM c)),
    s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, run),
    k AS (SELECT doc_id, 0 AS a, min(a) AS b FROM s GROUP BY doc_id UNION ALL SELECT doc_id, s.b, coalesce(lead(s.a) OVER (PARTITION BY doc_id ORDER BY s.a), n) FROM s JOIN d USING (doc_id)),
    h AS (SELECT doc_id, string_agg(CASE WHEN k.b > k.a THEN hex(t[k.a + 1:k.b]) ELSE '' END, '' ORDER BY k.a, k.b) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
    q AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, CASE WHEN kept IS NULL THEN sha256(t) ELSE sha256(unhex(kept)) END AS kept_sha256
    FROM d LEFT JOIN q USING (doc_id) LEFT JOIN h USING (doc_id)
"""

#: Lines that an equal line, or from 16 characters on one within an edit, precedes; what is left of each text.
LINES = r"""
    WITH l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
    u AS (SELECT line, length(line) AS n, min({'d': doc_id, 'l': line_no}) AS place FROM l WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY line),
    k AS (SELECT line, n, place, f, q, CASE q WHEN 0 THEN left(line, f // 2) ELSE right(line, f - f // 2) END AS half FROM (SELECT *, n - less AS f FROM u, (VALUES (0), (1)) AS x(less) WHERE n >= 16), (VALUES (0), (1)) AS y(q)),
    p AS (SELECT DISTINCT a.line AS late, CASE WHEN a.n <= b.n THEN a.line ELSE b.line END AS s, CASE WHEN a.n <= b.n THEN b.line ELSE a.line END AS t
          FROM k AS a JOIN k AS b ON a.f = b.f AND a.q = b.q AND a.half = b.half AND a.place > b.place AND least(a.n, b.n) = a.f),
    e AS (SELECT *, coalesce(nullif(list_position(list_transform(range(1, length(s) + 1), lambda i: substr(s, i, 1) <> substr(t, i, 1)), true), 0) - 1, length(s)) AS same FROM p),
    g AS (SELECT DISTINCT late AS line FROM e WHERE substr(t, CAST(same + 2 AS BIGINT)) = substr(s, CAST(same + 2 - (length(t) - length(s)) AS BIGINT))),
    m AS (SELECT l.*, u.line IS NOT NULL AND (g.line IS NOT NULL OR u.place <> {'d': l.doc_id, 'l': l.line_no}) AS gone FROM l LEFT JOIN u ON l.line = u.line LEFT JOIN g ON l.line = g.line),
    r AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS kept FROM m GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, md5(kept) AS kept_md5, CAST(length(kept) AS INTEGER) AS kept_chars FROM documents LEFT JOIN r USING (doc_id)
"""

#: Documents drawn by hashed features' importance: CRC-32 by its table of 256 entries, one byte of each feature a step.
RESAMPLED = f"""
    WITH RECURSIVE k(i, c, step) AS (SELECT i, i, 0 FROM (SELECT unnest(range(256)) AS i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM k WHERE step < 8),
    tab AS (SELECT i, c FROM k WHERE step = 8),
    w AS (SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
          UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
    f AS (SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w),
    h AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
    s(f, h, pos, crc) AS (SELECT f, h, 0, 4294967295 FROM h UNION ALL SELECT f, h, pos + 1, xor(s.crc >> 8, tab.c) FROM s JOIN tab ON tab.i = xor(s.crc, ('0x' || substr(h, 2 * pos + 1, 2))::BIGINT) & 255 WHERE 2 * pos < length(h)),
    b AS (SELECT f, xor(crc, 4294967295) % 10000 AS bucket FROM s WHERE 2 * pos = length(h)),
    c AS (SELECT kind, id, bucket, count(*) AS n FROM f JOIN b USING (f) GROUP BY ALL),
    t AS (SELECT x.bucket, coalesce(sum(n) FILTER (WHERE kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE kind = 'b'), 0) AS t FROM (SELECT unnest(range(10000)) AS bucket) AS x LEFT JOIN c ON c.bucket = x.bucket GROUP BY 1),
    g AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST((SELECT sum(s) FROM t) AS DOUBLE) + 10000) / ((CAST(s AS DOUBLE) + 1) * (CAST((SELECT sum(t) FROM t) AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM t),
    v AS (SELECT id, sum(n) AS m, CAST(sum(n * gain) AS BIGINT) AS total FROM c JOIN g USING (bucket) WHERE kind = 'd' GROUP BY id),
    q AS (SELECT doc_id, CAST(coalesce(m, 0) AS BIGINT) AS n_features, CASE WHEN m IS NULL THEN 0 ELSE CAST((total - ((total % m) + m) % m) / m AS BIGINT) END AS weight,
          ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM documents LEFT JOIN v ON id = doc_id),
    z AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM q),
    r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM z WHERE n_features >= 39)
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * able // 100 THEN rank END AS rank FROM z LEFT JOIN r USING (doc_id)
"""


def _codes() -> str:
    """Codebooks by two plain rounds, then codes."""
    near = lambda k: (
        f"a{k} AS (SELECT r, part, x, min({{'d': d, 'e': e}}) AS best FROM (SELECT p.r, p.part, p.x, c.e, CAST(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS BIGINT) AS d "
        f"FROM p JOIN c{k} AS c USING (part)) GROUP BY r, part, x)"
    )
    moved = lambda k: (
        f"u{k} AS (SELECT part, e, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY i) AS x FROM (SELECT part, best.e AS e, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (SELECT part, best, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY ALL) GROUP BY part, e), "
        f"c{k + 1} AS (SELECT part, e, coalesce(u.x, c.x) AS x FROM c{k} AS c LEFT JOIN u{k} AS u USING (part, e))"
    )
    return f"""
    WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
               FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (SELECT r, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS x FROM v, (SELECT unnest(range(16)) AS part)),
    c0 AS (SELECT part, r - 1 AS e, x FROM p WHERE r <= 64),
    {near(0)}, {moved(0)}, {near(1)}, {moved(1)}, {near(2)},
    o AS (SELECT v.r, vec_id, label, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a2 JOIN v USING (r) GROUP BY v.r, vec_id, label),
    h AS (SELECT sha256(string_agg(CAST(n AS VARCHAR), ',' ORDER BY part, e, i)) AS codebooks_sha256 FROM (SELECT part, e, unnest(x) AS n, generate_subscripts(x, 1) AS i FROM c2))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o, h
"""


CODES = _codes()
