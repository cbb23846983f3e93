"""SQL for what SQL can express, over views named like the test tables.

Not expressible, and held against brute force in the tests: token ids (1's CRC, 2, 3, 8),
sliding entropy (7), hashed n-gram ratios (9), names told by what stands before them (10).
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


_REPEATED_PASSAGES = f"""
    WITH docs AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(words[i + 1 : i + 20], ' ') AS phrase
        FROM (SELECT doc_id, words, unnest(range(0, len(words) - 19)) AS i FROM docs) AS s),
    again AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) AS place
            FROM windows) AS ranked
        WHERE place > 1),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM again),
    single AS (
        SELECT doc_id, unnest(range(0, len(words))) AS pos, unnest(words) AS word FROM docs),
    kept AS (
        SELECT s.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY s.pos) AS text
        FROM single AS s ANTI JOIN gone AS g ON s.doc_id = g.doc_id AND s.pos = g.pos
        GROUP BY s.doc_id)
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM docs AS d LEFT JOIN kept AS k ON d.doc_id = k.doc_id"""

_REPEATED_STRINGS = """
    WITH docs AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (
        SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS piece
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM docs) AS s),
    again AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, min(doc_id) OVER (PARTITION BY piece) AS first FROM windows) AS f
        WHERE first < doc_id),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM again),
    spans AS (
        SELECT doc_id, count(*) AS n, count(*) FILTER (before IS NULL OR before < pos - 1) AS runs
        FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before
              FROM gone) AS g
        GROUP BY doc_id),
    single AS (
        SELECT doc_id, pos, substr(h, 2 * pos + 1, 2) AS byte
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS pos FROM docs
              WHERE doc_id IN (SELECT doc_id FROM spans)) AS s),
    kept AS (
        SELECT s.doc_id, string_agg(byte, '' ORDER BY s.pos) AS h
        FROM single AS s ANTI JOIN gone AS g ON s.doc_id = g.doc_id AND s.pos = g.pos
        GROUP BY s.doc_id)
    SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes,
           CAST(coalesce(s.n, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(s.runs, 0) AS BIGINT) AS n_spans,
           sha256(unhex(CASE WHEN s.n IS NULL THEN d.h ELSE coalesce(k.h, '') END)) AS kept_sha256
    FROM docs AS d LEFT JOIN spans AS s ON d.doc_id = s.doc_id
    LEFT JOIN kept AS k ON d.doc_id = k.doc_id"""

_NEAR_COPIES = f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id,
               {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS words
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(words[i + 1 : i + 3], ' ') AS shingle
        FROM (SELECT doc_id, words,
                     unnest(range(0, CASE WHEN len(words) = 0 THEN 0
                                          ELSE greatest(1, len(words) - 2) END)) AS i
              FROM docs) AS s),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM pairs JOIN sizes AS s ON a = s.doc_id JOIN sizes AS t ON b = t.doc_id
        WHERE 100 * pairs.n >= 85 * (s.n + t.n - pairs.n)),
    ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM docs
        UNION
        SELECT r.a, w.b FROM reach AS r JOIN ways AS w ON r.b = w.a),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, component_id,
           d.doc_id = component_id AS kept
    FROM docs AS d JOIN least ON d.doc_id = a LEFT JOIN sizes AS s ON d.doc_id = s.doc_id"""

_HARD_NEGATIVES = """
    WITH ready AS (
        SELECT row_number() OVER () AS r, vec_id,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS other,
               a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM ready AS a JOIN ready AS b ON a.r <> b.r AND len(a.v) = len(b.v)
        WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY anchor ORDER BY score DESC, other NULLS LAST) AS place
            FROM pairs WHERE same) AS p
        WHERE place <= 5),
    ranked AS (
        SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id,
               p.score AS positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor, p.place
                                  ORDER BY n.score DESC, n.other NULLS LAST) AS rank
        FROM positives AS p JOIN pairs AS n
          ON p.anchor = n.anchor AND NOT n.same
         AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id,
           positive_score, negative_score
    FROM ranked WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_repeated_passages": _REPEATED_PASSAGES,
        "op5_repeated_strings": _REPEATED_STRINGS,
        "op6_signature_near_copies": _NEAR_COPIES,
        "op12_slot_negatives": _HARD_NEGATIVES,
    }
