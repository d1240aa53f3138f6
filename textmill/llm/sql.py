"""DuckDB statements of the queries."""

from __future__ import annotations

from textmill.catalog.sql import quoted
from textmill.llm import licences

OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, 3 * source_size AS lim, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sources
), ratios AS (
  SELECT *, lim / weight AS ratio FROM weighed
), running AS (
  SELECT *, row_number() OVER o AS place, sum(lim) OVER o - lim AS lims, sum(weight) OVER o - weight AS weights
  FROM ratios WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT place, ratio,
    CAST((SELECT sum(size) FROM sized) - lims AS BIGINT) / CAST((SELECT sum(weight) FROM weighed) - weights AS BIGINT) AS level
  FROM running
), shared AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE ratio >= level
), aims AS (
  SELECT source, source_size, least(CAST(lim AS DOUBLE), level * CAST(weight AS DOUBLE)) AS target FROM weighed, shared
), rated AS (
  SELECT s.doc_id, s.size, a.source_size, a.target,
    CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
      / 4503599627370496.0::DOUBLE AS unit
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN unit < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""

_USABLE = """embedding IS NOT NULL AND len(embedding) > 0 AND
    list_sum(list_transform(embedding, lambda x: CASE WHEN isfinite(x) THEN 0 ELSE 1 END)) = 0 AND
    len(list_filter(embedding, lambda x: x IS NULL)) = 0"""

OP8_SQL = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {_USABLE}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""

OP10_SQL = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), groups AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT e.vec_id, CAST((SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS BIGINT) AS n_links, g.component_id,
  e.vec_id = g.component_id AS kept
FROM embeddings e JOIN groups g USING (vec_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a, b FROM ways UNION SELECT r.a, l.b FROM reach r JOIN ways l ON r.b = l.a
), groups AS (
  SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN groups USING (doc_id)
"""


def _canonical(text: str) -> str:
    """The canonical form of a unit, with groups in place of look-ahead."""
    out = f"lower({text})"
    steps = [
        (r"(?m)^[^\p{L}\p{N}(©\n]*(?:copyright\b|\(c\)|©)[^\n]*$", " "),
        (r"(?m)^[^\p{L}\p{N}_]*all rights reserved[^\p{L}\p{N}_]*$", " "),
        *[(p, r) for p, r in licences.SPELLINGS if "(?=" not in p],
        (r"\b(?:version\s+|v\.?\s?)([0-9])", r"version \1"),
        (r"[^\p{L}\p{N}]+", " "),
    ]
    for pattern, replacement in steps:
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return f"trim({out})"


_KNOWN = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licences.KNOWN)

OP4_SQL = rf"""
WITH known AS (
  SELECT DISTINCT license, {_canonical('t')} AS form FROM (VALUES {_KNOWN}) k(license, t)
), texts AS (
  SELECT doc_id, text, regexp_replace(text, '\r\n?', chr(10), 'g') AS t FROM documents WHERE text IS NOT NULL
), units AS (
  SELECT doc_id, text AS unit, true AS whole FROM texts
  UNION ALL SELECT doc_id, unnest(regexp_split_to_array(t, '\n[ \t]*\n\s*')), false FROM texts
  UNION ALL SELECT doc_id, unnest(string_split(t, chr(10))), false FROM texts
), hits AS (
  SELECT u.doc_id, u.whole, k.license FROM (SELECT doc_id, whole, {_canonical('unit')} AS form FROM units) u JOIN known k USING (form)
), found AS (
  SELECT doc_id, max(license) FILTER (whole) AS whole, list_sort(list(DISTINCT license)) AS licenses FROM hits GROUP BY doc_id
)
SELECT d.doc_id, f.whole, coalesce(array_to_string(f.licenses, ','), '') AS licenses FROM documents d LEFT JOIN found f USING (doc_id)
"""

OP13_SQL = """
WITH e AS (
    SELECT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
a AS (SELECT * FROM e WHERE vec_id % 100 = 0),
s AS (
    SELECT a.vec_id AS anchor_id, a.lab AS alab, e.vec_id, e.lab,
           CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(e.q AS DOUBLE[])) AS BIGINT) AS score
    FROM a JOIN e ON len(a.q) = len(e.q)
),
pos AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
        FROM s WHERE lab = alab AND vec_id <> anchor_id
    ) WHERE r <= 5
),
neg AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.lab <> s.alab
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 10
"""
