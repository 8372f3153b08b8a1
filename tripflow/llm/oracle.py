"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

OP10 = r"""
WITH norm AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), ranked AS (
  SELECT doc_id, bare,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM norm
  WINDOW w AS (PARTITION BY bare ORDER BY length(text) DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256
FROM ranked
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


OP6 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_words(_LOWER)} AS ws FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda k: array_to_string(ws[k:k + 2], ' '))) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles,
       least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM sets
"""

OP8 = f"""
WITH words AS (
  SELECT doc_id, {_words("coalesce(text, '')")} AS ws FROM documents
), windows AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(ws[s + 1:s + 20], ' ') ORDER BY doc_id, s) AS nth
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 19)) AS s FROM words WHERE len(ws) >= 20)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM windows WHERE nth > 1
), each AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS p FROM words
), kept AS (
  SELECT e.doc_id, count(*) AS n_words, count(g.p) AS n_removed,
         string_agg(word, ' ' ORDER BY e.p) FILTER (WHERE g.p IS NULL) AS kept
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY 1
)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept USING (doc_id)
"""

OP9 = f"""
WITH lines AS (
  SELECT doc_id, k, line, list_sort(list_distinct({_words(_LOWER.replace("text", "line"))})) AS s,
         row_number() OVER (ORDER BY doc_id, k) AS pos
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS k
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))
), classes AS (
  SELECT s, len(s) AS n, min(pos) AS first FROM lines WHERE len(s) >= 1 GROUP BY s
), tokens AS (
  SELECT first, n, unnest(s) AS w FROM classes
), ranked AS (
  SELECT first, n, w, row_number() OVER (PARTITION BY first ORDER BY uses, w) AS nth
  FROM (SELECT *, count(*) OVER (PARTITION BY w) AS uses FROM tokens)
), prefixes AS (
  SELECT * FROM ranked WHERE nth <= n - (8 * n + 9) // 10 + 1
), pairs AS (
  SELECT DISTINCT a.first AS x, b.first AS y FROM prefixes a JOIN prefixes b
  ON a.w = b.w AND a.first < b.first AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
), near AS (
  SELECT DISTINCT y FROM (
    SELECT y, a.n AS n, b.n AS m, len(list_intersect(a.s, b.s)) AS c
    FROM pairs JOIN classes a ON a.first = x JOIN classes b ON b.first = y)
  WHERE 10 * c >= 8 * (n + m - c)
), judged AS (
  SELECT doc_id, k, line, (c.first IS NOT NULL AND (pos <> c.first OR near.y IS NOT NULL)) AS gone
  FROM lines l LEFT JOIN classes c ON l.s = c.s LEFT JOIN near ON near.y = c.first
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(k::VARCHAR, ',' ORDER BY k) FILTER (WHERE gone) AS removed_lines,
         string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone) AS kept
  FROM judged GROUP BY 1
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_lines, '') AS removed_lines,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""


def _floor_mean(total: str, n: str) -> str:
    return f"(({total}) - ((({total}) % {n}) + {n}) % {n}) // {n}"


_INTEGERS = """list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"""
_GOOD = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _lloyd(rounds: int) -> str:
    """Rounds r of assignments a{r} and centres c{r}, from points (id, p, v) and centres c0 (p, k, w)."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT id, p, v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT id, t.p, v, k, CAST(list_inner_product(v, v) + list_inner_product(w, w) - 2 * list_inner_product(v, w) AS BIGINT) AS d
    FROM points t JOIN c{r} c ON t.p = c.p
  ) GROUP BY id, p, v
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.k, coalesce(m.w, c.w) AS w FROM c{r} c LEFT JOIN (
    SELECT p, k, list(CAST(x AS DOUBLE) ORDER BY pos) AS w FROM (
      SELECT p, k, pos, {_floor_mean("CAST(sum(CAST(x AS BIGINT)) AS BIGINT)", "count(*)")} AS x
      FROM (SELECT p, k, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{r}) GROUP BY p, k, pos
    ) GROUP BY p, k
  ) m ON c.p = m.p AND c.k = m.k
)""")
    return ",\n".join(steps)


def _printed(w: str) -> str:
    return f"array_to_string(list_transform({w}, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')"


OP11 = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, {_INTEGERS.format(scale=1024)} AS v,
         row_number() OVER (ORDER BY vec_id) - 1 AS nth
  FROM embeddings WHERE {_GOOD}
), points AS MATERIALIZED (
  SELECT vec_id AS id, p, nth, CAST(v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS DOUBLE[]) AS v
  FROM kept, (SELECT unnest(range(0, 4)) AS p)
), c0 AS MATERIALIZED (
  SELECT p, nth AS k, v AS w FROM points WHERE nth < 256
), {_lloyd(4)}, books AS (
  SELECT sha256(string_agg({_printed("w")}, ',' ORDER BY p, k)) AS codebooks_sha256 FROM c4
), coded AS (
  SELECT id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept ON id = vec_id, books
"""

OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, CAST({_INTEGERS.format(scale=64)} AS DOUBLE[]) AS v
  FROM embeddings WHERE {_GOOD} AND len(embedding) = 64
), points AS MATERIALIZED (
  SELECT vec_id AS id, 0 AS p, v FROM kept
), c0 AS MATERIALIZED (
  SELECT 0 AS p, k, v AS w FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k FROM kept) WHERE k < 16
), {_lloyd(3)}
SELECT id AS vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256({_printed("w")}) AS centroid_sha256
FROM a3 a JOIN c3 c ON a.k = c.k
"""

ORACLE_SQL = {
    "op6_ngram_join": OP6,
    "op8_substring_dedup": OP8,
    "op9_line_dedup": OP9,
    "op10_exact_dedup": OP10,
    "op11_vector_codes": OP11,
    "op12_centroids": OP12,
}
