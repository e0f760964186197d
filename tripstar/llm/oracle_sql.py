"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def alphanumeric_words(text: str) -> str:
    return rf"regexp_extract_all({folded(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def spaced_words(text: str) -> str:
    return rf"regexp_extract_all({folded(text)}, '[^\x20\x09-\x0D]+')"


OP2 = f"""
WITH d AS (SELECT doc_id, {alphanumeric_words("text")} AS w FROM documents),
b AS (SELECT item_id, {alphanumeric_words("text")} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS t
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM sized)),
lengths AS (SELECT DISTINCT n FROM sized),
doc_windows AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, k, n, item_id FROM doc_windows JOIN item_windows USING (n, t)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""


OP5 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS n, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, {folded("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT k.*, coalesce(k.doc_id > keeper, false) AS gone FROM keyed k LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _count(tokenizer: str, words: str) -> str:
    return f"SELECT source, lang, '{tokenizer}' AS tokenizer, len({words}) AS n FROM left_over"


OP8 = rf"""
WITH left_over AS (
  SELECT source, lang, regexp_replace(text, '(This work is licensed|Licensed under)[^\n]*', '', 'g') AS text
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)
  WHERE text IS NULL OR doc_id = first)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM ({_count("words-1", spaced_words("text"))} UNION ALL {_count("words-2", alphanumeric_words("text"))})
GROUP BY source, lang, tokenizer
"""


def integer_vectors(dimensions: int | None = None) -> str:
    """Rows of embeddings that take part, as whole numbers; n tells repeated rows apart."""
    proper = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"
    sized = f" AND len(embedding) = {dimensions}" if dimensions else ""
    ints = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"
    return f"SELECT row_number() OVER () AS n, vec_id, {ints} AS v FROM embeddings WHERE {proper}{sized}"


OP12 = f"""
WITH points AS MATERIALIZED ({integer_vectors()}),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(q.v, p.v) AS BIGINT) AS score
  FROM points q JOIN points p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def kmeans(k: int = 40, rounds: int = 5, salt: int = 2, dimensions: int = 64) -> str:
    parts = [
        f"points AS MATERIALIZED ({integer_vectors(dimensions)})",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INT) AS cluster, v AS c
  FROM (SELECT sha256('{salt}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM points ORDER BY h, v LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT n, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'k': cluster}}) AS best
  FROM (SELECT n, vec_id, v, cluster, CAST(list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c) AS BIGINT) AS d FROM points, c{i})
  GROUP BY n)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list(floor((s - ((s % rows_in) + rows_in) % rows_in) / rows_in) ORDER BY place) AS m
    FROM (SELECT best.k AS cluster, place, CAST(sum(v[place]) AS BIGINT) AS s, count(*) AS rows_in
          FROM a{i}, (SELECT unnest(range(1, {dimensions + 1})) AS place) GROUP BY 1, 2)
    GROUP BY cluster) USING (cluster))""")
    digest = "sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','))"
    return f"""WITH {", ".join(parts)}
SELECT vec_id, best.k AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, {digest} AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON cluster = best.k"""


_CRC_STEP = "if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)"  # 3988292384: the reflected polynomial of CRC-32


def resampling(percent: int = 25, salt: int = 7, least_words: int = 20, buckets: int = 10_000) -> str:
    """CRC-32 is worked out byte by byte, once for each distinct feature, with a table of 256 entries."""
    eight = "SELECT i, CAST(i AS BIGINT) AS c FROM range(256) AS t(i)"
    for _ in range(8):
        eight = f"SELECT i, {_CRC_STEP} AS c FROM ({eight})"
    byte = "CAST(('0x' || substr(h, 2 * k + 1, 2)) AS BIGINT)"
    return f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM ({eight})),
texts AS (SELECT 's' AS side, row_number() OVER () AS n, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
worded AS MATERIALIZED (SELECT side, n, doc_id, {alphanumeric_words("text")} AS w FROM texts),
runs AS (SELECT side, n, unnest(list_concat(w, list_transform(range(1, greatest(1, len(w))), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM worded),
counted AS MATERIALIZED (SELECT side, n, f, count(*) AS m FROM runs GROUP BY side, n, f),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
steps AS (
  SELECT f, h, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM hexed
  UNION ALL SELECT f, h, k + 1, xor(c >> 8, t[1 + (xor(c, {byte}) & 255)]) FROM steps, crc WHERE 2 * k < length(h)),
bucket AS MATERIALIZED (SELECT f, xor(c, 4294967295) % {buckets} AS b FROM steps WHERE 2 * k = length(h)),
totals AS (SELECT b, coalesce(sum(m) FILTER (side = 's'), 0) AS s, coalesce(sum(m) FILTER (side = 't'), 0) AS t FROM counted JOIN bucket USING (f) GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + {buckets}) AS DOUBLE) / CAST((s + 1) * (sum(t) OVER () + {buckets}) AS DOUBLE))) AS BIGINT) AS g FROM totals),
weights AS (SELECT n, sum(m * g) AS total, sum(m) AS n_features FROM counted JOIN bucket USING (f) JOIN gain USING (b) WHERE side = 's' GROUP BY n),
scored AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    CAST(coalesce((total - ((total % n_features) + n_features) % n_features) / n_features, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('{salt}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM worded LEFT JOIN weights USING (n) WHERE side = 's'),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {least_words} ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= {least_words}) OVER () AS fit FROM noisy)
SELECT doc_id, n_features, weight, score, if(n_words >= {least_words} AND place <= {percent} * fit // 100, place, NULL) AS rank FROM placed
"""


def all_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2, "op5_line_dedup": OP5, "op8_token_counts": OP8, "op11_resampling": resampling(), "op12_exact_search": OP12, "op13_kmeans": kmeans()}
