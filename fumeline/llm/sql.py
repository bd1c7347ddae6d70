"""DuckDB SQL for the queries that SQL can express.

Toxicity, quality and language-model scores come from trained models, the mix from
random draws, added secret spans from a test battery, tokens from tokenizers, neighbours from a search that
may miss some, and fingerprints from a hash that DuckDB lacks; the tests compare those with brute force.
"""

_WORDS = r"'[\x20\x09-\x0D]+'"

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM v
  UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id,
       coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN roots ON node = vec_id LEFT JOIN counts ON a = vec_id
"""

OP5 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d)
), first AS (SELECT s, min({'d': doc_id, 'i': i}) AS f FROM w GROUP BY s HAVING count(*) > 1
), gone AS (SELECT doc_id, i FROM w JOIN first USING (s) WHERE doc_id <> f.d OR i <> f.i
), steps AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM gone
), runs AS (
  SELECT doc_id, i, sum(CASE WHEN step <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps
), spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run
), cuts AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans
), parts AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS tail,
         string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS head
  FROM cuts JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN parts USING (doc_id)
"""

OP6 = f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), {_WORDS}), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM win SEMI JOIN again USING (s)
), kept AS (
  SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (doc_id, i)
), texts AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM kept GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN texts USING (doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _cut(table: str, key: str) -> str:
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
            rf"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}")


OP10 = f"""
WITH b AS ({_cut("benchmark", "item_id")}
), d AS ({_cut("documents", "doc_id")}
), items AS (
  SELECT DISTINCT item_id::VARCHAR AS item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM items
), places AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)
), found AS (SELECT doc_id, i, k, item FROM places JOIN items USING (k, s)
), hits AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS t
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

# The check sum is spelled out, as DuckDB has no function for it.
OP11 = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
         len(list_filter(string_split_regex(coalesce(text, ''), {_WORDS}), lambda x: x <> ''))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc
), whole AS (
  SELECT c.conv_id, 0 AS own, place, m, words FROM convs c JOIN turns t ON t.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, 1, place, m, words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h
), paths AS (
  SELECT conv_id, row_number() OVER o AS depth, list(m) OVER o AS key, words FROM whole
  WINDOW o AS (PARTITION BY conv_id ORDER BY own, place ROWS UNBOUNDED PRECEDING)
), steps AS (
  SELECT conv_id, depth, key, words FROM paths UNION ALL SELECT conv_id, 0, []::VARCHAR[], 0 FROM convs
), lengths AS (SELECT conv_id, max(depth) AS n FROM steps GROUP BY conv_id
), nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM steps JOIN lengths USING (conv_id) GROUP BY depth, key
), children AS (SELECT key[:depth - 1] AS key, count(*) AS k FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT key[:d] AS key, sum((k IS NULL)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM (SELECT key, k, n_convs, words, unnest(range(0, depth + 1)) AS d FROM nodes LEFT JOIN children USING (key)) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k, 0) AS n_children, n_leaves,
       saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (key) LEFT JOIN children USING (key)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[:n.depth - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_itq": OP2, "op5_suffixes": OP5, "op6_anchors": OP6, "op10_decontaminate": OP10, "op11_trie": OP11}
