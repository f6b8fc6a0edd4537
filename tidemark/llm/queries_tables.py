"""Queries of the operators on licenses, conversations and embeddings, with their SQL."""

from __future__ import annotations

from . import licenses, prefix_trie, whitening
from .queries_basic import documents


def op13_embedding_whitening(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whitening.whiten(rows)


def op11_license_scan(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _phrase_sql(phrase: str) -> str:
    parts = phrase.split()
    return "list_filter(range(len(w)), lambda i: " + " AND ".join(f"coalesce(w[i + {k + 1}] = '{p}', false)" for k, p in enumerate(parts)) + ")"


_STEP = max(32, *(len(text.split()) for _, text in licenses.NOTICES))
_NOTICE_ROWS = ", ".join(f"('{label}', {_sql_list(sorted(set(text.split())))})" for label, text in licenses.NOTICES)

OP11_SQL = rf"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS uid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.LICENSE_WORD}') AS w FROM documents
), notices(label, tokens) AS (VALUES {_NOTICE_ROWS}
), blocks AS (
  SELECT uid, list_distinct(w[b * {_STEP} + 1 : (b + 2) * {_STEP}]) AS block FROM (SELECT uid, w, unnest(range((len(w) + {_STEP - 1}) // {_STEP})) AS b FROM base)
), shared AS (
  SELECT uid, label, len(tokens) AS n, len(list_intersect(tokens, block)) AS k FROM blocks, notices
), hits AS (
  SELECT uid, list(label) AS more, max(k::DOUBLE / n) AS share FROM shared WHERE 10 * k >= 8 * n GROUP BY uid
), phrases AS (
  SELECT *, flatten(places) AS found, list_filter([{", ".join(f"CASE WHEN len(places[{k}]) > 0 THEN '{label}' END" for k, label in enumerate(licenses.PHRASES.values(), 1))}], lambda x: x IS NOT NULL) AS names
  FROM (SELECT doc_id, uid, w, [{", ".join(map(_phrase_sql, licenses.PHRASES))}] AS places FROM base)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(found) AS BIGINT) AS n_base, CAST(list_min(found) AS BIGINT) AS first_word, CAST(list_max(found) AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(names)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(names, coalesce(more, [])))), ','), '') AS labels,
       CASE WHEN len(found) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM phrases LEFT JOIN hits USING (uid)
"""

#: crc32 by its bits, then every prefix of every rebuilt conversation as a key; subtrees are the keys that begin with a node's.
OP12_SQL = """
WITH conv AS (
  SELECT conv_id AS c, list({'k': md5(coalesce(role, '') || chr(0) || coalesce(text, '')) || '/', 'b': octet_length(encode(coalesce(text, '')))} ORDER BY turn NULLS FIRST, role, text) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT c, t, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) % 9 AS h FROM conv
), rebuilt AS (
  SELECT a.c, list_concat(CASE WHEN b.c IS NULL THEN [] ELSE list_slice(b.t, 1, a.h) END, list_slice(a.t, a.h + 1, len(a.t))) AS p FROM hashed a LEFT JOIN hashed b ON b.c = a.c - a.c % 5
), steps AS (
  SELECT c, d, coalesce(array_to_string(list_transform(list_slice(p, 1, d), lambda x: x.k), ''), '') AS key, coalesce(array_to_string(list_transform(list_slice(p, 1, d - 1), lambda x: x.k), ''), '') AS up, len(p) = d AS ends, CASE WHEN d > 0 THEN p[d].b ELSE 0 END AS b
  FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, key, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(b) AS own, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM steps GROUP BY d, key
), kids AS (SELECT d - 1 AS d, up AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (d, key)
), sums AS (SELECT x.d, x.key, count(*) FILTER (y.n_children = 0) AS n_leaves, sum(y.own) AS saved FROM full_nodes x JOIN full_nodes y ON starts_with(y.key, x.key) GROUP BY x.d, x.key
)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM full_nodes v JOIN sums USING (d, key) LEFT JOIN nodes u ON u.d = v.d - 1 AND u.key = v.up
"""

QUERIES = {f.__name__: f for f in (op11_license_scan, op12_prefix_trie, op13_embedding_whitening)}
SQL = {"op11_license_scan": OP11_SQL, "op12_prefix_trie": OP12_SQL}
