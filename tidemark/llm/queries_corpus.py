"""Queries of the operators on whole corpora: classifier, top-k, set join."""

from __future__ import annotations

from . import cotraining, jaccard, topk
from .queries_basic import documents


def op1_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = cotraining.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    fields = docs.select("doc_id", "text", "source", "lang", "n_chars")
    return cotraining.score(fields, model).selectExpr("doc_id", "cotrain_score AS score", "cotrain_kept AS kept", "cotrain_state AS state")


def op2_top_k(spark, sf_dir):
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_groups(documents(spark, sf_dir))


OP2_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w
), sized AS (SELECT doc_id, s, len(s) AS n, hash(list_sort(s)) AS h FROM g),
e AS (SELECT h, n, min(doc_id) AS rep, any_value(s) AS s FROM sized WHERE n > 0 GROUP BY h, n),
sh AS (SELECT rep, n, unnest(s) AS x FROM e),
common AS (SELECT a.rep AS a, b.rep AS b, a.n + b.n AS n, count(*) AS i FROM sh a JOIN sh b ON a.x = b.x AND a.rep < b.rep GROUP BY ALL),
pairs AS (
  SELECT a, b FROM common WHERE 100 * i >= 90 * (n - i)
), sides AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT rep AS id, rep AS low FROM e UNION SELECT sides.b, reach.low FROM reach JOIN sides ON reach.id = sides.a WHERE reach.low < sides.b)
SELECT sized.doc_id, CAST(sized.n AS BIGINT) AS n_shingles, coalesce(c.low, sized.doc_id) AS component_id
FROM sized LEFT JOIN e USING (h, n) LEFT JOIN (SELECT id, min(low) AS low FROM reach GROUP BY id) c ON c.id = e.rep AND sized.n > 0
"""

QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_top_k, op6_jaccard_join)}
SQL = {"op2_top_k": OP2_SQL, "op6_jaccard_join": OP6_SQL}
