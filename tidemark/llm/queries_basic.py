"""Queries of the operators on single documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, line_dedup, mixing, packing, quality_rules, token_files


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op3_quality_rules(spark, sf_dir):
    return quality_rules.judge(documents(spark, sf_dir)).drop("rejected_by")


def op4_token_files(spark, sf_dir):
    return token_files.encode_and_digest(documents(spark, sf_dir))


def op5_mixing(spark, sf_dir):
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", *(F.col(f"mix_{c}").alias(c) for c in ("size", "source_size", "target", "taken")))


def op7_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit(docs.filter(F.coalesce(~held_out, F.lit(True))))
    out = language_id.predict(docs, model)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op8_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir)).drop("class")


def op9_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


WHITE_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP9_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos, len(ls) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {WHITE_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), held AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, (keeper IS NOT NULL AND doc_id <> keeper) AS gone FROM keyed LEFT JOIN held USING (k)
)
SELECT doc_id, CAST(any_value(n_lines) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP3_SQL = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(w[1:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c FROM base WHERE len(w) >= 3)
), covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM windows, range(3) AS r(d) WHERE n >= 2 GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup, count(*) AS n_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM base) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), figures AS (
  SELECT doc_id, w, t, len(w) AS n_words, CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) AS chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
         coalesce(n_dup, 0) AS n_dup, coalesce(n_lines, 0) AS n_lines, coalesce(covered.n, 0) AS n_rep,
         len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) AS n_letter, coalesce(list_sum(list_transform(range(2, len(w) + 1), lambda i: CAST(w[i] = w[i - 1] AS INTEGER))), 0) AS n_stutter
  FROM base LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup AS BIGINT) AS n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words,
       (n_words < 50 OR 100 * n_rep > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_rep > 50 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup > 3 * n_lines
            OR chars < 2 * n_words OR chars > 12 * n_words OR 10 * n_bangs > 3 * n_words OR 10 * n_letter < 8 * n_words
            OR 5 * n_stutter > n_words) AS kept
FROM figures
"""

OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS k FROM documents
), c AS (SELECT *, CASE WHEN size < 50 THEN 1 ELSE 2 END AS class FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM c GROUP BY source),
s1 AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM s0),
s2 AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
                 / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
       FROM s1 WINDOW w AS (ORDER BY cap::DOUBLE / weight::DOUBLE, source NULLS LAST)),
s3 AS (SELECT (SELECT arg_min(level, (cap::DOUBLE / weight::DOUBLE, source IS NULL, source)) FROM s2 WHERE level <= cap::DOUBLE / weight::DOUBLE) AS lv),
s AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(lv * weight, cap::DOUBLE)) AS target FROM s1, s3),
g0 AS (SELECT source, class, sum(size)::BIGINT AS class_size FROM c GROUP BY ALL HAVING sum(size) > 0),
g1 AS (SELECT g0.*, source_size, target, class * class_size AS weight, 3 * class_size AS cap FROM g0 JOIN s ON g0.source IS NOT DISTINCT FROM s.source),
g2 AS (SELECT *, (target - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                 / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
       FROM g1 WINDOW w AS (PARTITION BY source ORDER BY cap::DOUBLE / weight::DOUBLE, class)),
g3 AS (SELECT source, arg_min(level, (cap::DOUBLE / weight::DOUBLE, class)) AS lv FROM g2 WHERE level <= cap::DOUBLE / weight::DOUBLE GROUP BY source),
g4 AS (SELECT g1.*, least(cap::DOUBLE, coalesce(lv * weight, cap::DOUBLE)) / class_size AS each FROM g1 LEFT JOIN g3 ON g1.source IS NOT DISTINCT FROM g3.source),
g5 AS (SELECT *, floor(each)::BIGINT AS whole, each - floor(each) AS p FROM g4),
g AS (SELECT *, target - (sum(whole * class_size) OVER (PARTITION BY source))::BIGINT AS rest FROM g5),
r0 AS (SELECT c.*, p, rest, ((('0x' || substr(k, 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
       FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source AND c.class = g.class WHERE p > 0),
r1 AS (SELECT *, (u / (1 - u)) / (p / (1 - p)) AS q FROM r0),
r2 AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY q, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM r1),
picked AS (SELECT doc_id, k FROM r2 WHERE 2 * before + size <= 2 * rest)
SELECT c.doc_id, c.size, s.source_size, s.target,
       CAST((coalesce(g.whole, 0) + CASE WHEN picked.k IS NOT NULL THEN 1 ELSE 0 END) * c.size AS BIGINT) AS taken
FROM c JOIN s ON c.source IS NOT DISTINCT FROM s.source
LEFT JOIN g ON c.source IS NOT DISTINCT FROM g.source AND c.class = g.class
LEFT JOIN picked ON picked.k = c.k AND picked.doc_id IS NOT DISTINCT FROM c.doc_id
"""

QUERIES = {f.__name__: f for f in (op3_quality_rules, op4_token_files, op5_mixing, op7_language_id, op8_packing, op9_line_dedup)}
SQL = {"op3_quality_rules": OP3_SQL, "op5_mixing": OP5_SQL, "op9_line_dedup": OP9_SQL}
