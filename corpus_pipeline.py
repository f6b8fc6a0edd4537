"""Corpus pipeline: quality classifier, line dedup, near-duplicate join, mixing, packing.

Each stage works on all rows that the one before kept and, but for the last,
returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import cotraining, jaccard, line_dedup, mixing, packing
from tidemark.llm.common import cut


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = cotraining.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.score(docs, model).filter("cotrain_kept").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs).select(docs.columns)
    return out.selectExpr(*("CAST(char_length(text) AS BIGINT) AS n_chars" if c == "n_chars" else c for c in docs.columns))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the smallest doc_id stays."""
    return jaccard.keep_one(docs, jaccard.Likeness(k=5, num=8, den=10))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a document stands as often as it is taken."""
    return mixing.repeat_copies(mixing.mix(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The stages fit a classifier and encode tokens, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
