"""Query of the sparse suffix array. Sorting suffixes is not put in SQL; tests hold it against brute force."""

from __future__ import annotations

from . import suffixes
from .queries_basic import documents


def op10_suffix_dedup(spark, sf_dir):
    return suffixes.repeated_passages(documents(spark, sf_dir))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
SQL: dict[str, str] = {}
