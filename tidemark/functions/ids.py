"""Content-addressed ids. Each family renders nulls in its own way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def piped_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by '|', a null as the word None."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts)), 256)


def json_id(**parts: Column) -> Column:
    """SHA-256 of a JSON object with sorted keys, nulls kept."""
    body = F.struct(*(parts[k].alias(k) for k in sorted(parts)))
    return F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)


def release_id(prefix: str, *parts: Column, digits: int = 24) -> Column:
    """prefix:first digits of the SHA-256 of the parts joined by '|', a null as nothing."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(joined, 256), 1, digits))
