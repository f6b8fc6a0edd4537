"""Cursor-paginated REST listings as a Spark data source.

``fetch(url)`` returns (status, headers, body); it is a parameter, so tests and
offline runs give their own. Each of the ``urls`` is one partition: listings
are read on the executors, and a lost task starts its listing again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

Fetch = Callable[[str], tuple[int, dict, bytes]]

#: Statuses that ask for another try.
RETRIED = (429, 503)


def http_fetch(url: str) -> tuple[int, dict, bytes]:
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(url, timeout=60) as answer:
            return answer.status, dict(answer.headers), answer.read()
    except urllib.error.HTTPError as error:
        return error.code, dict(error.headers), error.read()


def get_json(url: str, fetch: Fetch, tries: int = 5, wait: float = 1.0, sleep=time.sleep):
    """The JSON at ``url``; 429 and 503 are tried again after Retry-After or a doubling wait."""
    for i in range(tries):
        status, headers, body = fetch(url)
        if status == 200:
            return json.loads(body)
        if status not in RETRIED:
            break
        if i + 1 < tries:
            after = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
            sleep(float(after) if str(after).isdigit() else wait * 2**i)
    raise RuntimeError(f"status {status} from {url}")


def pages(url: str, fetch: Fetch, items: str, following: str = "nextPage", **retry) -> Iterator[dict]:
    """Items of all pages from ``url`` on; a page that comes round again raises RuntimeError."""
    seen = set()
    while url:
        if url in seen:
            raise RuntimeError(f"the listing comes back to {url}")
        seen.add(url)
        page = get_json(url, fetch, **retry)
        yield from page.get(items) or []
        url = page.get(following)


def listing(spark: SparkSession, urls: list[str], schema: str, items: str, fetch: Fetch = http_fetch, following: str = "nextPage") -> DataFrame:
    """One row for each item of the listings at ``urls``: url, item (JSON) parsed to ``schema``."""
    from pyspark.sql import functions as F

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for url in pdf["url"]:
                block: list[str] = []
                for item in pages(url, fetch, items, following):
                    block.append(json.dumps(item))
                    if len(block) == 1000:
                        yield pd.DataFrame({"url": url, "item": block})
                        block = []
                if block:
                    yield pd.DataFrame({"url": url, "item": block})

    start = spark.createDataFrame([(u,) for u in urls], "url string").repartition(max(1, len(urls)), "url")
    rows = start.mapInPandas(run, "url string, item string")
    return rows.select("url", F.from_json("item", schema).alias("item")).select("url", "item.*")
