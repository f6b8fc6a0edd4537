"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import catalog
from tidemark.session import local_session, ship

HEADLINE = [
    "replay_intervals_merged", "latest_action_asof", "service_exit_candidates", "temporal_name_lookup", "boundary_sweep_counts",
    "rank_replay_ordered", "rank_replay_anchored", "overlap_scores", "integrity_issue_codes", "upsert_fill_null", "source_survivors", "classify_titles",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    took = {}
    for name in HEADLINE:
        run = lambda: catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        run()  # warm-up
        began = time.perf_counter()
        run()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline query seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
