"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is run to completion with the ``noop`` sink (full computation,
nothing collected).  ``pages_build`` is the one-off write of the shaped page
table that the page-reading queries scan afterwards; it is timed separately.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_labels",
    "group_labels",
    "build_features",
    "lexicon_sentiment",
    "posts_with_authors",
    "metric_regressions",
    "ols_coef",
    "staged_fit",
    "build_events",
    "clean_quotes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tidewater.plans import views
    from tidewater.plans.catalog import QUERIES
    from tidewater.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app="tidewater-bench")
    timings: dict[str, float] = {}
    t0 = time.time()
    views.stored_pages(spark, sf_dir)
    timings["pages_build"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
