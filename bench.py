"""Time the headline queries on one scale folder and print one JSON line.

BENCH_SF_DIR names the folder, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataloom.plans import catalogue  # noqa: E402, F401
from strataloom.plans.registry import CATALOGUE  # noqa: E402
from strataloom.session import local_session  # noqa: E402

HEADLINES = (
    # the store comparison: scan, top ten, group counts, join
    "avg_likes",
    "top10_downloads",
    "modification_stats",
    "join_modification_stats",
    "ods_append_nullable",
    # feed to raw layer
    "classify_tags",
    "explode_reactions",
    "extract_page_ids",
    # detail layer
    "scd2_versions",
    "scd2_models",
    "scd2_parties",
    "upsert_model_metrics",
    "point_in_time_join",
    "bridge_papers_keywords",
    # marts and audits
    "mart_unique_top7d",
    "mart_tag_pie",
    "mart_owners_treemap",
    "mart_trending_line",
    "mart_leaderboard_30d",
    "dq_coverage",
    "dq_constraints",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    CATALOGUE[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), memory="16g")
    chosen = [n for n in sys.argv[1:]] or HEADLINES
    # The first run of a query compiles its code; the servers of the baseline were
    # warm, so the second run is the measure and the first is listed beside it.
    first = {name: round(run_once(spark, name, sf_dir), 3) for name in chosen}
    seconds = {name: round(run_once(spark, name, sf_dir), 3) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": float(os.path.basename(sf_dir).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
