"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shutterlake.plans.catalog import QUERIES  # noqa: E402
from shutterlake.session import get_session  # noqa: E402

HEADLINE = (
    "stg_photos",
    "tag_metrics",
    "tag_analysis",
    "photographer_metrics",
    "photographer_analysis",
    "daily_stats",
    "daily_top_tags",
    "mart_daily_trends",
    "tag_cooccurrence",
    "tag_pair_rate",
    "cooccurrence_ranks",
    "tag_pairs_positional",
    "stat_deltas",
    "upsert_photos",
    "normalize_photos",
    "photo_detail",
    "overview_stats",
    "search_photos",
    "dedup_latest",
    "data_completeness",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["photo_count"](spark, folder).collect()  # warm the JVM and the file listing
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
