"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = 3

HEADLINE = (
    "host_links",
    "page_body_text",
    "explode_elements",
    "rule_cascade",
    "job_index_rows",
    "extract_links",
    "extract_websites",
    "extract_salaries",
    "html_format",
    "map_functions",
    "merge_index_detail",
    "line_rollup",
    "field_topk",
    "missing_field_counts",
    "site_validity",
    "parse_time_histogram",
    "latest_run",
    "robots_decide",
    "offsite_filter",
    "clean_url_feed",
    "best_element",
    "description_score",
    "ngram_search",
    "remove_boilerplate",
    "stale_crawl_filter",
    "stale_run_alerts",
    "live_rollup",
)


def main() -> None:
    from gleaner.plans import QUERIES
    from gleaner.session import get_session

    spark = get_session(
        app="bench",
        master=f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": str(CPUS),
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        # The first run pays for compiling the plan and starting Python workers.
        seconds[name] = round(statistics.median(times), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total of the median seconds of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
