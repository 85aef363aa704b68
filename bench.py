"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query is run to the end through the no-op sink: once to warm up, then twice; the better time counts.
Stored inputs (archives, feature tables) are written during the warm-up, as a nightly job would.
"""

from __future__ import annotations

import json
import os
import time

from tickloom.plans import datasets
from tickloom.plans.catalog import QUERIES
from tickloom.session import build_session

HEADLINE = (
    "trade_features", "trade_features_lineitem", "book_snapshots", "book_features_deep", "window_features",
    "extended_block", "extended_features", "parse_trades", "parse_depths", "parse_failures", "distinct_events",
    "ordered_event_list", "count_batches", "forward_fill", "frame_labels", "differenced_frames",
    "multi_resolution_frames", "message_books", "step_returns", "run_summary",
)
# Jobs that write: they run anew each time, on another copy of their output.
JOBS = ("archive_features", "written_partitions", "streamed_distinct_events", "streamed_window_features")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join((*HEADLINE, *JOBS))).split(",")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        if name in JOBS:
            datasets.forget(spark, sf_dir, keep=("archive", "files"))
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(min(run(name), run(name)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
