"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and
cores. Every query is run to its last row into the noop sink, ``BENCH_RUNS`` (default 1) times; the
best run counts. One untimed run comes first, to start the JVM's compilers.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medallion.catalog import all_queries  # noqa: E402
from medallion.session import build_session  # noqa: E402

HEADLINE = [
    "page_flatten", "flagged_summary", "dlq_review", "page_reject",
    "latest_version", "latest_in_batch", "content_hash", "content_versions", "insert_absent",
    "upsert_if_distinct", "upsert_newer_wins", "scd1_merge", "scd2_merge", "scd2_three_batches",
    "change_feed", "reviews_scd1", "reviews_scd2", "players_scd2", "fk_orphans", "cascade_delete", "run_ledger", "start_cursor",
    "backfill_state", "dq_unique", "dq_cross_table", "dq_reactions", "suite_reviews_scd1",
    "stream_bronze", "clean_latest", "written_reviews_scd1",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = all_queries(), {}
    registered["flagged_summary"].build(spark, sf_dir).write.format("noop").mode(
        "overwrite").save()
    for name in only:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            started = time.perf_counter()
            rows = registered[name].build(spark, sf_dir)
            rows.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
