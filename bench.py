"""Wall-clock seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is warmed up once; its value is the median of $BENCH_RUNS runs
(streams, which write files and start a query, are run once after the warm-up).
Without arguments the headline queries are timed; name others on the command
line, or "all".
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import all_queries  # noqa: E402
from pulsetide.session import build_session  # noqa: E402

HEADLINE = [
    "clean_events",
    "dedupe_events",
    "window_vitals_5m",
    "alert_episodes",
    "ward_snapshot",
    "dead_letters",
    "quality_counts",
    "lab_normalized",
    "lab_file_verdicts",
    "lab_summary",
    "vitals_daily_summary",
    "risk_scores",
    "daily_risk_report",
    "report_backfill",
    "upsert_live",
    "upsert_labs",
    "fk_orphans",
    "events_per_second",
    "stale_gaps",
    "dlq_rate_alarm",
    "archive_partition_read",
    "file_mode_windows",
    "stream_windows",
    "stream_alert_state",
    "dead_letters_whole",
    "upsert_partial",
    "stream_dlq_alarm",
    "control",
]


def run(query, spark, folder) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def control(spark, folder):
    """The same plain Spark aggregation in every round: tells a slower machine from slower code."""
    rows = spark.read.parquet(f"{folder}/lineitem.parquet")
    return rows.groupBy("l_returnflag", "l_linestatus").agg({"l_quantity": "sum", "l_extendedprice": "avg", "l_orderkey": "count"})


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    memory = os.environ.get("BENCH_MEMORY", "8g")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": memory}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {**all_queries(), "control": control}
    names = list(queries) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(queries[name], spark, folder)
        times = [run(queries[name], spark, folder) for _ in range(1 if name.startswith("stream") else runs)]
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total of the median seconds per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "master": f"local[{cpus}]",
                "driver_memory": memory,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
