"""Benchmark: headline queries of the catalogue on ``$BENCH_SF_DIR``.

Each query is executed through the ``noop`` sink (the whole plan runs,
nothing is collected to the driver): one warm-up, then the median of
three timed runs. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_RUNS (3),
BENCH_SHUFFLE_PARTITIONS (default: the core count; AQE coalesces further).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlens.plans.catalogue import QUERIES  # noqa: E402
from ledgerlens.session import local_session, stages  # noqa: E402

HEADLINE = [
    "slim_operations", "user_amount_stats", "amount_range_global", "amount_range_user",
    "action_days", "action_hours", "op_type_index", "top3_op_types", "top3_trans_types",
    "daily_sequences", "action_tokens", "user_action_rank", "follow_rates",
    "follow_rates_text", "risk_flags", "merged_features", "tree_accuracy",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    with stages(spark):
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = local_session(cpus, shuffle_partitions=partitions, app="ledgerlens-bench")

    per_query: dict[str, float] = {}
    rows_out: dict[str, int] = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        per_query[name] = round(statistics.median(run_once(spark, name, sf_dir)
                                                  for _ in range(runs)), 3)
        with stages(spark):
            rows_out[name] = QUERIES[name](spark, sf_dir).count()
        print(f"# {name}: {per_query[name]}s rows={rows_out[name]}", file=sys.stderr, flush=True)

    events_rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "rows_out": rows_out,
        "rows_in_events": events_rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cores": cpus,
        "shuffle_partitions": partitions,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
