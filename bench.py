"""Runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each query is run twice and written to a sink that keeps every column; the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.plans.catalog import QUERIES  # noqa: E402
from changeflow.session import build_session  # noqa: E402

HEADLINE = (
    "current_state", "current_state_snapshot_25000000", "as_of_scn_25000000", "history_scd", "dedup_replay",
    "complete_after", "split_key_change", "build_envelope", "typed_projection", "v10_timestamp_literals",
    "assemble_lobs", "reselect_lobs_on", "incremental_snapshot_5000", "keyset_chunks", "tx_order", "tx_order_hot",
    "tx_complete", "scn_to_time", "scn_to_time_merged", "column_changes", "fold_schema", "capture_metrics",
    "current_state_stream", "order_guard_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    # the first query of a session also pays for starting it
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
