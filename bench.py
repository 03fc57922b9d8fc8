"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    runs per query, the fastest counts (default 2)
BENCH_ALL     1 = every registered query
Results are consumed by Spark's `noop` sink: every row and column is computed, none is kept.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemill.queries import QUERIES  # noqa: E402
from tidemill.session import local_session, release_staged  # noqa: E402

HEADLINE = """
    flow_flagship flow_with_targets
    dedup_any_keys dedup_first dedup_latest dedup_full_row dedup_survivorship
    sort_global sort_desc_topk
    join_inner join_left join_full join_semi join_anti join_theta
    lookup_left_json lookup_left_dataset lookup_multi_key
    mask_hash mask_redact mask_encrypt_roundtrip
    agg_count_sum agg_basic agg_distinct agg_median_mode agg_cube agg_rolling
    merge_union merge_upsert
    dq_engine dq_split_reject quarantine_replay
    src_csv_typed sink_csv_roundtrip sink_partitioned_overwrite sink_merge_partitions
    runs_history stream_window_agg
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = list(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    spark = local_session("bench", cores=cpus, partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["agg_basic"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = float("inf")
        for _ in range(max(runs, 1)):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
            release_staged(spark)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of the fastest runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
