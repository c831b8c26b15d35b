"""Times the registered queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs per
query (the median counts, after one warm-up) and ``BENCH_QUERIES`` an optional list of name
prefixes. Every query runs to the end into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.plans import REGISTRY
from tidemark.session import build_session

# One or more of each family: scan and aggregate, star join, window, time intelligence, change
# data, history, checks, text, vectors, layout and streaming.
HEADLINE = [
    "executive_kpi", "p02_route_table", "p25_banding", "j01_star_join", "j02_same_dimension_twice", "a01_group_by", "a09_grouped_r_squared",
    "a12_histogram", "a15_margin_set", "a21_matrix", "a25_spread_over_days", "a30_reconciliation", "w01_latest_by_key", "w03_global_row_number",
    "w06_first_last_value", "w09_start_complete_pairs", "t09_same_period_last_year", "t12_metric_table", "k03_top_members", "k09_sequence_ids",
    "u05_unpivot", "m01_apply_changes", "m04_affected_key_recompute", "m07_snapshot_timestamp", "m14_first_wins_insert", "q10_severity_summary",
    "q12_personal_data_scan", "x01_dictionary_replace", "x06_prefixed_tokens", "x08_stitch_records", "v02_top_k", "v04_batch_retrieval",
    "g06_layout_overlap", "s01_land_json", "s19_chunk_items", "r03_streaming_merge", "r04_stream_throughput",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    prefixes = os.environ.get("BENCH_QUERIES", "").split()
    names = [n for n in REGISTRY if any(n.startswith(p) for p in prefixes)] if prefixes else HEADLINE
    if prefixes == ["all"]:
        names = list(REGISTRY)
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "sum of median query seconds", "value": total, "unit": "sec", "queries": seconds, "sf": directory.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
