"""Time the headline queries: one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs whole into Spark's
`noop` sink; its time is the better of two runs, the first of which also warms up the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from patloom.queries import QUERIES
from patloom.session import local_session

HEADLINE = (
    "S7_F1_date_range",
    "K2_S7_date_extract",
    "A1_first_per_text",
    "A2_latest_per_user",
    "A3_mean_by_position",
    "J1_anti",
    "K4_insert_if_absent",
    "K1_weekly_table",
    "T1_T2_normalise",
    "T3_lemmatise",
    "T1_T5_normalised_chunks",
    "T6_A3_embed_and_pool",
    "S6_split",
    "X_bibliography",
    "X_texts",
    "Y_bibliography",
    "Y_texts",
    "S2_S3_nested_archives",
    "S4_flat_archives_streamed",
    "K1_F3_weekly_records",
    "K4_ep_stream",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "16g", **{"spark.sql.shuffle.partitions": cores})
    times = {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
