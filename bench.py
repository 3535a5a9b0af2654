"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely through the ``noop`` sink (the whole plan
runs, nothing is collected).  After one untimed warm-up pass (JVM JIT and
per-query code generation dominate sub-second queries otherwise) every query
runs $BENCH_REPEAT times (default 2) and its fastest run is reported; the
first, cold pass is reported as ``cold_total``.  Prints ONE JSON line.  The query set
mirrors the timed phases of the original workflow: load + align, table
recipes, the lag joins, quality/statistics reports, dataset generation and
model training.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "S9_load_stats",            # read both tables, common range, load statistics
    "Q7_fact_table",            # fact recipe: clean, filter, time zones
    "Q6_obs_table",             # observation recipe: impute, flag-correct, lookup
    "J6_lag_long",              # long lag join (origin + destination)
    "J7_lag_wide",              # wide lag join by frames
    "S12_S11_result_roundtrip", # long join written date-partitioned, reloaded, summarised
    "Q1_missing_report",
    "Q2_flag_report",
    "A1_airport_summary",
    "A2_carrier_performance",
    "A3_delay_breakdown",
    "D4_DS4",
    "D7_D8_balanced_split",     # labelled, exactly balanced, hash-split datasets
    "M6_random_forest",
    "W1_raw_to_long_lag_join",  # raw rows -> both recipes -> keys -> long lag join
]


# the same work here.
PHASES = {
    "read_parquet": ["S9_load_stats"],
    "Create_tables": ["Q7_fact_table", "Q6_obs_table"],
    "Store_parquet_FinalDf": ["J6_lag_long", "J7_lag_wide", "S12_S11_result_roundtrip"],
    "reports": ["Q1_missing_report", "Q2_flag_report", "A1_airport_summary",
                "A2_carrier_performance", "A3_delay_breakdown"],
    "FilteredDataFrames": ["D4_DS4", "D7_D8_balanced_split"],
    "RandomForest": ["M6_random_forest"],
    "end_to_end_raw_to_long_join": ["W1_raw_to_long_lag_join"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from lagjoin.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="lagjoin-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lagjoin-bench-", dir="/tmp")})
    from lagjoin.plans.catalog import queries
    qs = queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    cold = {name: run(name) for name in names}          # warm-up pass, also reported
    times = {name: round(min(run(name) for _ in range(repeat)), 3) for name in names}
    sf = os.path.basename(sf_dir).replace("sf", "")
    phases = {p: round(sum(times[q] for q in qs_ if q in times), 3) for p, qs_ in PHASES.items()}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "cold_total": round(sum(cold.values()), 3), "repeat": repeat,
                      "phases": phases}))
    spark.stop()


if __name__ == "__main__":
    main()
