"""Command line: ``python -m lagjoin <command> ...``.

    ingest  raw fact CSV + observation text -> date-partitioned parquet
    run     parquet pair + station lookup -> reports, prepared tables,
            joined tables (long 'lines' / wide 'cols' / 'both'), metrics

The session comes from spark-submit / the environment; on a cluster
``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lagjoin")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="CSV -> date-partitioned parquet")
    ing.add_argument("--facts", required=True)
    ing.add_argument("--obs", required=True)
    ing.add_argument("--facts-out", required=True)
    ing.add_argument("--obs-out", required=True)
    ing.add_argument("--fraction", type=float, default=None)
    ing.add_argument("--seed", type=int, default=42)
    run = sub.add_parser("run", help="reports, tables, lag join, datasets, model")
    run.add_argument("--facts", required=True, help="fact parquet (from ingest)")
    run.add_argument("--obs", required=True, help="observation parquet (from ingest)")
    run.add_argument("--stations", required=True, help="station lookup CSV")
    run.add_argument("--out", required=True)
    run.add_argument("--mode", choices=("lines", "cols", "both"), default="lines")
    run.add_argument("--obs-cols", default=None, help="comma-separated observation columns")
    run.add_argument("--ds-type", default="DS1")
    run.add_argument("--delayed", type=float, default=15)
    run.add_argument("--on-time", type=float, default=1.0)
    run.add_argument("--trees", type=int, default=20)
    run.add_argument("--depth", type=int, default=5)
    run.add_argument("--folds", type=int, default=None)
    run.add_argument("--fill-missing", type=float, default=None, help="value of missing features (default: an error)")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("lagjoin").getOrCreate()
    if args.cmd == "ingest":
        from lagjoin.sources.ingest import create_parquet_tables
        create_parquet_tables(spark, args.facts, args.obs, args.facts_out, args.obs_out,
                              args.fraction, args.seed)
        return 0
    from lagjoin.plans.workflow import run as run_all
    obs_cols = args.obs_cols.split(",") if args.obs_cols else None
    metrics = run_all(spark, args.facts, args.obs, args.stations, args.out, mode=args.mode,
                      obs_cols=obs_cols, ds_type=args.ds_type, delayed=args.delayed,
                      on_time=args.on_time, num_trees=args.trees, max_depth=args.depth,
                      folds=args.folds, fill_missing=args.fill_missing)
    print(json.dumps(metrics))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
