"""lagjoin: enrich time-stamped fact tables with the recent history of
station observations, profile and repair data quality, and derive labelled
datasets for Spark ML -- all as DataFrame -> DataFrame functions that Spark
plans and distributes.

Sub-packages
------------
functions  column-expression helpers (safe casts, clock parsing, hash buckets)
sources    CSV ingest, partitioned parquet read/write, report sinks
operators  projections, quality reports/repairs, statistics, the lag joins,
           labelled datasets, ML helpers
plans      table recipes and the end-to-end workflow; fixture views and the
           query catalogue used by the correctness checks
streaming  the lag enrichment applied to a streaming fact source
"""

from lagjoin.session import checkpoint_dir, get_spark

__all__ = ["checkpoint_dir", "get_spark"]
__version__ = "0.1.0"
