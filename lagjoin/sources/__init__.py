"""Sources and sinks."""

from lagjoin.sources.ingest import (create_parquet_tables, ingest_facts, ingest_observations,
                                    read_csv, sample_rows, write_partitioned)
from lagjoin.sources.parquet import (align_pair, common_range, read_joined, read_pair,
                                     read_parquet)
from lagjoin.sources.sinks import (schema_frame, store_results, write_metrics_csv,
                                   write_report_csv, write_schema_json)

__all__ = ["align_pair", "common_range", "create_parquet_tables", "ingest_facts",
           "ingest_observations", "read_csv", "read_joined", "read_pair", "read_parquet",
           "sample_rows", "schema_frame", "store_results", "write_metrics_csv",
           "write_partitioned", "write_report_csv", "write_schema_json"]
