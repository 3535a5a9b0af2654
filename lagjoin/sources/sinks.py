"""Result and report sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from lagjoin.operators.ml import metrics_frame
from lagjoin.sources.ingest import write_partitioned

# Default partitioning of the joined result tables.
RESULT_PARTITIONS = ("FT_Year", "FT_FL_DATE")


def store_results(df: DataFrame, path: str, partitions: Sequence[str] = RESULT_PARTITIONS,
                  mode: str = "overwrite") -> None:
    """Partitioned parquet sink for joined results (``mode`` as for
    :func:`write_partitioned`)."""
    write_partitioned(df, path, partitions, mode)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Single-file CSV with header (overwrite).  Only the writer is a
    single task: the report itself is computed in parallel, once."""
    df.repartition(1).write.mode("overwrite").option("header", "true").csv(path)


def schema_frame(df: DataFrame) -> DataFrame:
    """The schema as rows (position, name, type, nullable)."""
    schema = StructType([StructField("position", IntegerType(), False),
                         StructField("name", StringType(), False),
                         StructField("type", StringType(), False),
                         StructField("nullable", BooleanType(), False)])
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, schema)


def write_schema_json(df: DataFrame, path: str) -> None:
    """The schema as one JSON text line (Spark's own schema JSON)."""
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def write_metrics_csv(spark: SparkSession, metrics: dict[str, float], path: str) -> None:
    """Metric map -> ``<path>/metrics.csv``."""
    write_report_csv(metrics_frame(spark, metrics), path.rstrip("/") + "/metrics.csv")
