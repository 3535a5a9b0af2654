"""Raw-file ingest (S1 - S6): CSV scans, the ingest transform, sampling and
the date-partitioned parquet sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lagjoin.functions import scalar as S
from lagjoin.session import written

# Partition layout of the ingested tables.
FACT_PARTITIONS = ("Year", "FL_DATE")
OBS_PARTITIONS = ("Year", "Date")
#: Column of a checked scan that holds a malformed line.
REJECTED = "__rejected"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
             sep: str = ",") -> DataFrame:
    """Header CSV scan of a file, a directory or a list of
    paths (``.txt`` observation files included).  Without a schema every
    column is a string -- no inference pass over the data."""
    r = spark.read.option("header", "true").option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path if isinstance(path, str) else list(path))


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                     sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """S1 / S2 with rejected rows: (rows, rejected).  Lines with too few or
    too many fields, or broken quotes, are no rows; ``rejected`` has them as
    they stand (file, line).  ``columns`` names the fields of files without a
    header.  The scan runs once: both frames read what it wrote."""
    names = list(columns) if columns is not None else read_csv(spark, path, sep=sep).columns
    schema = StructType([*(StructField(c, StringType()) for c in names), StructField(REJECTED, StringType())])
    scan = (spark.read.schema(schema).option("header", "true" if columns is None else "false").option("sep", sep)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
            .option("enforceSchema", "true").csv(path if isinstance(path, str) else list(path)))
    kept = written(scan.withColumn("__file", F.input_file_name()), "scan")
    rows = kept.where(F.col(REJECTED).isNull()).drop(REJECTED, "__file")
    rejected = kept.where(F.col(REJECTED).isNotNull()).select(F.col("__file").alias("file"), F.col(REJECTED).alias("line"))
    return rows, rejected


def ingest_facts(df: DataFrame, date_col: str = "FL_DATE", delay_col: str = "ARR_DELAY_NEW",
                 year_col: str = "Year") -> DataFrame:
    """S4 (facts): delay text -> double, ``Year`` from the fact date."""
    return df.withColumns({delay_col: S.to_double(delay_col),
                           year_col: F.year(S.to_date_text(date_col))})


def ingest_observations(df: DataFrame, date_col: str = "Date", year_col: str = "Year",
                        raw_format: str = S.RAW_DATE_FORMAT) -> DataFrame:
    """S4 (observations): date text yyyyMMdd -> yyyy-MM-dd, ``Year``."""
    d = S.to_date_text(date_col, raw_format)
    return df.withColumns({date_col: F.date_format(d, S.DATE_FORMAT), year_col: F.year(d)})


def sample_rows(df: DataFrame, fraction: float, seed: int = 42,
                key_cols: Sequence[str] | None = None) -> DataFrame:
    """Sample without replacement.  With ``key_cols`` the sample is a
    hash-bucket filter that does not depend on partitioning (stable across
    runs and recomputation); otherwise Spark's seeded Bernoulli sample."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    if key_cols:
        bound = int(fraction * (1 << 32))
        return df.where(S.md5_prefix_int(*key_cols) < F.lit(bound))
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      mode: str = "overwrite", cluster: bool = True) -> None:
    """Partitioned parquet sink.

    ``mode='days'`` replaces only the partitions that ``df`` has rows of, in
    one commit: a day's load leaves other days alone, and loading it again
    changes nothing.

    ``cluster=True`` gathers the rows of a partition value first: one file
    for an ordinary value.  AQE splits a value that is hot and joins small
    ones from the sizes it measured, and the source is read once."""
    if cluster:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_cols])
    writer = df.write.partitionBy(*partition_cols)
    if mode == "days":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def create_parquet_tables(spark: SparkSession, facts_path, obs_path, facts_out: str, obs_out: str,
                          fraction: float | None = None, seed: int = 42) -> None:
    """S1 + S2 + S4 + S5 + S6: raw CSV -> date-partitioned parquet."""
    facts = ingest_facts(read_csv(spark, facts_path))
    obs = ingest_observations(read_csv(spark, obs_path))
    if fraction is not None:
        facts, obs = sample_rows(facts, fraction, seed), sample_rows(obs, fraction, seed)
    write_partitioned(facts, facts_out, FACT_PARTITIONS)
    write_partitioned(obs, obs_out, OBS_PARTITIONS)
