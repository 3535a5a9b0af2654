"""Parquet table pairs (S7 - S11): read, align on the common date range,
load statistics, reload joined results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.functions import scalar as S
from lagjoin.operators.columns import between_dates, union_all
from lagjoin.session import written

# Dataset labels of the load statistics.
STAT_LABELS = ("fact_initial", "weather_initial", "fact_filtered", "weather_filtered")
JOINED_MODES = ("cols", "lines", "both")


def read_parquet(spark: SparkSession, path: str, fraction: float | None = None,
                 seed: int | None = None) -> DataFrame:
    """Parquet scan (partition columns inferred: Year int, dates as
    date), optionally sampled (seeded when ``seed`` is given)."""
    df = spark.read.parquet(path)
    if fraction is not None:
        df = df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df


def date_histogram(df: DataFrame, date_col: str) -> DataFrame:
    """Rows per date, as a written table of a row per date: range, sizes and
    every filtered size follow from it, so a table is read once.  Where the
    date is a partition column the scan needs row counts only."""
    return written(df.groupBy(S.qcol(date_col).alias("date")).agg(F.count(F.lit(1)).alias("n")), "dates")


def _range_of(a: DataFrame, a_col: str, b: DataFrame, b_col: str):
    ra = a.agg(F.min(a_col).alias("lo"), F.max(a_col).alias("hi")).first()
    rb = b.agg(F.min(b_col).alias("lo"), F.max(b_col).alias("hi")).first()
    if ra["lo"] is None or rb["lo"] is None:
        raise ValueError("cannot align an empty table")
    return max(ra["lo"], rb["lo"]), min(ra["hi"], rb["hi"])


def common_range(a: DataFrame, a_col: str, b: DataFrame, b_col: str):
    """(start, end) = (max of the minima, min of the maxima).  Two
    one-row aggregates; on partition columns these read only metadata-sized
    data.  Raises on an empty input (no range)."""
    return _range_of(a, a_col, b, b_col)


def histogram_stats(histogram: DataFrame, label: str) -> DataFrame:
    """A row of the load statistics from a date histogram."""
    return histogram.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"),
                         F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("size")).withColumn("dataset", F.lit(label))


def align_pair(facts: DataFrame, obs: DataFrame, fact_date: str = "FL_DATE",
               obs_date: str = "Date") -> tuple[DataFrame, DataFrame, DataFrame]:
    """S8 + S9 + F2: filter both tables to their common date range
    (inclusive; disjoint ranges give two empty tables) and return the load
    statistics (initial and filtered; min_date, max_date, size, dataset).
    The range and all statistics come from one histogram a table.  The bounds
    are literals, so filters on partition columns prune directories at
    planning time."""
    f_dates, o_dates = date_histogram(facts, fact_date), date_histogram(obs, obs_date)
    start, end = _range_of(f_dates, "date", o_dates, "date")
    stats = union_all([histogram_stats(h, label) for h, label in zip(
        (f_dates, o_dates, between_dates(f_dates, "date", start, end), between_dates(o_dates, "date", start, end)),
        STAT_LABELS)])
    return between_dates(facts, fact_date, start, end), between_dates(obs, obs_date, start, end), stats


def read_pair(spark: SparkSession, facts_path: str, obs_path: str, aligned: bool = True,
              fact_date: str = "FL_DATE", obs_date: str = "Date",
              joined_date: str = "FT_FL_DATE", fraction: float | None = None,
              seed: int | None = None, stats_csv: str | None = None
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read both tables.  ``aligned=True``: filter to the common
    range (S8) with 4-row statistics.  ``aligned=False`` (tables already
    joined): both dated by ``joined_date``, no filtering, 2-row statistics,
    also written to ``stats_csv`` when given."""
    facts = read_parquet(spark, facts_path, fraction, seed)
    obs = read_parquet(spark, obs_path, fraction, seed)
    if aligned:
        return align_pair(facts, obs, fact_date, obs_date)
    stats = load_stats(facts, obs, joined_date)
    if stats_csv:
        from lagjoin.sources.sinks import write_report_csv
        write_report_csv(stats, stats_csv)
    return facts, obs, stats


def load_stats(facts: DataFrame, obs: DataFrame, date_col: str) -> DataFrame:
    """2-row load statistics of already-joined tables (both dated by
    ``date_col``)."""
    return union_all([histogram_stats(date_histogram(t, date_col), label)
                      for t, label in zip((facts, obs), STAT_LABELS)])


def read_joined(spark: SparkSession, cols_path: str | None, lines_path: str | None,
                mode: str = "cols") -> tuple[DataFrame | None, DataFrame | None]:
    """Reload the wide ('cols') and/or long ('lines') joined tables.
    Unknown modes and unreadable paths raise instead of returning empty
    frames."""
    if mode not in JOINED_MODES:
        raise ValueError(f"generation mode {mode!r} invalid ({', '.join(JOINED_MODES)})")
    cols = spark.read.parquet(cols_path) if mode in ("cols", "both") else None
    lines = spark.read.parquet(lines_path) if mode in ("lines", "both") else None
    return cols, lines
