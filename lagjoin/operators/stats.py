"""Descriptive statistics over fact tables (all single-aggregate plans:
partial aggregation runs map-side, so hot groups are combined before the
shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagjoin.functions import scalar as S

# Report headers of the published statistics.
AIRPORT_HEADER = ("nbs de vols", "nbs_compagnies", "nbs_aeroports_dest")
CARRIER_HEADER = ("nbs de vol", "% On-time", "% Delayed", "% Cancelled", "% Diverted")
DELAY_HEADER = ("% Weather_delay", "% Nas_delay", "% Other_delay")
RANGE_HEADER = ("min_date", "max_date", "size", "dataset")
YEAR_ALIAS = "year"


def _pct(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den) * 100


# --- A1 --------------------------------------------------------------------

def airport_summary(df: DataFrame, origin_col: str = "ORIGIN_AIRPORT_ID",
                    fact_col: str = "OP_CARRIER_FL_NUM",
                    carrier_col: str = "OP_CARRIER_AIRLINE_ID",
                    dest_col: str = "DEST_AIRPORT_ID") -> DataFrame:
    """A1: per origin, non-null carrier numbers, distinct carriers and
    distinct destinations."""
    a, b, c = AIRPORT_HEADER
    return df.groupBy(origin_col).agg(F.count(fact_col).alias(a),
                                      F.countDistinct(carrier_col).alias(b),
                                      F.countDistinct(dest_col).alias(c))


# --- A2 + A9 ---------------------------------------------------------------

def carrier_performance(df: DataFrame, on_time: float = 15, year_col: str = "Year",
                        delay_col: str = "ARR_DELAY_NEW", fact_col: str = "OP_CARRIER_FL_NUM",
                        cancelled_col: str = "CANCELLED", diverted_col: str = "DIVERTED",
                        year_alias: str = YEAR_ALIAS) -> DataFrame:
    """A2: per year, the shares of on-time (delay <= t), delayed (delay >= t),
    cancelled and diverted facts.  A delay equal to t counts in both
    classes, a NULL delay in neither, and the denominator is the sum of the
    four counts (not the row count), as in the published statistics."""
    n, p_on, p_del, p_can, p_div = CARRIER_HEADER
    d = S.to_double(delay_col)
    agg = df.groupBy(F.col(year_col).alias(year_alias)).agg(
        F.count(fact_col).alias(n),
        F.count_if(d <= F.lit(on_time)).alias("__on"),
        F.count_if(d >= F.lit(on_time)).alias("__del"),
        F.count_if(S.to_double(cancelled_col) == F.lit(1)).alias("__can"),
        F.count_if(S.to_double(diverted_col) == F.lit(1)).alias("__div"))
    tot = F.col("__on") + F.col("__del") + F.col("__can") + F.col("__div")
    return agg.select(year_alias, n,
                      _pct(F.col("__on"), tot).alias(p_on), _pct(F.col("__del"), tot).alias(p_del),
                      _pct(F.col("__can"), tot).alias(p_can), _pct(F.col("__div"), tot).alias(p_div))


# --- A3 + F5 -----------------------------------------------------------------

def delay_breakdown(df: DataFrame, year_col: str = "Year", delay_col: str = "ARR_DELAY_NEW",
                    weather_col: str = "WEATHER_DELAY", nas_col: str = "NAS_DELAY",
                    year_alias: str = YEAR_ALIAS) -> DataFrame:
    """A3: over facts with a non-zero delay (F5), per year, the shares of
    weather, NAS and other causes in the total delay minutes; other = total
    - (weather + NAS)."""
    w_p, n_p, o_p = DELAY_HEADER
    agg = (df.where(S.to_double(delay_col) != F.lit(0))
             .groupBy(F.col(year_col).alias(year_alias))
             .agg(F.sum(S.to_double(delay_col)).alias("__a"),
                  F.sum(S.to_double(weather_col)).alias("__w"),
                  F.sum(S.to_double(nas_col)).alias("__n")))
    other = F.col("__a") - (F.col("__n") + F.col("__w"))
    return agg.select(year_alias, _pct(F.col("__w"), F.col("__a")).alias(w_p),
                      _pct(F.col("__n"), F.col("__a")).alias(n_p),
                      _pct(other, F.col("__a")).alias(o_p))


# --- A4 / A5 -----------------------------------------------------------------

def range_stats(df: DataFrame, date_col: str, dataset: str) -> DataFrame:
    """A4: one row (min_date, max_date, size, dataset)."""
    a, b, c, d = RANGE_HEADER
    return df.agg(F.min(date_col).alias(a), F.max(date_col).alias(b),
                  F.count(F.lit(1)).alias(c)).withColumn(d, F.lit(dataset))


def row_count(df: DataFrame) -> DataFrame:
    """A5 as a frame: one row with the row count (lazy, composable)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
