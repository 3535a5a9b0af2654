"""Table recipes: raw fact / observation frames -> cleaned, keyed tables
(Q6, Q7, Q8 with the station-lookup joins J1 - J3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from lagjoin.functions import scalar as S
from lagjoin.operators.columns import (add_prefix, drop_flagged_rows,
                                       to_double_columns, tz_delta)
from lagjoin.operators.quality import impute_and_correct

# The observation feed's measures (each has a "<name>Flag"
# quality column), the columns cast to double, and the lookup's columns.
OBS_MEASURES = ("SkyCondition", "Visibility", "WeatherType", "DryBulbFarenheit", "DryBulbCelsius",
                "WetBulbFarenheit", "WetBulbCelsius", "DewPointFarenheit", "DewPointCelsius",
                "RelativeHumidity", "WindSpeed", "WindDirection", "ValueForWindCharacter",
                "StationPressure", "PressureTendency", "PressureChange", "SeaLevelPressure",
                "RecordType", "HourlyPrecip", "Altimeter")
OBS_TEXT_MEASURES = ("SkyCondition", "WeatherType", "RecordType")
OBS_NUMERIC = ("StationType",) + tuple(m for m in OBS_MEASURES if m not in OBS_TEXT_MEASURES)
FLAG_SUFFIX = "Flag"
LOOKUP_ID, LOOKUP_STATION, LOOKUP_TZ = "AirportID", "WBAN", "TimeZone"
FACT_DELAYS = ("ARR_DELAY_NEW", "WEATHER_DELAY", "NAS_DELAY")
MISSING_RATE = 0.20


def flag_of(measure: str) -> str:
    return measure + FLAG_SUFFIX


# --- J1 / J2 / P9 ---------------------------------------------------------------

def add_time_zones(facts: DataFrame, stations: DataFrame, origin_col: str = "ORIGIN_AIRPORT_ID",
                   dest_col: str = "DEST_AIRPORT_ID", id_col: str = LOOKUP_ID,
                   tz_col: str = LOOKUP_TZ, delta_col: str = "Delta_Lag",
                   keep_zones: bool = False) -> DataFrame:
    """J1 + J2 + P9: inner-join the station lookup on the origin and on the
    destination (facts whose station is unknown are dropped) and add the
    time-zone difference destination - origin in hours.  Spark broadcasts the
    lookup by its size."""
    lk = stations.select(F.col(id_col).alias("__id"), F.col(tz_col).alias("__tz"))
    o = lk.toDF("__o_id", "ORIGIN_TIME_ZONE")
    d = lk.toDF("__d_id", "DEST_TIME_ZONE")
    out = (facts.join(o, F.col(origin_col) == F.col("__o_id"), "inner")
                .join(d, F.col(dest_col) == F.col("__d_id"), "inner"))
    out = out.withColumn(delta_col, tz_delta("DEST_TIME_ZONE", "ORIGIN_TIME_ZONE"))
    keep = facts.columns + ([ "ORIGIN_TIME_ZONE", "DEST_TIME_ZONE"] if keep_zones else []) + [delta_col]
    return out.select(*keep)


# --- Q7 ----------------------------------------------------------------------------

def clean_facts(df: DataFrame, fill_unknown_delay: bool = True) -> DataFrame:
    """Departure clock -> 'HH:mm', types normalised, NULL
    delays -> 0 (or kept NULL with ``fill_unknown_delay=False``), NULL clock
    -> '', departure timestamp (invalid clock such as 24:00 -> NULL)."""
    date = F.col("FL_DATE") if isinstance(df.schema["FL_DATE"].dataType, DateType) \
        else S.to_date_text("FL_DATE")
    p = S.hhmm("CRS_DEP_TIME")
    out = df.withColumns({
        "CRS_DEP_TIME": F.concat(F.substring(p, 1, 2), F.lit(":"), F.substring(p, 3, 2)),
        "FL_DATE": date,
        "ARR_DELAY_NEW": S.to_double("ARR_DELAY_NEW"),
        "CANCELLED": S.to_int("CANCELLED"),
        "DIVERTED": S.to_int("DIVERTED"),
        "CRS_ELAPSED_TIME": S.to_double("CRS_ELAPSED_TIME"),
        "WEATHER_DELAY": S.to_double("WEATHER_DELAY"),
        "NAS_DELAY": S.to_double("NAS_DELAY"),
        "TIMESTAMP": S.clock_timestamp(date, p),
    }).drop("Unnamed: 12")
    if fill_unknown_delay:
        out = out.na.fill(0, list(FACT_DELAYS))
    out = out.na.fill("", ["CRS_DEP_TIME"])
    return out


def fact_table(df: DataFrame, stations: DataFrame, prefix: str = "FT_",
               fill_unknown_delay: bool = True) -> DataFrame:
    """Q7: clean (P4 - P7) -> drop diverted/cancelled (F1) -> origin and
    destination time zones (J1, J2) -> Delta_Lag (P9) -> prefix (P1)."""
    clean = clean_facts(df, fill_unknown_delay)
    kept = drop_flagged_rows(clean, ("DIVERTED", "CANCELLED")).drop("DIVERTED", "CANCELLED")
    return add_prefix(add_time_zones(kept, stations), prefix)


# --- J3 / Q6 -------------------------------------------------------------------------

def join_stations(obs: DataFrame, stations: DataFrame, station_col: str = LOOKUP_STATION,
                  id_col: str = LOOKUP_ID, rename_id: str = "ORIGIN_AIRPORT_ID",
                  pad_width: int | None = None) -> DataFrame:
    """Inner join with the lookup on the station code (a code shared by
    several airports yields one row per airport); the lookup id is renamed.
    ``pad_width`` left-pads the code with zeros on both sides first (feeds
    that zero-pad codes still match)."""
    lk = stations
    if pad_width:
        obs = obs.withColumn(station_col, F.lpad(F.col(station_col), pad_width, "0"))
        lk = lk.withColumn(station_col, F.lpad(F.col(station_col), pad_width, "0"))
    return obs.join(lk, [station_col], "inner").withColumnRenamed(id_col, rename_id)


def observation_table(df: DataFrame, stations: DataFrame, missing_rate: float = MISSING_RATE,
                      measures: Sequence[str] = OBS_MEASURES,
                      numeric_cols: Sequence[str] = OBS_NUMERIC, prefix: str = "OT_",
                      time_col: str = "Time", date_col: str = "Date",
                      ts_col: str = "WEATHER_TIMESTAMP", pad_width: int | None = None) -> DataFrame:
    """Q6: cast measures to double (P3) -> impute columns below the missing
    rate (Q3) -> correct flagged values by mean/mode (Q4, Q5; the means see
    the imputed values) -> 'HHmm' clock and timestamp (P8) -> drop flags
    (P10) -> station lookup (J3) -> prefix (P1)."""
    measures = [m for m in measures if m in df.columns]
    flags = [flag_of(m) for m in measures]
    typed = to_double_columns(df, [c for c in numeric_cols if c in df.columns])
    fixed = impute_and_correct(typed, measures, flags, threshold=missing_rate)
    date = F.col(date_col) if isinstance(df.schema[date_col].dataType, DateType) \
        else S.to_date_text(date_col)
    clock = F.lpad(F.col(time_col), 4, "0")
    fixed = fixed.withColumns({time_col: clock, date_col: date,
                               ts_col: S.clock_timestamp(date, clock)}).drop(*flags)
    return add_prefix(join_stations(fixed, stations, pad_width=pad_width), prefix)


# --- Q8 --------------------------------------------------------------------------------

def require_rows(df: DataFrame, name: str = "result") -> DataFrame:
    """Q8: raise when ``df`` is empty (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df
