"""Column-expression helpers (all JVM-side built-ins)."""

from lagjoin.functions.scalar import (CLOCK_FORMAT, DATE_FORMAT, OBS_CLOCK_FORMAT,
                                      RAW_DATE_FORMAT, SUSPECT_FLAG, arrival_time,
                                      clock_timestamp,
                                      fact_timestamp, hh_colon_mm, hhmm, hours_before,
                                      is_imputable, is_integral, is_missing,
                                      is_numeric, is_temporal, md5_bucket, md5_hex,
                                      md5_prefix_int, obs_timestamp, parse_local_ts,
                                      qcol, trunc_hour,
                                      to_date_text, to_double, to_int, to_long)

__all__ = [
    "CLOCK_FORMAT", "DATE_FORMAT", "OBS_CLOCK_FORMAT", "RAW_DATE_FORMAT", "SUSPECT_FLAG",
    "arrival_time", "clock_timestamp", "fact_timestamp", "hh_colon_mm", "hhmm", "hours_before",
    "is_imputable", "is_integral", "is_missing", "is_numeric", "is_temporal",
    "md5_bucket", "md5_hex", "md5_prefix_int", "obs_timestamp", "parse_local_ts", "qcol",
    "trunc_hour",
    "to_date_text", "to_double", "to_int", "to_long",
]
