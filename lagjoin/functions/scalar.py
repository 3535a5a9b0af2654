"""Column-expression helpers.  Everything here returns a ``Column`` built
from built-in Spark functions, so it stays inside whole-stage codegen.

Spark 4 runs with ANSI mode on: plain casts of bad text, ``x / 0`` and
unparsable timestamps raise.  The helpers use the ``try_*`` family so that
bad input becomes NULL, which is what the cleaning recipes expect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType,
                               FloatType, IntegerType, LongType, NumericType,
                               ShortType, StringType, TimestampNTZType,
                               TimestampType)

# Formats and markers used by the source feeds.
CLOCK_FORMAT = "yyyy-MM-dd HH:mm"      # fact departure: date + "HH:mm"
OBS_CLOCK_FORMAT = "yyyy-MM-dd HHmm"   # observation: date + 4-digit "HHmm"
RAW_DATE_FORMAT = "yyyyMMdd"           # observation feed date before ingest
DATE_FORMAT = "yyyy-MM-dd"
SUSPECT_FLAG = "s"                     # quality flag marking a suspect value


def _c(x) -> Column:
    """Column by exact (flat) name, or a Column as is."""
    return F.col("`" + x.replace("`", "``") + "`") if isinstance(x, str) else x


def to_double(c) -> Column:
    """String/number -> double; unparsable text ('M', '') -> NULL."""
    return _c(c).try_cast("double")


def to_int(c) -> Column:
    """Text such as '600.0' or '5' -> int, truncating toward zero (through
    double, since a direct int cast rejects a decimal point)."""
    return _c(c).try_cast("double").try_cast("int")


def to_long(c) -> Column:
    return _c(c).try_cast("double").try_cast("long")


def hhmm(c, width: int = 4) -> Column:
    """Clock text '745' / '745.0' -> '0745' (left-padded; longer input is
    truncated by lpad, as the feed convention expects)."""
    return F.lpad(to_int(c).cast("string"), width, "0")


def hh_colon_mm(c) -> Column:
    """'745' -> '07:45'."""
    p = hhmm(c)
    return F.concat(F.substring(p, 1, 2), F.lit(":"), F.substring(p, 3, 2))


def parse_local_ts(text: Column, fmt: str) -> Column:
    """Parse wall-clock text to TIMESTAMP_NTZ; invalid text ('24:00') -> NULL.

    ``try_to_timestamp`` yields a session-zone timestamp; casting it to NTZ
    in the same zone returns the written wall time (exact in UTC sessions,
    which the library assumes)."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def clock_timestamp(date_col, hhmm_text) -> Column:
    """DATE + 'HHmm' text -> TIMESTAMP_NTZ, built from integer parts instead
    of parsing text per row (about 5x cheaper).  NULL unless the text is
    exactly four digits forming a valid time ('2400', '1260' -> NULL) -- the
    same rows a 'yyyy-MM-dd HHmm' parse accepts."""
    d, p = _c(date_col), _c(hhmm_text)
    ts = F.try_make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                  F.substring(p, 1, 2).try_cast("int"),
                                  F.substring(p, 3, 2).try_cast("int"), F.lit(0))
    return F.when(p.rlike("^[0-9]{4}$"), ts)


def fact_timestamp(date_col, clock_col) -> Column:
    """Departure timestamp = date || ' ' || 'HH:mm' read as
    'yyyy-MM-dd HH:mm' (``date_col`` a DATE)."""
    c = _c(clock_col)
    p = F.when(c.rlike("^[0-9]{2}:[0-9]{2}$"), F.concat(F.substring(c, 1, 2), F.substring(c, 4, 2)))
    return clock_timestamp(date_col, p)


def obs_timestamp(date_col, time_col) -> Column:
    """Observation timestamp = date || ' ' || lpad(time, 4, '0') read as
    'yyyy-MM-dd HHmm' (``date_col`` a DATE)."""
    return clock_timestamp(date_col, F.lpad(_c(time_col), 4, "0"))


def to_date_text(c, fmt: str = DATE_FORMAT) -> Column:
    """Text in ``fmt`` -> DATE (NULL when unparsable)."""
    return F.try_to_timestamp(_c(c).cast("string"), F.lit(fmt)).cast("date")


def trunc_hour(ts) -> Column:
    """Wall-clock timestamp truncated to the hour, built from its fields (no
    session time zone involved, unlike ``date_trunc`` on TIMESTAMP_NTZ)."""
    c = _c(ts)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def hours_before(ts, hours) -> Column:
    """ts - hours (typed interval arithmetic on wall time)."""
    h = F.lit(hours) if isinstance(hours, int) else _c(hours)
    return _c(ts) - F.make_dt_interval(F.lit(0), h.cast("int"))


def arrival_time(dep_ts, elapsed_minutes, tz_delta_hours) -> Column:
    """Arrival wall time = departure + trunc(elapsed*60) s + trunc(delta*3600) s."""
    secs = (_c(elapsed_minutes) * 60).try_cast("long") + (_c(tz_delta_hours) * 3600).try_cast("long")
    return _c(dep_ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                           secs.cast("decimal(18,6)"))


# --- missing-value predicates -------------------------------------------

def qcol(name: str) -> Column:
    """Column by exact name (dots, spaces and other characters allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(c: str, dtype: DataType) -> Column:
    """Missing by type: null or NaN for float/double, null or '' for
    strings, null otherwise."""
    col = qcol(c)
    if isinstance(dtype, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    if isinstance(dtype, StringType):
        return col.isNull() | (col == F.lit(""))
    return col.isNull()


def is_numeric(dtype: DataType) -> bool:
    return isinstance(dtype, NumericType)


def is_imputable(dtype: DataType) -> bool:
    """Column types the mean imputer touches: int and double (as in the
    original recipe; long ids and floats are left alone)."""
    return isinstance(dtype, (IntegerType, DoubleType))


def is_temporal(dtype: DataType) -> bool:
    return isinstance(dtype, (DateType, TimestampType, TimestampNTZType))


def is_integral(dtype: DataType) -> bool:
    return isinstance(dtype, (ByteType, ShortType, IntegerType, LongType))


def is_decimal(dtype: DataType) -> bool:
    return isinstance(dtype, DecimalType)


# --- deterministic hash buckets -----------------------------------------

def md5_hex(*keys) -> Column:
    """md5 of the key text (several keys joined by '|'); a NULL key has a
    digest of its own, so no row falls out of a split or sample."""
    cols = [_c(k).cast("string") for k in keys]
    txt = cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)
    return F.md5(F.coalesce(txt, F.lit("\0null")))


def md5_row(*columns) -> Column:
    """md5 of whole rows: JSON marks nulls and column borders and the formats
    keep microseconds, so only identical rows have equal digests."""
    text = F.to_json(F.struct(*[_c(c) for c in columns]),
                     {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                      "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return F.md5(text)


def md5_prefix_int(*keys, digits: int = 8) -> Column:
    """First ``digits`` hex digits of md5(key) as a non-negative bigint."""
    return F.conv(F.substring(md5_hex(*keys), 1, digits), 16, 10).cast("long")


def md5_bucket(*keys, buckets: int = 100) -> Column:
    """Partition-independent bucket in [0, buckets): depends only on the key,
    so samples and splits are reproducible across runs and cluster sizes."""
    return (md5_prefix_int(*keys) % F.lit(buckets)).cast("int")
