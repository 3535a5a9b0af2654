"""Projections, renames, casts and small relational helpers.

Renames are done in a single ``select``/``toDF`` (one Project node) rather
than a loop of ``withColumnRenamed`` calls, which grows the analysed plan
quadratically on wide tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lagjoin.functions import scalar as S

# How the feed marks a missing number.
NO_NUMBER = ("M", "")
PARSED = "__parsed"


# --- P1 / P2: prefix and suffix every column ------------------------------

def add_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Prefix every column name."""
    return df.toDF(*[prefix + c for c in df.columns])


def add_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Suffix every column name."""
    return df.toDF(*[c + suffix for c in df.columns])


# --- P3: cast to double ---------------------------------------------------

def to_double_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Cast the listed columns to double; unparsable text becomes NULL.

    Text columns are parsed by one function over an array of them: a parser
    for each would make the method that Spark generates for a wide table
    larger than the JVM compiles, and it would be interpreted row by row.
    The feed's marks for a missing value are told apart by comparison, since
    a failed parse costs many times a successful one."""
    cols = list(dict.fromkeys(cols))
    text = [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, StringType)]
    parsed = {c: F.get(S.qcol(PARSED), F.lit(k)) for k, c in enumerate(text)}
    if text:
        df = df.select("*", F.transform(F.array(*[S.qcol(c) for c in text]), lambda x: F.when(
            ~x.isin(*NO_NUMBER), S.to_double(x))).alias(PARSED))
    return df.withColumns({c: parsed[c] if c in parsed else S.to_double(c) for c in cols}).drop(PARSED)


# --- P18 ------------------------------------------------------------------

def select_columns(df: DataFrame, first: str, others: Sequence[str]) -> DataFrame:
    """Label + feature subset (duplicates removed, order kept)."""
    seen, out = set(), []
    for c in [first, *others]:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return df.select(*out)


# --- P9 -------------------------------------------------------------------

def tz_delta(dest_tz, origin_tz) -> Column:
    """Destination minus origin time-zone offset, in whole hours."""
    d = F.col(dest_tz) if isinstance(dest_tz, str) else dest_tz
    o = F.col(origin_tz) if isinstance(origin_tz, str) else origin_tz
    return S.to_int(d) - S.to_int(o)


# --- F1 / F2 --------------------------------------------------------------

def drop_flagged_rows(df: DataFrame, cols: Sequence[str] = ("DIVERTED", "CANCELLED")) -> DataFrame:
    """keep rows whose indicator columns are all != 1.  Three-valued
    logic as in SQL: a NULL indicator drops the row."""
    cond = None
    for c in cols:
        e = S.to_double(c) != F.lit(1)
        cond = e if cond is None else (cond & e)
    return df.where(cond) if cond is not None else df


def between_dates(df: DataFrame, col: str, start, end) -> DataFrame:
    """inclusive range filter.  With literal bounds on a partition column
    Spark prunes partitions at planning time."""
    return df.where(F.col(col).between(F.lit(start), F.lit(end)))


# --- O1 / O3 --------------------------------------------------------------

def top_value(df: DataFrame, value_col: str, count_col: str = "count") -> DataFrame:
    """O1: most frequent value (count desc, ties -> smallest value, NULL
    first).  ``orderBy().limit(1)`` plans as TakeOrderedAndProject: each task
    keeps its local best row, so nothing large funnels into one task."""
    return (df.groupBy(value_col).agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.col(count_col).desc(), F.col(value_col).asc_nulls_first())
              .limit(1))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """O3: union by column name (the positional union of the original is
    fragile when column orders differ)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

