"""Data-quality profiling and repair.

Every report is ONE aggregate over the table (all columns at once) instead
of one job per column, and the repair recipe needs two statistics passes in
total (one global aggregate, one grouped mode count) before a single
projection applies every fix.  The statistics that reach the driver are
bounded by the number of columns, never by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, FloatType, LongType, StringType, StructField,
                               StructType)

from lagjoin.functions import scalar as S

# Report headers of the missing-value and flag reports.
MISSING_HEADER = ("Column", "Missing_values", "Pct_missing_values")
FLAG_HEADER = ("FlagColumn", "Count")
FLAG_SUFFIX = "Flag"


# --- F6: column-name / type predicates ------------------------------------

def columns_by(df: DataFrame, *, suffix: str | None = None, kind: str | None = None) -> list[str]:
    """pick columns by name suffix and/or type family
    (``kind`` in {'numeric', 'imputable', 'string', 'temporal'})."""
    out = []
    for f in df.schema.fields:
        if suffix is not None and not f.name.endswith(suffix):
            continue
        if kind == "numeric" and not S.is_numeric(f.dataType):
            continue
        if kind == "imputable" and not S.is_imputable(f.dataType):
            continue
        if kind == "string" and not isinstance(f.dataType, StringType):
            continue
        if kind == "temporal" and not S.is_temporal(f.dataType):
            continue
        out.append(f.name)
    return out


def _inline(rows: list[Column]) -> Column:
    return F.inline(F.array(*rows))


# --- Q1 --------------------------------------------------------------------

def missing_report(df: DataFrame) -> DataFrame:
    """Q1: (Column, Missing_values, Pct_missing_values), one row per column.

    Missing = NULL or NaN for float/double, NULL or '' for strings, NULL
    otherwise (F3).  One scan: a single aggregate holds every count, then the
    one-row result is turned into rows with ``inline``.  An empty table gives
    NULL percentages instead of a division error."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(S.is_missing(f.name, f.dataType)).alias(f"__m{i}")
             for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    c_name, c_miss, c_pct = MISSING_HEADER
    rows = [F.struct(F.lit(f.name).alias(c_name), F.col(f"__m{i}").cast("long").alias(c_miss))
            for i, f in enumerate(fields)]
    return (one.select(F.col("__n"), _inline(rows))
               .select(c_name, c_miss,
                       (F.try_divide(F.col(c_miss).cast("double"), F.col("__n")) * 100)
                       .alias(c_pct)))


# --- Q2 --------------------------------------------------------------------

def flag_report(df: DataFrame, flag: str = S.SUSPECT_FLAG,
                flag_cols: Sequence[str] | None = None) -> DataFrame:
    """Q2: (FlagColumn, Count) of values equal to ``flag`` in every column
    whose name ends with 'Flag' -- one scan for all columns."""
    cols = list(flag_cols) if flag_cols is not None else columns_by(df, suffix=FLAG_SUFFIX)
    c_name, c_cnt = FLAG_HEADER
    if not cols:
        spark = df.sparkSession
        return spark.createDataFrame([], StructType([StructField(c_name, StringType()),
                                                     StructField(c_cnt, LongType())]))
    one = df.agg(*[F.count_if(S.qcol(c) == F.lit(flag)).alias(f"__f{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias(c_name), F.col(f"__f{i}").cast("long").alias(c_cnt))
            for i, c in enumerate(cols)]
    return one.select(_inline(rows))


# --- A6 / A7: mean under a filter, mode ------------------------------------

def mean_where(df: DataFrame, value_col: str, flag_col: str,
               flag: str = S.SUSPECT_FLAG, alias: str = "mean") -> DataFrame:
    """Mean of ``value_col`` over rows whose flag is not ``flag`` (rows
    with a NULL flag are excluded, as ``!=`` is NULL there).  One row."""
    keep = S.qcol(flag_col) != F.lit(flag)
    return df.agg(F.avg(F.when(keep, S.qcol(value_col))).alias(alias))


def mode_where(df: DataFrame, value_col: str, flag_col: str | None = None,
               flag: str = S.SUSPECT_FLAG) -> DataFrame:
    """Most frequent value (NULL is a value of its own), optionally over
    rows whose flag is not ``flag``; ties go to the smallest value, NULL
    first.  Returns (value, count), at most one row."""
    src = df if flag_col is None else df.where(S.qcol(flag_col) != F.lit(flag))
    counted = src.groupBy(S.qcol(value_col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    best = counted.agg(F.min(F.struct((-F.col("count")).alias("nc"),
                                      F.col("value").isNotNull().alias("nn"),
                                      F.col("value").alias("value"))).alias("b"))
    return best.where(F.col("b").isNotNull()).select(F.col("b.value").alias("value"),
                                                     (-F.col("b.nc")).alias("count"))


# --- Q3 / Q4 / Q5 ------------------------------------------------------------

def impute_and_correct(df: DataFrame, value_cols: Sequence[str] = (),
                       flag_cols: Sequence[str] = (), threshold: float = 0.20,
                       impute_cols: Sequence[str] | None = None,
                       flag: str = S.SUSPECT_FLAG, strategy: str = "mean") -> DataFrame:
    """Q3 + Q4 + Q5 in two statistics passes and one projection.

    Q3  every int/double column (or ``impute_cols``) whose missing share
        (NULL or NaN) is strictly below ``threshold`` gets its missing values
        replaced by the column mean over all rows (integer columns keep
        their type: the mean is truncated).  ``strategy='median'`` uses an
        approximate median instead.
    Q4  for each numeric (value, flag) pair, values flagged ``flag`` are
        replaced by the mean of the value over rows whose flag is not
        ``flag`` -- computed on the imputed values, as if Q3 ran first.
    Q5  for non-numeric pairs the replacement is the mode over those rows
        (NULL counts as a value; ties -> smallest value, NULL first).
    A pair whose reference set is empty (or whose mean is undefined) is left
    unchanged.
    """
    if len(value_cols) != len(flag_cols):
        raise ValueError("value_cols and flag_cols must have the same length")
    if strategy not in ("mean", "median"):
        raise ValueError(f"unknown strategy {strategy!r}")
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in [*value_cols, *flag_cols]:
        if c not in types:
            raise ValueError(f"column {c!r} not found")
    cand = list(impute_cols) if impute_cols is not None else \
        [c for c, t in types.items() if S.is_imputable(t)]
    num_pairs = [(i, v, f) for i, (v, f) in enumerate(zip(value_cols, flag_cols))
                 if S.is_numeric(types[v])]
    txt_pairs = [(i, v, f) for i, (v, f) in enumerate(zip(value_cols, flag_cols))
                 if not S.is_numeric(types[v])]

    def missing(c: str) -> Column:
        col = S.qcol(c)
        if isinstance(types[c], (DoubleType, FloatType)):
            return col.isNull() | F.isnan(col)
        return col.isNull()

    def nan(c: str) -> Column:
        if isinstance(types[c], (DoubleType, FloatType)):
            return F.isnan(S.qcol(c))
        return F.lit(False)

    # pass 1: one global aggregate for shares, centres and per-pair sums
    aggs = [F.count(F.lit(1)).alias("n")]
    for j, c in enumerate(cand):
        aggs.append(F.count_if(missing(c)).alias(f"miss{j}"))
        present = F.when(~missing(c), S.qcol(c).cast("double"))
        centre = F.avg(present) if strategy == "mean" else F.percentile_approx(present, 0.5, 10000)
        aggs.append(centre.alias(f"ctr{j}"))
    for i, v, f in num_pairs:
        keep = F.coalesce(S.qcol(f) != F.lit(flag), F.lit(False))
        aggs += [F.sum(F.when(keep & ~missing(v), S.qcol(v).cast("double"))).alias(f"ps{i}"),
                 F.count_if(keep & ~missing(v)).alias(f"pc{i}"),
                 F.count_if(keep & S.qcol(v).isNull()).alias(f"pn{i}"),
                 F.count_if(keep & nan(v)).alias(f"pq{i}")]
    st = df.agg(*aggs).first().asDict()
    n = st["n"] or 0

    fill: dict[str, object] = {}
    for j, c in enumerate(cand):
        share = (st[f"miss{j}"] / n) if n else float("nan")
        ctr = st[f"ctr{j}"]
        # columns without missing values need no rewrite
        if n and share < threshold and ctr is not None and st[f"miss{j}"] > 0:
            fill[c] = int(ctr) if S.is_integral(types[c]) else float(ctr)

    repl: dict[str, tuple[bool, object]] = {}
    for i, v, f in num_pairs:
        s, cnt, nnull, nnan = st[f"ps{i}"] or 0.0, st[f"pc{i}"], st[f"pn{i}"], st[f"pq{i}"]
        if v in fill:
            den = cnt + nnull + nnan
            repl[v] = (den > 0, (s + float(fill[v]) * (nnull + nnan)) / den if den else None)
        elif nnan > 0:
            repl[v] = (True, float("nan"))
        else:
            repl[v] = (cnt > 0, s / cnt if cnt else None)

    # pass 2: modes of the non-numeric pairs, one grouped count for all
    if txt_pairs:
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("k"), S.qcol(v).cast("string").alias("v"),
                     F.coalesce(S.qcol(f) != F.lit(flag), F.lit(False)).alias("keep"))
            for i, v, f in txt_pairs])).alias("s")).select("s.*").where("keep")
        best = (stacked.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
                .groupBy("k").agg(F.min(F.struct((-F.col("c")).alias("nc"),
                                                 F.col("v").isNotNull().alias("nn"),
                                                 F.col("v").alias("v"))).alias("b"))
                .select("k", "b.v").collect())
        modes = {r["k"]: r["v"] for r in best}
        for i, v, f in txt_pairs:
            if i in modes:
                repl[v] = (True, modes[i])

    # single projection applying every fix
    exprs = {}
    for c, val in fill.items():
        col = S.qcol(c)
        exprs[c] = F.when(missing(c), F.lit(val).cast(types[c])).otherwise(col)
    for i, (v, f) in enumerate(zip(value_cols, flag_cols)):
        ok, val = repl.get(v, (False, None))
        if not ok:
            continue
        base = exprs.get(v, S.qcol(v))
        if S.is_numeric(types[v]):
            lit = F.lit(val).cast("double")
        else:
            lit = F.lit(val).cast(types[v]) if val is not None else F.lit(None).cast(types[v])
        exprs[v] = F.when(S.qcol(f) == F.lit(flag), lit).otherwise(base)
    return df.withColumns(exprs) if exprs else df


def impute_mean(df: DataFrame, threshold: float = 0.20, cols: Sequence[str] | None = None,
                strategy: str = "mean") -> DataFrame:
    """Q3 alone (see :func:`impute_and_correct`)."""
    return impute_and_correct(df, threshold=threshold, impute_cols=cols, strategy=strategy)


def correct_by_flag(df: DataFrame, value_cols: Sequence[str], flag_cols: Sequence[str],
                    flag: str = S.SUSPECT_FLAG) -> DataFrame:
    """Q4 + Q5 alone (no imputation)."""
    return impute_and_correct(df, value_cols, flag_cols, threshold=-1.0, impute_cols=[],
                              flag=flag)


__all__ = ["FLAG_HEADER", "MISSING_HEADER", "columns_by", "correct_by_flag", "flag_report",
           "impute_and_correct", "impute_mean", "mean_where", "missing_report", "mode_where"]
