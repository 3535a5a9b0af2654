"""End-to-end workflow: the original application's three stages as plain
functions a user composes (no mode dispatcher, no config file).

    prepare     read the fact/observation parquet pair aligned on their
                common dates, profile them (reports), build the cleaned
                fact (FT_) and observation (OT_) tables
    join        tag/key both tables and run the long and/or wide lag join
    train       labelled, balanced, split datasets -> random forest ->
                metrics (trained on both classes' train parts)
    run         all of it, writing reports, joined tables, schemas and
                metrics under one output folder

Intermediate tables are written (parquet) and read back between stages:
that cuts the lineage, so a lost executor recomputes from the last written
table instead of from the raw files, and it gives the wide join a stable
row key.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.operators import datasets as D
from lagjoin.operators import lagged as L
from lagjoin.operators import ml as M
from lagjoin.operators import quality as Q
from lagjoin.operators import stats as A
from lagjoin.operators.dictionary import fit_dictionary
from lagjoin.plans import tables as T
from lagjoin.sources import ingest as I
from lagjoin.sources import parquet as P
from lagjoin.sources import sinks as K

# Column names of the prepared tables and report names.
FACT_KEY = "FT_ROW_ID"
FT_ORIGIN, FT_DEST = "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID"
FT_TS, FT_ARRIVAL = "FT_TIMESTAMP", "FT_DEST_DATE_TIME"
OT_STATION, OT_TS, OT_DATE = "OT_ORIGIN_AIRPORT_ID", "OT_WEATHER_TIMESTAMP", "OT_Date"
LABEL_LEAKS = ("FT_ARR_DELAY_NEW", "FT_WEATHER_DELAY", "FT_NAS_DELAY")
REPORTS = ("parquet_files_stats", "fact_missingValues", "weather_missingValues", "countSinFlag",
           "descriptive_stats", "carrier_stats", "delayed_stats")
MODES = ("cols", "lines", "both")


def reports(facts: DataFrame, obs: DataFrame, stats: DataFrame, on_time: float = 15
            ) -> dict[str, DataFrame]:
    """Profiles of the aligned raw tables (each one aggregate pass)."""
    return dict(zip(REPORTS, [stats, Q.missing_report(facts), Q.missing_report(obs),
                              Q.flag_report(obs), A.airport_summary(facts),
                              A.carrier_performance(facts, on_time), A.delay_breakdown(facts)]))


def prepare(spark: SparkSession, facts_path: str, obs_path: str, stations_path: str,
            report_dir: str | None = None, missing_rate: float = T.MISSING_RATE,
            on_time: float = 15, pad_width: int | None = None
            ) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Stage A: aligned pair -> reports -> FT and OT tables (lazy)."""
    facts, obs, stats = P.read_pair(spark, facts_path, obs_path)
    stations = I.read_csv(spark, stations_path)
    reps = reports(facts, obs, stats, on_time)
    if report_dir:
        for name, df in reps.items():
            K.write_report_csv(df, os.path.join(report_dir, f"{name}.csv"))
    ft = T.fact_table(facts, stations)
    ot = T.observation_table(obs, stations, missing_rate, pad_width=pad_width)
    return ft, ot, reps


def with_row_id(df: DataFrame, col: str = FACT_KEY) -> DataFrame:
    """Unique row id; stable once the frame is written and read back."""
    return df.withColumn(col, F.monotonically_increasing_id())


def join(ft: DataFrame, ot: DataFrame, mode: str = "lines", obs_cols: Sequence[str] | None = None,
         lags: int = L.DEFAULT_LAGS, match_station: bool = True,
         dedupe: str | None = None, nested: bool = False, digits: int | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Stage B: (cols, lines).  ``ft`` must carry a unique ``FT_ROW_ID`` for
    the wide form (see :func:`with_row_id`); ``obs_cols`` limits the carried
    observation columns; ``dedupe`` ('mean' or 'min') first makes the
    observations unique per (station, time), ``digits`` rounds their means
    there, once a reading instead of in every joined row.  ``nested``: the wide form as
    arrays by lag, for :func:`lagjoin.operators.lagged.flatten_wide`."""
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} not in {MODES}")
    if dedupe is not None:
        extra = [OT_DATE] if OT_DATE in ot.columns else []   # needed by the key mapping
        keep = list(dict.fromkeys([OT_STATION, OT_TS, *extra, *(obs_cols or ot.columns)]))
        ot = L.dedupe_observations(ot.select(*keep), OT_STATION, OT_TS, how=dedupe, digits=digits)
    ftm, otm = L.map_facts(ft), L.map_observations(ot)
    kw = dict(origin_col=FT_ORIGIN, origin_ts_col=FT_TS, station_col=OT_STATION,
              obs_ts_col=OT_TS, dest_col=FT_DEST, dest_ts_col=FT_ARRIVAL, obs_cols=obs_cols,
              lags=lags)
    unique = "unique" if dedupe is not None else "all"
    lines = L.lag_join_long(ftm, otm, duplicates=unique, **kw) if mode in ("lines", "both") else None
    cols = None
    if mode in ("cols", "both"):
        if FACT_KEY not in ft.columns:
            raise ValueError(f"the wide form needs a unique {FACT_KEY} column (with_row_id)")
        side = otm if match_station else L.dedupe_observations(
            otm.select(*(obs_cols or otm.columns)), None, OT_TS)
        cols = L.lag_join_wide(ftm, side, match_station=match_station, nested=nested, **kw)
    return cols, lines


def train(joined: DataFrame, ds_type: str = "DS1", delayed: float = 15, on_time: float = 1.0,
          key_cols: Sequence[str] | None = None, features: Sequence[str] | None = None,
          num_trees: int = M.NUM_TREES, max_depth: int = M.MAX_DEPTH, folds: int | None = None,
          seed: int = 42, fill_missing: float | None = None, handle_invalid: str = "error",
          max_categories: int = M.MAX_CATEGORIES) -> dict[str, float]:
    """Stage C: labelled datasets (D1 - D9) -> random forest trained on both
    classes' train parts and evaluated on both test parts.

    Default features: every numeric column plus dates/timestamps as epoch
    seconds, minus the label, the delay columns that define the label and
    the row id -- text keys (join keys, ids as text) are left out; string
    columns named in ``features`` are indexed by a dictionary of the train
    part, rare values as one of at most ``max_categories``.  Missing feature values (lag-join misses) are an error
    unless ``fill_missing`` gives a value or ``handle_invalid`` says 'keep' or 'skip'."""
    if key_cols is None and FACT_KEY in joined.columns:
        key_cols = [FACT_KEY]  # the lag rows of a fact stay in one part
    d_tr, d_te, o_tr, o_te = D.labelled_datasets(joined, ds_type, delayed, on_time,
                                                 key_cols=key_cols)
    train_df, test_df = d_tr.unionByName(o_tr), d_te.unionByName(o_te)
    temporal = Q.columns_by(train_df, kind="temporal")
    train_df, test_df = M.dates_to_epoch(train_df, temporal), M.dates_to_epoch(test_df, temporal)
    if features is None:
        feats = M.feature_columns(train_df, D.LABEL_COL, exclude=(*LABEL_LEAKS, FACT_KEY))
    else:
        feats = list(features)
        text = [c for c in feats if c in Q.columns_by(train_df, kind="string")]
        if text:
            known = fit_dictionary(train_df, text, max_categories)
            train_df, test_df = known.transform(train_df, "keep"), known.transform(test_df, "keep")
    if fill_missing is not None:
        train_df = train_df.fillna(fill_missing, subset=feats)
        test_df = test_df.fillna(fill_missing, subset=feats)
    _, _, metrics = M.train_random_forest(train_df, test_df, D.LABEL_COL, feats, num_trees,
                                          max_depth, folds, seed, handle_invalid,
                                          fold_keys=key_cols)
    return metrics


def run(spark: SparkSession, facts_path: str, obs_path: str, stations_path: str, out_dir: str,
        mode: str = "lines", obs_cols: Sequence[str] | None = None, ds_type: str = "DS1",
        delayed: float = 15, on_time: float = 1.0, dedupe: str | None = "mean", **train_kw
        ) -> dict[str, dict[str, float]]:
    """All stages; writes under ``out_dir``: reports/*.csv, ft/, ot/,
    joined_cols/ (readings as arrays by lag) and/or joined_lines/ (both
    partitioned by year and date),
    schema_*.json and metrics_<mode>/metrics.csv.  Returns the metrics per
    produced form."""
    rep = os.path.join(out_dir, "reports")
    ft, ot, _ = prepare(spark, facts_path, obs_path, stations_path, rep)
    I.write_partitioned(with_row_id(ft), os.path.join(out_dir, "ft"), ["FT_Year", "FT_FL_DATE"])
    I.write_partitioned(ot, os.path.join(out_dir, "ot"), ["OT_Year", "OT_Date"])
    ft = spark.read.parquet(os.path.join(out_dir, "ft"))
    ot = spark.read.parquet(os.path.join(out_dir, "ot"))
    T.require_rows(ft, "fact table")
    cols, lines = join(ft, ot, mode, obs_cols, dedupe=dedupe, nested=True)
    out: dict[str, dict[str, float]] = {}
    for name, df in (("cols", cols), ("lines", lines)):
        if df is None:
            continue
        path = os.path.join(out_dir, f"joined_{name}")
        K.store_results(df, path)
        joined = T.require_rows(spark.read.parquet(path), f"joined {name}")
        if name == "cols":
            joined = L.flatten_wide(joined, origin_ts_col=FT_TS, dest_ts_col=FT_ARRIVAL)
        K.write_schema_json(joined, os.path.join(out_dir, f"schema_{name}.json"))
        metrics = train(joined, ds_type, delayed, on_time, **train_kw)
        K.write_metrics_csv(spark, metrics, os.path.join(out_dir, f"metrics_{ds_type}_{name}"))
        out[name] = metrics
    return out
