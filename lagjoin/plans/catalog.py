"""Query catalogue: every operator of the inventory as a query over the
fixture views (Spark) with its equivalent SQL (DuckDB oracle).

Conventions: computed columns carry the same alias on both sides; doubles
produced by aggregation are rounded to 6 places on both sides; counts are
bigint.  Queries without SQL are checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lagjoin.functions import scalar as S
from lagjoin.operators import columns as C
from lagjoin.operators import datasets as D
from lagjoin.operators import lagged as L
from lagjoin.operators import ml as M
from lagjoin.operators import quality as Q
from lagjoin.operators import stats as A
from lagjoin.plans import fixtures as X
from lagjoin.plans import tables as T
from lagjoin.plans import workflow as W
from lagjoin.session import scratch_path
from lagjoin.sources import ingest as I
from lagjoin.sources import parquet as P
from lagjoin.sources import sinks as K
from lagjoin.streaming.enrich import enrich_available

Query = Callable[[SparkSession, str], DataFrame]
LAGS = 12
ROUND = 6


def _round(df: DataFrame, digits: int = ROUND) -> DataFrame:
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in dbl else F.col(f"`{c}`")
                       for c in df.columns])


def _sql_round(sql: str, cols: list[str]) -> str:
    rep = ", ".join(f'round("{c}", {ROUND}) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q"


# ============================================================================
# Lag joins
# ============================================================================

def _lag_long(spark, sf, with_dest=True):
    f, o = X.facts(spark, sf), X.obs(spark, sf)
    return L.lag_join_long(f, o, origin_col="origin", origin_ts_col="t", station_col="station",
                           obs_ts_col="ts", dest_col="dest" if with_dest else None,
                           dest_ts_col="arr" if with_dest else None,
                           origin_lag_col="t_lag", dest_lag_col="arr_lag", lags=LAGS)


def q_j4(spark, sf):
    x = L.explode_lags(X.facts(spark, sf), LAGS)
    return x.select("fact_id", "hours_lag", S.hours_before("t", F.col("hours_lag")).alias("t_lag"))


SQL_J4 = f"""WITH facts AS ({X.FACTS_SQL})
SELECT f.fact_id, CAST(h.range AS INTEGER) AS hours_lag,
       f.t - to_hours(CAST(h.range AS INTEGER)) AS t_lag
FROM facts f CROSS JOIN range({LAGS}) h"""


def q_j5(spark, sf):
    return _lag_long(spark, sf, with_dest=False)


def _long_sql(with_dest: bool) -> str:
    dest_cols = (""", d.station AS station_DEST, d.ts AS ts_DEST, d.n AS n_DEST, d.v AS v_DEST"""
                 if with_dest else "")
    dest_join = ("\nLEFT JOIN obs d ON d.station = y.dest AND d.ts = y.arr_lag" if with_dest else "")
    arr_lag = ", y0.arr - to_hours(y0.hours_lag) AS arr_lag" if with_dest else ""
    return f"""WITH facts AS ({X.FACTS_SQL}), obs AS ({X.OBS_SQL}),
y0 AS (SELECT f.*, CAST(h.range AS INTEGER) AS hours_lag FROM facts f CROSS JOIN range({LAGS}) h),
y AS (SELECT y0.*, y0.t - to_hours(y0.hours_lag) AS t_lag{arr_lag} FROM y0)
SELECT y.*, o.station AS station_ORIG, o.ts AS ts_ORIG, o.n AS n_ORIG, o.v AS v_ORIG{dest_cols}
FROM y LEFT JOIN obs o ON o.station = y.origin AND o.ts = y.t_lag{dest_join}"""


def q_j6(spark, sf):
    return _lag_long(spark, sf, with_dest=True)


def q_j6_joins(spark, sf):
    f, o = X.facts(spark, sf), X.obs(spark, sf)
    return L.lag_join_long(f, o, origin_col="origin", origin_ts_col="t", station_col="station",
                           obs_ts_col="ts", dest_col="dest", dest_ts_col="arr",
                           origin_lag_col="t_lag", dest_lag_col="arr_lag", lags=LAGS,
                           strategy="joins", skew_salt=4)


def q_j6_dup(spark, sf):
    """Readings as they are: a lag row repeats for every origin x destination
    pair of readings."""
    j = L.lag_join_long(X.facts(spark, sf), X.readings(spark, sf), origin_col="origin", origin_ts_col="t",
                        station_col="station", obs_ts_col="ts", dest_col="dest", dest_ts_col="arr",
                        origin_lag_col="t_lag", dest_lag_col="arr_lag", lags=LAGS)
    return j.drop("station_ORIG", "station_DEST", "ts_ORIG", "ts_DEST")


SQL_J6_DUP = f"""WITH facts AS ({X.FACTS_SQL}), obs AS ({X.READINGS_SQL}),
y AS (SELECT f.*, CAST(h.range AS INTEGER) AS hours_lag, f.t - to_hours(CAST(h.range AS INTEGER)) AS t_lag,
             f.arr - to_hours(CAST(h.range AS INTEGER)) AS arr_lag FROM facts f CROSS JOIN range({LAGS}) h)
SELECT y.*, o.event_id AS event_id_ORIG, o.user_id AS user_id_ORIG, d.event_id AS event_id_DEST, d.user_id AS user_id_DEST
FROM y LEFT JOIN obs o ON o.station = y.origin AND o.ts = y.t_lag
       LEFT JOIN obs d ON d.station = y.dest AND d.ts = y.arr_lag"""


def _wide(spark, sf, match_station=True):
    f = X.facts(spark, sf)
    o = X.obs(spark, sf) if match_station else X.obs_hour(spark, sf)
    return L.lag_join_wide(f, o, origin_col="origin", origin_ts_col="t",
                           station_col="station", obs_ts_col="ts", dest_col="dest",
                           dest_ts_col="arr", lags=LAGS, match_station=match_station,
                           origin_part="t_part_{h}", dest_part="arr_part_{h}")


def _wide_sql(match_station: bool, src: str | None = None, carried: tuple[str, ...] = ("n", "v")) -> str:
    carried = [*(["station"] if match_station else []), "ts", *carried]
    src = src or (X.OBS_SQL if match_station else X.OBS_HOUR_SQL)
    sel = ["f.fact_id", "f.origin", "f.dest", "f.t", "f.arr"]
    sel += [f"f.t - to_hours({h}) AS t_part_{h}" for h in range(LAGS)]
    sel += [f"f.arr - to_hours({h}) AS arr_part_{h}" for h in range(LAGS)]
    joins = []
    for h in range(LAGS):
        sel += [f"o{h}.{c} AS {c}_Part_{h}" for c in carried]
        sel += [f"d{h}.{c} AS {c}_Dest_Part_{h}" for c in carried]
        so = f" AND o{h}.station = f.origin" if match_station else ""
        sd = f" AND d{h}.station = f.dest" if match_station else ""
        joins.append(f"LEFT JOIN obs o{h} ON o{h}.ts = f.t - to_hours({h}){so}")
        joins.append(f"LEFT JOIN obs d{h} ON d{h}.ts = f.arr - to_hours({h}){sd}")
    return (f"WITH facts AS ({X.FACTS_SQL}), obs AS ({src})\nSELECT " + ",\n       ".join(sel)
            + "\nFROM facts f\n" + "\n".join(joins))


def q_j7(spark, sf):
    return _wide(spark, sf, True)


def q_j7_time_only(spark, sf):
    return _wide(spark, sf, False)


SQL_READINGS = f"""SELECT station, ts, event_id, user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY station, ts ORDER BY event_id, user_id) AS k
  FROM ({X.READINGS_SQL})) WHERE k = 1"""


def q_j7_dup(spark, sf):
    return L.lag_join_wide(X.facts(spark, sf), X.readings(spark, sf), origin_col="origin", origin_ts_col="t",
                           station_col="station", obs_ts_col="ts", dest_col="dest", dest_ts_col="arr", lags=LAGS,
                           duplicates="first", origin_part="t_part_{h}", dest_part="arr_part_{h}")


def q_j6_stream(spark, sf):
    root = scratch_path(spark, "stream")
    return enrich_available(X.facts_stream(spark, sf), X.obs(spark, sf), root + "/out", root + "/checkpoint",
                            origin_col="origin", origin_ts_col="t", station_col="station", obs_ts_col="ts",
                            dest_col="dest", dest_ts_col="arr", origin_lag_col="t_lag", dest_lag_col="arr_lag",
                            lags=LAGS)


# --- P11 - P14 -------------------------------------------------------------------

def q_p13(spark, sf):
    e = X.table(spark, sf, "events").where(F.col("event_type") != "view")
    t = S.trunc_hour("ts")
    f = e.select(F.col("event_id").alias("fact_id"),
                 (F.col("user_id") % X.NATIONS).cast("string").alias("origin_id"),
                 (F.col("user_id") % X.DEST_MOD).cast("string").alias("dest_id"),
                 t.alias("t"), t.cast("date").alias("d"), F.col("value").alias("elapsed"))
    z = T.add_time_zones(f, X.stations(spark, sf), origin_col="origin_id", dest_col="dest_id")
    return L.map_facts(z, ts_col="t", elapsed_col="elapsed", delta_col="Delta_Lag",
                       origin_col="origin_id", dest_col="dest_id", date_col="d",
                       arrival_col="arr", origin_key_col="key_origin", dest_key_col="key_dest")


SQL_P13 = f"""WITH st AS ({X.STATIONS_SQL}),
f AS (SELECT event_id AS fact_id, CAST(user_id % {X.NATIONS} AS VARCHAR) AS origin_id,
             CAST(user_id % {X.DEST_MOD} AS VARCHAR) AS dest_id, date_trunc('hour', ts) AS t,
             CAST(date_trunc('hour', ts) AS DATE) AS d, value AS elapsed
      FROM events WHERE event_type <> 'view'),
z AS (SELECT f.*, CAST(de.TimeZone AS INTEGER) - CAST(og.TimeZone AS INTEGER) AS Delta_Lag
      FROM f JOIN st og ON f.origin_id = og.AirportID JOIN st de ON f.dest_id = de.AirportID),
a AS (SELECT z.*, 'FT' AS TAG,
             z.t + to_seconds(CAST(trunc(z.elapsed * 60) AS BIGINT) + CAST(trunc(z.Delta_Lag * 3600) AS BIGINT)) AS arr
      FROM z)
SELECT a.*, a.origin_id || '_' || CAST(a.d AS VARCHAR) AS key_origin,
       a.dest_id || '_' || CAST(a.arr AS VARCHAR) AS key_dest
FROM a"""


def q_p12(spark, sf):
    o = X.obs(spark, sf).withColumn("d", F.col("ts").cast("date"))
    return L.map_observations(o, station_col="station", date_col="d", key_col="obs_key")


SQL_P12 = f"""WITH obs AS ({X.OBS_SQL})
SELECT o.*, CAST(o.ts AS DATE) AS d, 'OT' AS TAG,
       CAST(o.station AS VARCHAR) || '_' || CAST(CAST(o.ts AS DATE) AS VARCHAR) AS obs_key
FROM obs o"""


# --- projections ----------------------------------------------------------------------

def q_p1_p2(spark, sf):
    return C.add_suffix(C.add_prefix(X.table(spark, sf, "orders"), "FT_"), "_ORIG")


SQL_P1_P2 = "SELECT " + ", ".join(f"{c} AS FT_{c}_ORIG" for c in X.ORDERS) + " FROM orders"


def q_p18(spark, sf):
    """Label, features and keys as training takes them: each once, in order."""
    x = X.delays(spark, sf)
    return C.select_columns(x, "FT_ARR_DELAY_NEW", ["FT_NAS_DELAY", "Year", "FT_ARR_DELAY_NEW", "l_orderkey", "Year"])


SQL_P18 = f"""WITH x AS ({X.DELAYS_SQL})
SELECT FT_ARR_DELAY_NEW, FT_NAS_DELAY, Year, l_orderkey FROM x"""


def q_p3(spark, sf):
    w = C.to_double_columns(X.raw_weather(spark, sf), ["StationType", "Visibility", "WindSpeed"])
    return w.select("ObsId", "StationType", "Visibility", "WindSpeed")


SQL_P3 = f"""WITH w AS ({X.RAW_WEATHER_TYPED_SQL})
SELECT ObsId, StationType, Visibility, WindSpeed FROM w"""


def q_p4_p7(spark, sf):
    r = X.raw_facts(spark, sf)
    clock = F.coalesce(S.hh_colon_mm("CRS_DEP_TIME"), F.lit(""))
    r = r.select("OP_CARRIER_FL_NUM", "FL_DATE", F.col("CRS_DEP_TIME").alias("raw_clock"),
                 clock.alias("clock"))
    return r.withColumn("dep_ts", S.fact_timestamp("FL_DATE", "clock"))


SQL_P4_P7 = f"""WITH r AS ({X.RAW_FACTS_SQL}),
p AS (SELECT OP_CARRIER_FL_NUM, FL_DATE, CRS_DEP_TIME AS raw_clock,
             lpad(CAST(CAST(trunc(TRY_CAST(CRS_DEP_TIME AS DOUBLE)) AS INTEGER) AS VARCHAR), 4, '0') AS p
      FROM r),
c AS (SELECT OP_CARRIER_FL_NUM, FL_DATE, raw_clock,
             coalesce(substr(p, 1, 2) || ':' || substr(p, 3, 2), '') AS clock FROM p)
SELECT c.*, try_strptime(CAST(FL_DATE AS VARCHAR) || ' ' || clock, '%Y-%m-%d %H:%M') AS dep_ts FROM c"""


def q_p8(spark, sf):
    w = X.raw_weather(spark, sf)
    return w.select("ObsId", "Date", F.lpad("Time", 4, "0").alias("Time"),
                    S.obs_timestamp("Date", "Time").alias("obs_ts"))


SQL_P8 = f"""WITH w AS ({X.RAW_WEATHER_TYPED_SQL})
SELECT ObsId, Date, lpad(Time, 4, '0') AS Time,
       try_strptime(CAST(Date AS VARCHAR) || ' ' || lpad(Time, 4, '0'), '%Y-%m-%d %H%M') AS obs_ts
FROM w"""


def q_f1(spark, sf):
    r = X.raw_facts(spark, sf)
    return C.drop_flagged_rows(r).select("OP_CARRIER_FL_NUM", "FL_DATE", "CANCELLED", "DIVERTED")


SQL_F1 = f"""WITH r AS ({X.RAW_FACTS_SQL})
SELECT OP_CARRIER_FL_NUM, FL_DATE, CANCELLED, DIVERTED FROM r
WHERE TRY_CAST(DIVERTED AS DOUBLE) <> 1 AND TRY_CAST(CANCELLED AS DOUBLE) <> 1"""


# --- station lookups / recipes ---------------------------------------------------------

def q_j1_j2(spark, sf):
    r = X.raw_facts(spark, sf).select("OP_CARRIER_FL_NUM", "ORIGIN_AIRPORT_ID",
                                        "DEST_AIRPORT_ID", "FL_DATE")
    return T.add_time_zones(r, X.stations(spark, sf), keep_zones=True)


SQL_J1_J2 = f"""WITH r AS ({X.RAW_FACTS_SQL}), st AS ({X.STATIONS_SQL})
SELECT r.OP_CARRIER_FL_NUM, r.ORIGIN_AIRPORT_ID, r.DEST_AIRPORT_ID, r.FL_DATE,
       og.TimeZone AS ORIGIN_TIME_ZONE, de.TimeZone AS DEST_TIME_ZONE,
       CAST(de.TimeZone AS INTEGER) - CAST(og.TimeZone AS INTEGER) AS Delta_Lag
FROM r JOIN st og ON r.ORIGIN_AIRPORT_ID = og.AirportID JOIN st de ON r.DEST_AIRPORT_ID = de.AirportID"""


def q_j3(spark, sf):
    w = X.raw_weather(spark, sf).select("ObsId", "WBAN", "Time")
    return T.join_stations(w, X.stations(spark, sf))


SQL_J3 = f"""WITH w AS ({X.RAW_WEATHER_TYPED_SQL}), st AS ({X.STATIONS_SQL})
SELECT w.WBAN, w.ObsId, w.Time, st.AirportID AS ORIGIN_AIRPORT_ID, st.TimeZone
FROM w JOIN st ON w.WBAN = st.WBAN"""


def q_q7(spark, sf):
    return _round(T.fact_table(X.raw_facts(spark, sf), X.stations(spark, sf)))


def _nz(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0 ELSE {c} END"


def _fact_table_sql(raw_sql: str) -> str:
    """Q7 in SQL over a raw fact source."""
    return f"""WITH r AS ({raw_sql}), st AS ({X.STATIONS_SQL}),
p AS (SELECT r.*, lpad(CAST(CAST(trunc(TRY_CAST(CRS_DEP_TIME AS DOUBLE)) AS INTEGER) AS VARCHAR), 4, '0') AS p
      FROM r),
c AS (SELECT OP_CARRIER_AIRLINE_ID, OP_CARRIER_FL_NUM, ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID,
             coalesce(substr(p, 1, 2) || ':' || substr(p, 3, 2), '') AS CRS_DEP_TIME,
             {_nz('ARR_DELAY_NEW')} AS ARR_DELAY_NEW,
             CAST(trunc(TRY_CAST(CANCELLED AS DOUBLE)) AS INTEGER) AS CANCELLED,
             CAST(trunc(TRY_CAST(DIVERTED AS DOUBLE)) AS INTEGER) AS DIVERTED,
             TRY_CAST(CRS_ELAPSED_TIME AS DOUBLE) AS CRS_ELAPSED_TIME,
             {_nz('TRY_CAST(WEATHER_DELAY AS DOUBLE)')} AS WEATHER_DELAY,
             {_nz('TRY_CAST(NAS_DELAY AS DOUBLE)')} AS NAS_DELAY,
             _c12, Year, FL_DATE
      FROM p),
t AS (SELECT c.*, try_strptime(CAST(FL_DATE AS VARCHAR) || ' ' || CRS_DEP_TIME, '%Y-%m-%d %H:%M') AS ts
      FROM c WHERE DIVERTED <> 1 AND CANCELLED <> 1)
SELECT t.OP_CARRIER_AIRLINE_ID AS FT_OP_CARRIER_AIRLINE_ID, t.OP_CARRIER_FL_NUM AS FT_OP_CARRIER_FL_NUM,
       t.ORIGIN_AIRPORT_ID AS FT_ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID AS FT_DEST_AIRPORT_ID,
       t.CRS_DEP_TIME AS FT_CRS_DEP_TIME, t.ARR_DELAY_NEW AS FT_ARR_DELAY_NEW,
       t.CRS_ELAPSED_TIME AS FT_CRS_ELAPSED_TIME, t.WEATHER_DELAY AS FT_WEATHER_DELAY,
       t.NAS_DELAY AS FT_NAS_DELAY, t._c12 AS FT__c12, t.Year AS FT_Year, t.FL_DATE AS FT_FL_DATE,
       t.ts AS FT_TIMESTAMP,
       CAST(de.TimeZone AS INTEGER) - CAST(og.TimeZone AS INTEGER) AS FT_Delta_Lag
FROM t JOIN st og ON t.ORIGIN_AIRPORT_ID = og.AirportID JOIN st de ON t.DEST_AIRPORT_ID = de.AirportID"""


FT_DOUBLES = ["FT_ARR_DELAY_NEW", "FT_CRS_ELAPSED_TIME", "FT_WEATHER_DELAY", "FT_NAS_DELAY"]
SQL_Q7 = _sql_round(_fact_table_sql(X.RAW_FACTS_SQL), FT_DOUBLES)


def _missing(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))"


_NARROW = ("StationType", "Visibility", "WindSpeed")     # numeric columns of the narrow feed
_NARROW_MEANS, _NARROW_MODES = ("Visibility", "WindSpeed"), ("SkyCondition", "WeatherType")
_FULL_MEANS = tuple(m for m in T.OBS_NUMERIC if m != "StationType")


def _imputed_cte(raw_sql: str, numeric=_NARROW) -> str:
    """Typed raw weather after Q3 imputation."""
    stats = ",\n              ".join(
        f"count(*) FILTER (WHERE {_missing(c)}) AS m_{c}, avg({c}) FILTER (WHERE NOT {_missing(c)}) AS a_{c}" for c in numeric)
    fills = ",\n          ".join(
        f"CASE WHEN {_missing(c)} AND CAST(m_{c} AS DOUBLE) / n < 0.2 THEN a_{c} ELSE {c} END AS {c}" for c in numeric)
    return f"""raw AS ({raw_sql}),
s1 AS (SELECT count(*) AS n,
              {stats}
       FROM raw),
imp AS (SELECT raw.* REPLACE (
          {fills})
        FROM raw, s1)"""


_IMPUTED_CTE = _imputed_cte(X.RAW_WEATHER_TYPED_SQL)


def _corrected_cte(src: str, means=_NARROW_MEANS, modes=_NARROW_MODES) -> str:
    """After Q4 / Q5: means and modes of unflagged rows."""
    avgs = ", ".join(f"avg({c}) FILTER (WHERE {c}Flag <> 's') AS m_{c}" for c in means)
    tops = ",\n".join(f"""top_{c} AS (SELECT {c} AS v FROM {src} WHERE {c}Flag <> 's' GROUP BY 1
       ORDER BY count(*) DESC, v ASC NULLS FIRST LIMIT 1)""" for c in modes)
    fixes = [f"CASE WHEN {c}Flag = 's' THEN coalesce(means.m_{c}, {c}) ELSE {c} END AS {c}" for c in means]
    fixes += [f"CASE WHEN {c}Flag = 's' THEN (SELECT v FROM top_{c}) ELSE {c} END AS {c}" for c in modes]
    return f"""means AS (SELECT {avgs} FROM {src}),
{tops},
fix AS (SELECT {src}.* REPLACE (
          {", ".join(fixes)})
        FROM {src}, means)"""


_PAIRS = (["Visibility", "WindSpeed", "SkyCondition", "WeatherType"],
          ["VisibilityFlag", "WindSpeedFlag", "SkyConditionFlag", "WeatherTypeFlag"])


def _typed_weather(spark, sf):
    return C.to_double_columns(X.raw_weather(spark, sf), ["StationType", "Visibility", "WindSpeed"])


def q_q6(spark, sf):
    return _round(T.observation_table(X.full_weather(spark, sf), X.stations(spark, sf)))


def _obs_table_sql(raw_sql: str) -> str:
    """Q6 in SQL over a typed raw observation source with all measures."""
    measures = ", ".join(f"f.{m} AS OT_{m}" for m in ("StationType", *T.OBS_MEASURES))
    return f"""WITH {_imputed_cte(raw_sql, T.OBS_NUMERIC)}, {_corrected_cte('imp', _FULL_MEANS, T.OBS_TEXT_MEASURES)},
st AS ({X.STATIONS_SQL})
SELECT f.WBAN AS OT_WBAN, f.ObsId AS OT_ObsId, lpad(f.Time, 4, '0') AS OT_Time, {measures},
       f.Year AS OT_Year, f.Date AS OT_Date,
       try_strptime(CAST(f.Date AS VARCHAR) || ' ' || lpad(f.Time, 4, '0'), '%Y-%m-%d %H%M') AS OT_WEATHER_TIMESTAMP,
       st.AirportID AS OT_ORIGIN_AIRPORT_ID, st.TimeZone AS OT_TimeZone
FROM fix f JOIN st ON f.WBAN = st.WBAN"""


OT_DOUBLES = [f"OT_{m}" for m in T.OBS_NUMERIC]
OT_TEXTS = [f"OT_{m}" for m in T.OBS_TEXT_MEASURES]
SQL_Q6 = _sql_round(_obs_table_sql(X.full_weather_typed_sql()), OT_DOUBLES)


def q_q3(spark, sf):
    w = _typed_weather(spark, sf)
    return _round(Q.impute_mean(w, 0.20).select("ObsId", "StationType", "Visibility", "WindSpeed"))


SQL_Q3 = _sql_round(f"""WITH {_IMPUTED_CTE}
SELECT ObsId, StationType, Visibility, WindSpeed FROM imp""", ["StationType", "Visibility", "WindSpeed"])


def q_q4_q5(spark, sf):
    w = _typed_weather(spark, sf)
    out = Q.correct_by_flag(w, *_PAIRS)
    return _round(out.select("ObsId", *_PAIRS[0]))


SQL_Q4_Q5 = _sql_round(f"""WITH raw AS ({X.RAW_WEATHER_TYPED_SQL}), {_corrected_cte('raw')}
SELECT ObsId, Visibility, WindSpeed, SkyCondition, WeatherType FROM fix""",
                       ["Visibility", "WindSpeed"])


def q_a6(spark, sf):
    return _round(Q.mean_where(_typed_weather(spark, sf), "WindSpeed", "WindSpeedFlag"))


SQL_A6 = _sql_round(f"""WITH w AS ({X.RAW_WEATHER_TYPED_SQL})
SELECT avg(WindSpeed) FILTER (WHERE WindSpeedFlag <> 's') AS mean FROM w""", ["mean"])


def q_a7(spark, sf):
    return Q.mode_where(X.raw_weather(spark, sf), "WeatherType", "WeatherTypeFlag")


SQL_A7 = f"""WITH w AS ({X.RAW_WEATHER_TYPED_SQL})
SELECT WeatherType AS value, count(*) AS count FROM w WHERE WeatherTypeFlag <> 's'
GROUP BY 1 ORDER BY count(*) DESC, value ASC NULLS FIRST LIMIT 1"""


def q_o1(spark, sf):
    return C.top_value(X.raw_weather(spark, sf), "SkyCondition")


SQL_O1 = f"""WITH w AS ({X.RAW_WEATHER_TYPED_SQL})
SELECT SkyCondition, count(*) AS count FROM w
GROUP BY 1 ORDER BY count(*) DESC, SkyCondition ASC NULLS FIRST LIMIT 1"""


# --- reports -------------------------------------------------------------------------------

def q_q1(spark, sf):
    return _round(Q.missing_report(X.raw_weather(spark, sf)))


def _missing_sql(src: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for c, kind in cols:
        pred = {"double": f'"{c}" IS NULL OR isnan("{c}")', "string": f"\"{c}\" IS NULL OR \"{c}\" = ''",
                "other": f'"{c}" IS NULL'}[kind]
        parts.append(f"""SELECT '{c}' AS "Column", count(*) FILTER (WHERE {pred}) AS Missing_values,
       CAST(count(*) FILTER (WHERE {pred}) AS DOUBLE) / count(*) * 100 AS Pct_missing_values FROM src""")
    return _sql_round(f"WITH src AS ({src})\n" + "\nUNION ALL\n".join(parts), ["Pct_missing_values"])


_WEATHER_COLS = [("ObsId", "other"), ("WBAN", "string"), ("Time", "string"),
                 ("StationType", "string"), ("SkyCondition", "string"),
                 ("SkyConditionFlag", "string"), ("Visibility", "string"),
                 ("VisibilityFlag", "string"), ("WeatherType", "string"),
                 ("WeatherTypeFlag", "string"), ("WindSpeed", "string"),
                 ("WindSpeedFlag", "string"), ("Year", "other"), ("Date", "other")]
SQL_Q1 = _missing_sql(X.RAW_WEATHER_TEXT_SQL, _WEATHER_COLS)


def q_q1_docs(spark, sf):
    d = X.table(spark, sf, "documents").join(X.table(spark, sf, "labels"), "doc_id", "left")
    return _round(Q.missing_report(d))


SQL_Q1_DOCS = _missing_sql(
    "SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    [("doc_id", "other"), ("text", "string"), ("lang", "string"), ("source", "string"),
     ("n_chars", "other"), ("quality", "other"), ("toxic", "other")])


def q_q2(spark, sf):
    return Q.flag_report(X.raw_weather(spark, sf))


SQL_Q2 = f"WITH w AS ({X.RAW_WEATHER_TEXT_SQL})\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS FlagColumn, count(*) FILTER (WHERE {c} = 's') AS Count FROM w"
    for c in ["SkyConditionFlag", "VisibilityFlag", "WeatherTypeFlag", "WindSpeedFlag"])


def q_a1(spark, sf):
    return A.airport_summary(X.raw_facts(spark, sf))


SQL_A1 = f"""WITH r AS ({X.RAW_FACTS_SQL})
SELECT ORIGIN_AIRPORT_ID, count(OP_CARRIER_FL_NUM) AS "nbs de vols",
       count(DISTINCT OP_CARRIER_AIRLINE_ID) AS nbs_compagnies,
       count(DISTINCT DEST_AIRPORT_ID) AS nbs_aeroports_dest
FROM r GROUP BY ORIGIN_AIRPORT_ID"""


def q_a2(spark, sf):
    return _round(A.carrier_performance(X.raw_facts(spark, sf), on_time=15))


SQL_A2 = _sql_round(f"""WITH r AS ({X.RAW_FACTS_SQL}),
g AS (SELECT Year AS year, count(OP_CARRIER_FL_NUM) AS nv,
             count(*) FILTER (WHERE ARR_DELAY_NEW <= 15) AS o,
             count(*) FILTER (WHERE ARR_DELAY_NEW >= 15) AS d,
             count(*) FILTER (WHERE TRY_CAST(CANCELLED AS DOUBLE) = 1) AS c,
             count(*) FILTER (WHERE TRY_CAST(DIVERTED AS DOUBLE) = 1) AS v
      FROM r GROUP BY Year)
SELECT year, nv AS "nbs de vol",
       CAST(o AS DOUBLE) / nullif(o + d + c + v, 0) * 100 AS "% On-time",
       CAST(d AS DOUBLE) / nullif(o + d + c + v, 0) * 100 AS "% Delayed",
       CAST(c AS DOUBLE) / nullif(o + d + c + v, 0) * 100 AS "% Cancelled",
       CAST(v AS DOUBLE) / nullif(o + d + c + v, 0) * 100 AS "% Diverted"
FROM g""", ["% On-time", "% Delayed", "% Cancelled", "% Diverted"])


def q_a3(spark, sf):
    return _round(A.delay_breakdown(X.raw_facts(spark, sf)))


SQL_A3 = _sql_round(f"""WITH r AS ({X.RAW_FACTS_SQL}),
g AS (SELECT Year AS year, sum(ARR_DELAY_NEW) AS a, sum(TRY_CAST(WEATHER_DELAY AS DOUBLE)) AS w,
             sum(TRY_CAST(NAS_DELAY AS DOUBLE)) AS n
      FROM r WHERE ARR_DELAY_NEW <> 0 GROUP BY Year)
SELECT year, w / nullif(a, 0) * 100 AS "% Weather_delay", n / nullif(a, 0) * 100 AS "% Nas_delay",
       (a - (n + w)) / nullif(a, 0) * 100 AS "% Other_delay"
FROM g""", ["% Weather_delay", "% Nas_delay", "% Other_delay"])


def q_a5(spark, sf):
    return A.row_count(X.table(spark, sf, "events"))


SQL_A5 = "SELECT count(*) AS row_count FROM events"


# --- aligned pairs ---------------------------------------------------------------------------

def _pair(spark, sf):
    f = X.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("FL_DATE"))
    o = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                              F.col("l_shipdate").cast("date").alias("Date"))
    return f, o


def q_s9(spark, sf):
    f, o = _pair(spark, sf)
    return P.align_pair(f, o)[2]


_PAIR_CTE = """f AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
o AS (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem),
b AS (SELECT greatest((SELECT min(d) FROM f), (SELECT min(d) FROM o)) AS lo,
             least((SELECT max(d) FROM f), (SELECT max(d) FROM o)) AS hi)"""

SQL_S9 = f"""WITH {_PAIR_CTE}
SELECT min(d) AS min_date, max(d) AS max_date, count(*) AS size, 'fact_initial' AS dataset FROM f
UNION ALL SELECT min(d), max(d), count(*), 'weather_initial' FROM o
UNION ALL SELECT min(d), max(d), count(*), 'fact_filtered' FROM f, b WHERE d BETWEEN lo AND hi
UNION ALL SELECT min(d), max(d), count(*), 'weather_filtered' FROM o, b WHERE d BETWEEN lo AND hi"""


def q_f2(spark, sf):
    f, o = _pair(spark, sf)
    return P.align_pair(f, o)[0]


SQL_F2 = f"""WITH {_PAIR_CTE}
SELECT o_orderkey, d AS FL_DATE FROM f, b WHERE d BETWEEN lo AND hi"""


def q_s10(spark, sf):
    f, o = _pair(spark, sf)
    return P.load_stats(f.withColumnRenamed("FL_DATE", "FT_FL_DATE"),
                        o.withColumnRenamed("Date", "FT_FL_DATE"), "FT_FL_DATE")


SQL_S10 = f"""WITH {_PAIR_CTE}
SELECT min(d) AS min_date, max(d) AS max_date, count(*) AS size, 'fact_initial' AS dataset FROM f
UNION ALL SELECT min(d), max(d), count(*), 'weather_initial' FROM o"""


# --- datasets ---------------------------------------------------------------------------------

_DS_SQL = {"DS1": "a >= 15 AND a = w + n", "DS2": "a >= 15 AND (w > 0 OR n >= 15)",
           "DS3": "a >= 15 AND w + n > 0", "DS4": "a >= 15"}


def _q_ds(ds):
    def q(spark, sf):
        d = X.delays(spark, sf)
        return d.where(D.delayed_condition(ds, 15)).withColumn(D.LABEL_COL, F.lit(D.DELAYED_LABEL))
    return q


def _ds_sql(cond: str, label: int) -> str:
    return f"""WITH x AS ({X.DELAYS_SQL}),
y AS (SELECT x.*, FT_ARR_DELAY_NEW AS a, FT_WEATHER_DELAY AS w, FT_NAS_DELAY AS n FROM x)
SELECT l_orderkey, l_linenumber, Year, FT_ARR_DELAY_NEW, FT_WEATHER_DELAY, FT_NAS_DELAY,
       {label} AS FT_OnTime FROM y WHERE {cond}"""


def q_d5(spark, sf):
    d = X.delays(spark, sf)
    return d.where(D.on_time_condition(1.0)).withColumn(D.LABEL_COL, F.lit(D.ON_TIME_LABEL))


def q_d7_d8(spark, sf):
    k = X.keyed_delays(spark, sf)
    parts = D.labelled_datasets(k, "DS4", 80, 20, key_cols=["event_id"], balance="exact")
    names = ["delayed_train", "delayed_test", "ontime_train", "ontime_test"]
    return C.union_all([p.withColumn("part", F.lit(n)) for p, n in zip(parts, names)])


def _bucket_sql(k: str) -> str:
    return f"(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 100)"


SQL_D7_D8 = f"""WITH k AS ({X.KEYED_DELAYS_SQL}),
d AS (SELECT k.*, 0 AS FT_OnTime FROM k WHERE FT_ARR_DELAY_NEW >= 80),
o AS (SELECT k.*, 1 AS FT_OnTime FROM k WHERE FT_ARR_DELAY_NEW <= 20),
ob AS (SELECT * EXCLUDE (rn) FROM (SELECT o.*, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS rn FROM o)
       WHERE rn <= (SELECT count(*) FROM d))
SELECT d.*, CASE WHEN {_bucket_sql('event_id')} < 75 THEN 'delayed_train' ELSE 'delayed_test' END AS part FROM d
UNION ALL
SELECT ob.*, CASE WHEN {_bucket_sql('event_id')} < 75 THEN 'ontime_train' ELSE 'ontime_test' END AS part FROM ob"""


def q_d7_approx(spark, sf):
    k = X.keyed_delays(spark, sf)
    parts = D.labelled_datasets(k, "DS4", 80, 20, key_cols=["event_id"], balance="approx")
    names = ["delayed_train", "delayed_test", "ontime_train", "ontime_test"]
    return C.union_all([p.withColumn("part", F.lit(n)) for p, n in zip(parts, names)])


SQL_D7_APPROX = SQL_D7_D8[:SQL_D7_D8.index("ob AS (")] + f"""ob AS (SELECT o.* FROM o
       WHERE (SELECT count(*) FROM o) <= (SELECT count(*) FROM d)
          OR ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT
             < CAST(floor((SELECT count(*) FROM d)::DOUBLE / (SELECT count(*) FROM o) * 4294967296) AS BIGINT))
""" + SQL_D7_D8[SQL_D7_D8.index("SELECT d.*, CASE"):]


def q_d7_equal_rows(spark, sf):
    """Rows without a key, many of them identical: exactly as many on-time
    rows as delayed ones, each equal to one of the input."""
    k = X.keyed_delays(spark, sf).select(*[F.floor(F.col(c) / 40).cast("double").alias(c) for c in D.DELAY_COLUMNS])
    parts = D.labelled_datasets(k, "DS4", 2, 1, balance="exact")
    return C.union_all(parts).groupBy(D.LABEL_COL).agg(F.count(F.lit(1)).alias("row_count"),
                                                       F.max("FT_ARR_DELAY_NEW").alias("most"))


SQL_D7_EQUAL_ROWS = f"""WITH k AS ({X.KEYED_DELAYS_SQL}), f AS (SELECT floor(FT_ARR_DELAY_NEW / 40) AS a FROM k),
c AS (SELECT count(*) FILTER (WHERE a >= 2) AS d, count(*) FILTER (WHERE a <= 1) AS o FROM f)
SELECT 0 AS FT_OnTime, d AS row_count, (SELECT max(a) FROM f WHERE a >= 2) AS most FROM c
UNION ALL SELECT 1, least(d, o), (SELECT max(a) FROM f WHERE a <= 1) FROM c"""


def _w3_joined(spark, sf):
    """The long join of facts that carry their delays, written and reloaded."""
    root = scratch_path(spark, "w3")
    facts = X.facts(spark, sf).join(X.keyed_delays(spark, sf).withColumnRenamed("event_id", "fact_id"), "fact_id")
    lines = L.lag_join_long(facts, X.obs(spark, sf), origin_col="origin", origin_ts_col="t", station_col="station",
                            obs_ts_col="ts", dest_col="dest", dest_ts_col="arr", origin_lag_col="t_lag",
                            dest_lag_col="arr_lag", lags=LAGS)
    K.store_results(lines.withColumns({"FT_Year": F.year("t"), "FT_FL_DATE": F.col("t").cast("date")}), root)
    return P.read_joined(spark, None, root, mode="lines")[1]


def q_w3(spark, sf):
    """Datasets from the joined table: all lag rows of a fact in one part."""
    out = D.grouped_datasets(_w3_joined(spark, sf), "DS4", 80, 40, group_cols=["fact_id"])
    return out.select("fact_id", "hours_lag", "v_ORIG", "v_DEST", "FT_ARR_DELAY_NEW", D.LABEL_COL, "part")


SQL_W3 = f"""WITH j AS ({_long_sql(True)}), k AS ({X.KEYED_DELAYS_SQL}),
x AS (SELECT j.fact_id, j.hours_lag, j.v_ORIG, j.v_DEST, k.FT_ARR_DELAY_NEW,
             CASE WHEN k.FT_ARR_DELAY_NEW >= 80 THEN 0 WHEN k.FT_ARR_DELAY_NEW <= 40 THEN 1 END AS FT_OnTime
      FROM j JOIN k ON j.fact_id = k.event_id),
g AS (SELECT DISTINCT fact_id, FT_OnTime, md5(CAST(fact_id AS VARCHAR)) AS m FROM x WHERE FT_OnTime IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY FT_OnTime ORDER BY m) AS k FROM g),
b AS (SELECT * FROM r WHERE k <= (SELECT min(n) FROM (SELECT count(*) AS n FROM g GROUP BY FT_OnTime))),
s AS (SELECT fact_id, row_number() OVER (PARTITION BY FT_OnTime ORDER BY substr(m, 17, 16) || substr(m, 1, 16)) AS k,
             count(*) OVER (PARTITION BY FT_OnTime) AS n FROM b)
SELECT x.*, CASE WHEN s.k <= greatest(1, s.n * 75 // 100) THEN 'train' ELSE 'test' END AS part
FROM x JOIN s ON x.fact_id = s.fact_id WHERE x.FT_OnTime IS NOT NULL"""


def q_s5(spark, sf):
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return I.sample_rows(o, 0.3, key_cols=["o_orderkey"])


SQL_S5 = f"""SELECT o_orderkey, o_custkey FROM orders
WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < {int(0.3 * (1 << 32))}"""


# --- sources / sinks round trips -----------------------------------------------------------

def q_s1_s6(spark, sf):
    """Raw fact rows -> CSV text -> all-string scan -> ingest -> date
    partitioned parquet -> scan -> per-year summary."""
    root = scratch_path(spark, "ingest")
    X.raw_facts(spark, sf).write.mode("overwrite").option("header", "true").csv(root + "/csv")
    raw = I.read_csv(spark, root + "/csv")
    I.write_partitioned(I.ingest_facts(raw.drop("Year")), root + "/parquet", I.FACT_PARTITIONS)
    back = P.read_parquet(spark, root + "/parquet")
    return _round(back.groupBy("Year").agg(F.count(F.lit(1)).alias("row_count"),
                                           F.sum("ARR_DELAY_NEW").alias("delay"),
                                           F.countDistinct("FL_DATE").alias("dates"),
                                           F.count("CRS_DEP_TIME").alias("clocks")))


SQL_S1_S6 = _sql_round(f"""WITH r AS ({X.RAW_FACTS_SQL})
SELECT Year, count(*) AS row_count, sum(ARR_DELAY_NEW) AS delay, count(DISTINCT FL_DATE) AS dates,
       count(CRS_DEP_TIME) AS clocks
FROM r GROUP BY Year""", ["delay"])


def q_s2_s4(spark, sf):
    """Raw observation text with yyyyMMdd dates -> text scan -> ingest ->
    (Year, Date) partitions -> scan -> per-day summary."""
    root = scratch_path(spark, "obs")
    w = X.raw_weather(spark, sf).drop("Year").withColumn("Date", F.date_format("Date", "yyyyMMdd"))
    w.write.mode("overwrite").option("header", "true").csv(root + "/txt")
    raw = I.read_csv(spark, root + "/txt")
    I.write_partitioned(I.ingest_observations(raw), root + "/parquet", I.OBS_PARTITIONS)
    back = P.read_parquet(spark, root + "/parquet")
    return back.groupBy("Year", "Date").agg(F.count(F.lit(1)).alias("row_count"),
                                            F.count("Visibility").alias("vis"))


SQL_S2_S4 = f"""WITH w AS ({X.RAW_WEATHER_TEXT_SQL})
SELECT Year, Date, count(*) AS row_count, count(Visibility) AS vis FROM w GROUP BY Year, Date"""


def q_s6_incremental(spark, sf):
    """Two loads that overlap by days, the second one twice: it replaces its
    own days and no others."""
    root = scratch_path(spark, "incremental")
    e = X.table(spark, sf, "events").select("event_id", "value", F.col("ts").cast("date").alias("Date")).withColumn(
        "Year", F.year("Date"))
    first = e.where(F.dayofmonth("Date") <= 20).withColumn("load", F.lit(1))
    second = e.where(F.dayofmonth("Date") >= 10).withColumn("load", F.lit(2)).where(F.col("event_id") % 3 != 0)
    for load in (first, second, second):
        I.write_partitioned(load, root, I.OBS_PARTITIONS, mode="days")
    return P.read_parquet(spark, root).select("event_id", "value", "Date", "load")


SQL_S6_INCREMENTAL = """WITH e AS (SELECT event_id, value, CAST(ts AS DATE) AS Date FROM events),
second AS (SELECT *, 2 AS load FROM e WHERE day(Date) >= 10 AND event_id % 3 <> 0)
SELECT * FROM second
UNION ALL SELECT *, 1 AS load FROM e WHERE day(Date) <= 20 AND Date NOT IN (SELECT Date FROM second)"""


def q_s1_rejected(spark, sf):
    """Orders as text lines, some ragged: rows and rejected lines."""
    root = scratch_path(spark, "ragged")
    k = F.col("o_orderkey")
    line = F.when(k % 31 == 0, F.concat_ws(",", "o_orderkey", "o_custkey")).when(
        k % 37 == 0, F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.lit("extra"))).otherwise(
        F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus"))
    X.table(spark, sf, "orders").select(line.alias("value")).write.text(root)
    rows, rejected = I.read_csv_checked(spark, root, ["o_orderkey", "o_custkey", "o_orderstatus"])
    return rows.withColumn("line", F.lit(None).cast("string")).unionByName(
        rejected.select("line"), allowMissingColumns=True)


SQL_S1_REJECTED = """SELECT CASE WHEN ok THEN CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
       CASE WHEN ok THEN CAST(o_custkey AS VARCHAR) END AS o_custkey, CASE WHEN ok THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 31 = 0 THEN o_orderkey || ',' || o_custkey
            WHEN o_orderkey % 37 = 0 THEN o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',extra' END AS line
FROM (SELECT *, o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0 AS ok FROM orders)"""


def q_s10_reload(spark, sf):
    """The joined pair written, read back unaligned with its statistics as a
    CSV report, which is read back too."""
    root = scratch_path(spark, "pair")
    f, o = _pair(spark, sf)
    f.withColumnRenamed("FL_DATE", "FT_FL_DATE").write.parquet(root + "/f")
    o.withColumnRenamed("Date", "FT_FL_DATE").write.parquet(root + "/o")
    P.read_pair(spark, root + "/f", root + "/o", aligned=False, stats_csv=root + "/stats.csv")
    back = spark.read.option("header", "true").csv(root + "/stats.csv")
    return back.select(F.col("min_date").cast("date").alias("min_date"), F.col("max_date").cast("date").alias("max_date"),
                       F.col("size").cast("long").alias("size"), "dataset")


def q_s12_s11(spark, sf):
    """Long lag join -> partitioned result sink -> reload ('lines') ->
    per-day summary."""
    root = scratch_path(spark, "joined")
    j = q_j6(spark, sf).withColumns({"FT_Year": F.year("t"), "FT_FL_DATE": F.col("t").cast("date")})
    K.store_results(j, root + "/lines")
    _, lines = P.read_joined(spark, None, root + "/lines", mode="lines")
    return _round(lines.groupBy("FT_FL_DATE").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("v_ORIG").alias("hits_orig"),
        F.count("v_DEST").alias("hits_dest"), F.sum("n_ORIG").alias("n_orig")))


SQL_S12_S11 = f"""WITH j AS ({_long_sql(True)})
SELECT CAST(t AS DATE) AS FT_FL_DATE, count(*) AS row_count, count(v_ORIG) AS hits_orig,
       count(v_DEST) AS hits_dest, CAST(sum(n_ORIG) AS BIGINT) AS n_orig
FROM j GROUP BY 1"""


def q_s13(spark, sf):
    """Airport report -> single-file CSV -> scan back."""
    root = scratch_path(spark, "report")
    K.write_report_csv(q_a1(spark, sf), root + "/airports.csv")
    back = spark.read.option("header", "true").csv(root + "/airports.csv")
    return back.select("ORIGIN_AIRPORT_ID", *[F.col(f"`{c}`").cast("long").alias(c)
                                              for c in A.AIRPORT_HEADER])


def q_s3(spark, sf):
    """Station lookup -> CSV -> all-string scan -> lookup join."""
    root = scratch_path(spark, "lookup")
    X.stations(spark, sf).write.mode("overwrite").option("header", "true").csv(root)
    w = X.raw_weather(spark, sf).select("ObsId", "WBAN", "Time")
    return T.join_stations(w, I.read_csv(spark, root))


def q_s15(spark, sf):
    """Classification metrics -> metrics.csv -> scan back as (metric, value)."""
    root = scratch_path(spark, "metrics")
    m = M.classification_metrics(_rule_predictions(spark, sf), "label", "prediction")
    K.write_metrics_csv(spark, m, root)
    back = spark.read.option("header", "true").csv(root + "/metrics.csv")
    return _round(back.select("metric", F.col("value").cast("double").alias("value")))


def _sql_s15() -> str:
    return f"""WITH m AS ({SQL_M8})
SELECT 'accuracy' AS metric, accuracy AS value FROM m
UNION ALL SELECT 'f1Score', f1Score FROM m
UNION ALL SELECT 'recall', recall FROM m
UNION ALL SELECT 'precision', precision FROM m"""


def q_a4(spark, sf):
    return A.range_stats(X.table(spark, sf, "events"), "ts", "events")


SQL_A4 = """SELECT min(ts) AS min_date, max(ts) AS max_date, count(*) AS size, 'events' AS dataset
FROM events"""


def q_a8(spark, sf):
    return X.table(spark, sf, "orders").select("o_orderpriority").distinct()


SQL_A8 = "SELECT DISTINCT o_orderpriority FROM orders"


# --- ML ----------------------------------------------------------------------------------

def _orders_with_gaps(spark, sf):
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")))


def q_m1(spark, sf):
    return M.index_strings(_orders_with_gaps(spark, sf), ["o_orderpriority", "o_orderstatus"], "keep")


def _rank_sql(col: str, src: str) -> str:
    """Value, index, and the index of NULL."""
    return (f"SELECT {col} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS i, "
            f"CAST(count(*) OVER () AS DOUBLE) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}")


SQL_M1 = f"""WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders),
p AS ({_rank_sql('o_orderpriority', 'g')}), s AS ({_rank_sql('o_orderstatus', 'g')})
SELECT g.o_orderkey, coalesce(p.i, (SELECT max(n) FROM p)) AS o_orderpriority, coalesce(s.i, (SELECT max(n) FROM s)) AS o_orderstatus
FROM g LEFT JOIN p ON g.o_orderpriority = p.v LEFT JOIN s ON g.o_orderstatus = s.v"""


def q_m1_many(spark, sf):
    """About as many values as orders, and rows without one."""
    r = X.raw_facts(spark, sf).select("FL_DATE", F.col("OP_CARRIER_FL_NUM").alias("number"), "OP_CARRIER_FL_NUM")
    return M.index_strings(r, ["OP_CARRIER_FL_NUM"], "keep")


SQL_M1_MANY = f"""WITH r AS ({X.RAW_FACTS_SQL}), p AS ({_rank_sql('OP_CARRIER_FL_NUM', 'r')})
SELECT r.FL_DATE, r.OP_CARRIER_FL_NUM AS number, coalesce(p.i, (SELECT max(n) FROM p)) AS OP_CARRIER_FL_NUM
FROM r LEFT JOIN p ON r.OP_CARRIER_FL_NUM = p.v"""


def q_m2(spark, sf):
    e = X.table(spark, sf, "events").select("event_id", "ts")
    return M.dates_to_epoch(e, ["ts"])


SQL_M2 = "SELECT event_id, CAST(floor(epoch(ts)) AS DOUBLE) AS ts FROM events"


def q_m4(spark, sf):
    s = X.scored(spark, sf).select("doc_id", "label")
    return M.label_indexer("label").fit(s).transform(s)


SQL_M4 = f"""WITH s AS ({X.SCORED_SQL}),
r AS (SELECT CAST(label AS VARCHAR) AS v,
             CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(label AS VARCHAR)) - 1 AS DOUBLE) AS i
      FROM s GROUP BY 1)
SELECT s.doc_id, s.label, r.i AS indexedLabel FROM s JOIN r ON CAST(s.label AS VARCHAR) = r.v"""


def _rule_predictions(spark, sf):
    s = X.scored(spark, sf)
    return s.select("doc_id", F.col("label").cast("double").alias("label"),
                    F.when(F.col("n_chars") > 1000, 1.0).otherwise(0.0).alias("prediction"))


def q_m8(spark, sf):
    p = _rule_predictions(spark, sf)
    m = M.classification_metrics(p, "label", "prediction")
    names = list(M.EVALUATOR_METRICS)
    return _round(spark.createDataFrame([tuple(m[k] for k in names)],
                                        ", ".join(f"{k} double" for k in names)))


def q_m8_confusion(spark, sf):
    return _round(M.confusion_metrics(_rule_predictions(spark, sf), "label", "prediction"))


SQL_M8 = _sql_round(f"""WITH s AS ({X.SCORED_SQL}),
p AS (SELECT CAST(label AS DOUBLE) AS l, CASE WHEN n_chars > 1000 THEN 1.0 ELSE 0.0 END AS p FROM s),
cls AS (SELECT l, count(*) AS n_l, count(*) FILTER (WHERE l = p) AS tp FROM p GROUP BY l),
prd AS (SELECT p AS l, count(*) AS n_p FROM p GROUP BY p),
tot AS (SELECT count(*) AS total FROM p),
per AS (SELECT c.n_l, c.tp, coalesce(r.n_p, 0) AS n_p, tot.total,
               CASE WHEN coalesce(r.n_p, 0) > 0 THEN CAST(c.tp AS DOUBLE) / r.n_p ELSE 0.0 END AS prec,
               CAST(c.tp AS DOUBLE) / c.n_l AS rec
        FROM cls c LEFT JOIN prd r ON c.l = r.l, tot)
SELECT CAST(sum(tp) AS DOUBLE) / max(total) AS accuracy,
       sum(CAST(n_l AS DOUBLE) / total * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) AS f1Score,
       sum(CAST(n_l AS DOUBLE) / total * rec) AS recall,
       sum(CAST(n_l AS DOUBLE) / total * prec) AS precision
FROM per""", ["accuracy", "f1Score", "recall", "precision"])


def q_m9(spark, sf):
    s = X.scored(spark, sf).select(F.col("label").cast("double").alias("label"),
                                   F.col("n_chars").cast("double").alias("score"))
    auc = M.area_under_roc(s, "label", "score")
    return _round(spark.createDataFrame([(auc,)], "auc double"))


SQL_M9 = _sql_round(f"""WITH s AS ({X.SCORED_SQL}),
r AS (SELECT label, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS mr
      FROM s),
c AS (SELECT count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg,
             sum(mr) FILTER (WHERE label = 1) AS rs FROM r)
SELECT CAST((rs - pos * (pos + 1) / 2.0) / (pos * neg) AS DOUBLE) AS auc FROM c""", ["auc"])


def q_m6(spark, sf):
    s = X.scored(spark, sf).select("doc_id", "label", "n_chars", "lang", "source")
    raw_train, raw_test = D.train_test_split(s, ["doc_id"], 75)
    train, test = (M.prepare_features(p, "label", "keep", fit_on=raw_train) for p in (raw_train, raw_test))
    _, pred, _ = M.train_random_forest(train, test, "label", ["n_chars", "lang", "source"],
                                       num_trees=20, max_depth=5, seed=42, keep=["doc_id"])
    return pred.select("doc_id", "label", "prediction")


def q_m5(spark, sf):
    """Index, number and time of every event as one vector, spelt out."""
    e = X.table(spark, sf, "events").select("event_id", "event_type", "value", "ts")
    known = M.prepare_features(e, "event_id", "keep").fillna(0.0, ["value"])
    v = M.assembler(["event_type", "value", "ts"], out="v").transform(known)
    parts = vector_to_array("v")
    return v.select("event_id", *[parts[k].alias(f"f{k}") for k in range(3)])


SQL_M5 = f"""WITH t AS ({_rank_sql('event_type', 'events')})
SELECT event_id, coalesce(t.i, (SELECT max(n) FROM t)) AS f0, coalesce(value, 0.0) AS f1,
       CAST(floor(epoch(ts)) AS DOUBLE) AS f2
FROM events LEFT JOIN t ON events.event_type = t.v"""


def _ruled(spark, sf, kinds: int):
    """Events whose label follows from their kind; some have a rare kind or none."""
    eid, u = F.col("event_id"), F.col("user_id") % kinds
    kind = F.when(eid % 97 == 0, F.lit(None).cast("string")).when(
        eid % 50 == 0, F.concat(F.lit("rare"), (eid % 1000).cast("string"))).otherwise(
        F.concat(F.lit("kind"), u.cast("string")))
    label = F.when((eid % 97 != 0) & (eid % 50 != 0) & (u % 3 == 0), 1).otherwise(0)
    return X.table(spark, sf, "events").select("event_id", kind.alias("kind"), F.coalesce("value", F.lit(0.0)).alias("value"),
                                               label.alias("label"))


def _ruled_sql(kinds: int, where: str, extra: str = "") -> str:
    label = f"CASE WHEN event_id % 97 <> 0 AND event_id % 50 <> 0 AND user_id % {kinds} % 3 = 0 THEN 1 ELSE 0 END"
    return f"SELECT event_id, {label} AS label, {label} AS predicted{extra} FROM events WHERE {where}"


def _q_m6_ruled(kinds: int):
    """Train on three quarters of the events; the rest is predicted as the rule says."""
    def q(spark, sf):
        raw_train, raw_test = D.train_test_split(_ruled(spark, sf, kinds), ["event_id"], 75)
        train, test = (M.prepare_features(p, "label", "keep", max_categories=kinds + 1, fit_on=raw_train)
                       for p in (raw_train, raw_test))
        _, pred, _ = M.train_random_forest(train, test, "label", ["kind", "value"], keep=["event_id"],
                                           feature_subset="all")
        return pred.select("event_id", "label", "predicted")
    return q


def q_m10(spark, sf):
    prepared = M.prepare_features(_ruled(spark, sf, 12), "label", "keep", max_categories=13)
    out, _ = M.cross_validate(prepared, "label", ["kind", "value"], 3, ["event_id"], feature_subset="all", num_trees=10)
    return out.select("event_id", "label", "predicted", "fold")


# --- end to end: raw rows -> recipes -> keys -> long lag join --------------------

_OT_KEYS = ["OT_ORIGIN_AIRPORT_ID", "OT_WEATHER_TIMESTAMP"]
_OT_MEASURES = [*OT_DOUBLES, *OT_TEXTS]
_FT_KEPT = ["FT_OP_CARRIER_FL_NUM", "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID", "FT_TIMESTAMP", "FT_DEST_DATE_TIME"]
_W1_OUT = [*_FT_KEPT, "FT_JOIN_KEY_DEST", "hours_lag", "FT_ORIGIN_DATE_TIME_LAG", "FT_DEST_DATE_TIME_LAG",
           *[c + side for side in ("_ORIG", "_DEST") for c in _OT_MEASURES]]


def _raw_tables(spark, sf):
    """Both recipes at full width.  Hourly readings are made unique per
    (station, hour) by the joins that follow: duplicates would make the two
    LEFT joins emit origin x destination pairs."""
    st = X.stations(spark, sf)
    return T.fact_table(X.raw_event_facts(spark, sf), st), T.observation_table(X.full_weather(spark, sf, hourly=True), st)


def q_w1(spark, sf):
    ft, ot = _raw_tables(spark, sf)
    _, lines = W.join(ft, ot, "lines", obs_cols=[*_OT_KEYS, *_OT_MEASURES], dedupe="mean", digits=ROUND)
    return lines.select(*_W1_OUT)


def q_w2(spark, sf):
    """Raw rows to the wide form with all measures: joined as arrays of
    readings, written by day, reloaded and flattened."""
    ft, ot = _raw_tables(spark, sf)
    cols, _ = W.join(W.with_row_id(ft), ot, "cols", obs_cols=[*_OT_KEYS, *_OT_MEASURES], dedupe="mean", nested=True,
                     digits=ROUND)
    root = scratch_path(spark, "wide")
    K.store_results(cols, root)
    wide = L.flatten_wide(P.read_joined(spark, root, None, mode="cols")[0], origin_ts_col=W.FT_TS, dest_ts_col=W.FT_ARRIVAL)
    joined = [c for c in wide.columns if "_PART_" in c or "_Part_" in c]
    return wide.select(*_FT_KEPT, *joined)


_RAW_SQL = f"""ft AS ({_fact_table_sql(X.RAW_EVENT_FACTS_SQL)}),
ot0 AS ({_obs_table_sql(X.full_weather_typed_sql(True))}),
ot AS (SELECT {", ".join(_OT_KEYS)}, {", ".join(f"avg({c}) AS {c}" for c in OT_DOUBLES)},
              {", ".join(f"min({c}) AS {c}" for c in OT_TEXTS)}
       FROM ot0 GROUP BY {", ".join(_OT_KEYS)}),
fm AS (SELECT ft.*, ft.FT_TIMESTAMP + to_seconds(CAST(trunc(ft.FT_CRS_ELAPSED_TIME * 60) AS BIGINT)
                    + CAST(trunc(ft.FT_Delta_Lag * 3600) AS BIGINT)) AS FT_DEST_DATE_TIME FROM ft)"""

SQL_W1 = _sql_round(f"""WITH {_RAW_SQL},
x AS (SELECT fm.*, fm.FT_DEST_AIRPORT_ID || '_' || CAST(fm.FT_DEST_DATE_TIME AS VARCHAR) AS FT_JOIN_KEY_DEST,
             CAST(h.range AS INTEGER) AS hours_lag,
             fm.FT_TIMESTAMP - to_hours(CAST(h.range AS INTEGER)) AS FT_ORIGIN_DATE_TIME_LAG,
             fm.FT_DEST_DATE_TIME - to_hours(CAST(h.range AS INTEGER)) AS FT_DEST_DATE_TIME_LAG
      FROM fm CROSS JOIN range({LAGS}) h)
SELECT {", ".join("x." + c for c in _W1_OUT[:9])},
       {", ".join(f"o.{c} AS {c}_ORIG, d.{c} AS {c}_DEST" for c in _OT_MEASURES)}
FROM x
LEFT JOIN ot o ON o.OT_ORIGIN_AIRPORT_ID = x.FT_ORIGIN_AIRPORT_ID AND o.OT_WEATHER_TIMESTAMP = x.FT_ORIGIN_DATE_TIME_LAG
LEFT JOIN ot d ON d.OT_ORIGIN_AIRPORT_ID = x.FT_DEST_AIRPORT_ID AND d.OT_WEATHER_TIMESTAMP = x.FT_DEST_DATE_TIME_LAG""",
                    [c + side for c in OT_DOUBLES for side in ("_ORIG", "_DEST")])


def _sql_w2() -> str:
    kept, joins = ["fm." + c for c in _FT_KEPT], []
    for h in range(LAGS):
        kept += [f"fm.FT_TIMESTAMP - to_hours({h}) AS FT_ORIGIN_DATE_TIME_PART_{h}",
                 f"fm.FT_DEST_DATE_TIME - to_hours({h}) AS FT_DEST_DATE_TIME_PART_{h}"]
        for side, part, station, ts in (("o", "Part", "FT_ORIGIN_AIRPORT_ID", "FT_TIMESTAMP"),
                                        ("d", "Dest_Part", "FT_DEST_AIRPORT_ID", "FT_DEST_DATE_TIME")):
            kept += [f"{side}{h}.{c} AS {c}_{part}_{h}" for c in [*_OT_KEYS, *_OT_MEASURES]]
            joins.append(f"LEFT JOIN ot {side}{h} ON {side}{h}.OT_ORIGIN_AIRPORT_ID = fm.{station} "
                         f"AND {side}{h}.OT_WEATHER_TIMESTAMP = fm.{ts} - to_hours({h})")
    return _sql_round(f"WITH {_RAW_SQL}\nSELECT " + ",\n       ".join(kept) + "\nFROM fm\n" + "\n".join(joins),
                      [f"{c}_{part}_{h}" for c in OT_DOUBLES for part in ("Part", "Dest_Part") for h in range(LAGS)])


# ============================================================================
# registry
# ============================================================================

CATALOG: dict[str, tuple[Query, str | None]] = {
    "W1_raw_to_long_lag_join": (q_w1, SQL_W1),
    "W2_raw_to_wide": (q_w2, _sql_w2()),
    "J4_lag_cross": (q_j4, SQL_J4),
    "J5_lag_long_origin": (q_j5, _long_sql(False)),
    "J6_lag_long": (q_j6, _long_sql(True)),
    "J6_lag_long_stream": (q_j6_stream, _long_sql(True)),
    "J6_lag_long_joins": (q_j6_joins, _long_sql(True)),
    "J6_lag_long_dup": (q_j6_dup, SQL_J6_DUP),
    "J7_lag_wide": (q_j7, _wide_sql(True)),
    "J7_lag_wide_dup": (q_j7_dup, _wide_sql(True, SQL_READINGS, ("event_id", "user_id"))),
    "J7_lag_wide_time_only": (q_j7_time_only, _wide_sql(False)),
    "P13_P14_arrival_keys": (q_p13, SQL_P13),
    "P12_obs_key": (q_p12, SQL_P12),
    "P1_P2_rename": (q_p1_p2, SQL_P1_P2),
    "P3_to_double": (q_p3, SQL_P3),
    "P4_P7_fact_clock": (q_p4_p7, SQL_P4_P7),
    "P8_obs_clock": (q_p8, SQL_P8),
    "F1_drop_flagged": (q_f1, SQL_F1),
    "J1_J2_time_zones": (q_j1_j2, SQL_J1_J2),
    "J3_station_join": (q_j3, SQL_J3),
    "Q7_fact_table": (q_q7, SQL_Q7),
    "Q6_obs_table": (q_q6, SQL_Q6),
    "Q3_impute": (q_q3, SQL_Q3),
    "Q4_Q5_flag_correct": (q_q4_q5, SQL_Q4_Q5),
    "A6_mean_where": (q_a6, SQL_A6),
    "A7_mode": (q_a7, SQL_A7),
    "O1_top_value": (q_o1, SQL_O1),
    "Q1_missing_report": (q_q1, SQL_Q1),
    "Q1_missing_report_docs": (q_q1_docs, SQL_Q1_DOCS),
    "Q2_flag_report": (q_q2, SQL_Q2),
    "A1_airport_summary": (q_a1, SQL_A1),
    "A2_carrier_performance": (q_a2, SQL_A2),
    "A3_delay_breakdown": (q_a3, SQL_A3),
    "A5_row_count": (q_a5, SQL_A5),
    "S9_load_stats": (q_s9, SQL_S9),
    "F2_aligned_facts": (q_f2, SQL_F2),
    "S10_joined_stats": (q_s10, SQL_S10),
    "S10_unaligned_pair_roundtrip": (q_s10_reload, SQL_S10),
    "S6_incremental_load": (q_s6_incremental, SQL_S6_INCREMENTAL),
    "S1_rejected_rows": (q_s1_rejected, SQL_S1_REJECTED),
    "P18_column_subset": (q_p18, SQL_P18),
    "D1_DS1": (_q_ds("DS1"), _ds_sql(_DS_SQL["DS1"], 0)),
    "D2_DS2": (_q_ds("DS2"), _ds_sql(_DS_SQL["DS2"], 0)),
    "D3_DS3": (_q_ds("DS3"), _ds_sql(_DS_SQL["DS3"], 0)),
    "D4_DS4": (_q_ds("DS4"), _ds_sql(_DS_SQL["DS4"], 0)),
    "D5_on_time": (q_d5, _ds_sql("a <= 1.0", 1)),
    "D7_D8_balanced_split": (q_d7_d8, SQL_D7_D8),
    "D7_balanced_approx": (q_d7_approx, SQL_D7_APPROX),
    "D7_balanced_equal_rows": (q_d7_equal_rows, SQL_D7_EQUAL_ROWS),
    "W3_datasets_from_join": (q_w3, SQL_W3),
    "S5_hash_sample": (q_s5, SQL_S5),
    "S1_S6_csv_ingest_roundtrip": (q_s1_s6, SQL_S1_S6),
    "S2_S4_obs_ingest_roundtrip": (q_s2_s4, SQL_S2_S4),
    "S12_S11_result_roundtrip": (q_s12_s11, SQL_S12_S11),
    "S13_report_csv_roundtrip": (q_s13, SQL_A1),
    "S3_lookup_csv_join": (q_s3, SQL_J3),
    "S15_metrics_csv_roundtrip": (q_s15, _sql_s15()),
    "A4_range_stats": (q_a4, SQL_A4),
    "A8_distinct_values": (q_a8, SQL_A8),
    "M1_string_index": (q_m1, SQL_M1),
    "M1_string_index_many": (q_m1_many, SQL_M1_MANY),
    "M2_epoch_seconds": (q_m2, SQL_M2),
    "M4_label_index": (q_m4, SQL_M4),
    "M8_metrics": (q_m8, SQL_M8),
    "M8_confusion_metrics": (q_m8_confusion, SQL_M8),
    "M9_area_under_roc": (q_m9, SQL_M9),
    "M5_assembly": (q_m5, SQL_M5),
    "M6_random_forest": (q_m6, None),
    "M6_M7_forest_rule": (_q_m6_ruled(12), _ruled_sql(12, f"{_bucket_sql('event_id')} >= 75")),
    "M6_M7_forest_many_kinds": (_q_m6_ruled(36), _ruled_sql(36, f"{_bucket_sql('event_id')} >= 75")),
    "M10_cross_validation": (q_m10, _ruled_sql(12, "true", f", CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 3 AS INTEGER) AS fold")),
}


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in CATALOG.items() if v[1] is not None}
