"""Deterministic fixture views over the driver's tables.

The driver tables hold no such readings, so the operators run on views
with the same shapes, derived by rule from the given tables (their work
grows with the tables).  Each view has a Spark builder and the equivalent
SQL text (a CTE body) used by the DuckDB oracle; both must stay in step.

    stations      nation: AirportID, WBAN (shared by two airports for some
                  codes), TimeZone
    facts         all events but views: one fact per event, hour-truncated
                  time, origin/destination stations, arrival 2 h later
    obs           view events per (station, hour): count and mean value
    obs_hour      view events per hour (time-only matching)
    readings      view events as they are: several readings share an hour
    raw_weather   every event as a raw observation row (text measures with
                  junk, NULL, NaN, quality flags)
    raw_facts   every lineitem as a raw fact row (text columns)
    delays        lineitem as (a, w, n) delay triples
    scored        documents left-joined with labels (label, score)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.functions.scalar import trunc_hour
from lagjoin.plans.tables import OBS_MEASURES, flag_of

ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
NATIONS = 25          # origin stations of the lag fixtures (user_id % 25)
DEST_MOD = 7          # destination stations (user_id % 7)
WBAN_MOD = 23         # raw observation station codes; 20..22 are unknown
LOOKUP_WBAN_MOD = 20  # lookup codes: n_nationkey % 20 (codes 0..4 twice)
ORIGIN_MOD = 27       # raw fact origins; 25, 26 are unknown airports


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hour(c: str):
    return trunc_hour(c)


# --- stations -----------------------------------------------------------------

def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("AirportID"),
                    (F.col("n_nationkey") % LOOKUP_WBAN_MOD).cast("string").alias("WBAN"),
                    (-(F.col("n_regionkey") + 4)).cast("string").alias("TimeZone"))


STATIONS_SQL = f"""SELECT CAST(n_nationkey AS VARCHAR) AS AirportID,
       CAST(n_nationkey % {LOOKUP_WBAN_MOD} AS VARCHAR) AS WBAN,
       CAST(-(n_regionkey + 4) AS VARCHAR) AS TimeZone
FROM nation"""


# --- lag-join facts and observations -------------------------------------------

def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts_of(table(spark, sf_dir, "events"))


def facts_of(events: DataFrame) -> DataFrame:
    """The facts of an event table or stream."""
    t = _hour("ts")
    return (events.where(F.col("event_type") != "view")
             .select(F.col("event_id").alias("fact_id"),
                     (F.col("user_id") % NATIONS).alias("origin"),
                     (F.col("user_id") % DEST_MOD).alias("dest"),
                     t.alias("t"), (t + F.expr("INTERVAL 2 HOURS")).alias("arr")))


FACTS_SQL = f"""SELECT event_id AS fact_id, user_id % {NATIONS} AS origin, user_id % {DEST_MOD} AS dest,
       date_trunc('hour', ts) AS t, date_trunc('hour', ts) + INTERVAL 2 HOUR AS arr
FROM events WHERE event_type <> 'view'"""


def facts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts read as a file stream."""
    folder = sf_dir.rstrip("/")
    # a file stream lists a directory: point it at the folder, glob the file
    events = (spark.readStream.schema(table(spark, sf_dir, "events").schema).option("basePath", folder)
              .parquet(f"{folder}/events.parque[t]"))
    return facts_of(events)


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.where(F.col("event_type") == "view")
             .groupBy((F.col("user_id") % NATIONS).alias("station"), _hour("ts").alias("ts"))
             .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("v")))


OBS_SQL = f"""SELECT user_id % {NATIONS} AS station, date_trunc('hour', ts) AS ts,
       count(*) AS n, round(avg(value), 4) AS v
FROM events WHERE event_type = 'view' GROUP BY 1, 2"""


def obs_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.where(F.col("event_type") == "view").groupBy(_hour("ts").alias("ts"))
             .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("v")))


OBS_HOUR_SQL = """SELECT date_trunc('hour', ts) AS ts, count(*) AS n, round(avg(value), 4) AS v
FROM events WHERE event_type = 'view' GROUP BY 1"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view event as a reading of its hour: several share a key."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    return e.select((F.col("user_id") % NATIONS).alias("station"), _hour("ts").alias("ts"), "event_id", "user_id")


READINGS_SQL = f"""SELECT user_id % {NATIONS} AS station, date_trunc('hour', ts) AS ts, event_id, user_id
FROM events WHERE event_type = 'view'"""


# --- raw observation rows (text, as read from the feed) -------------------------

#: Measures that only the full feed has, and how often each is missing.
MORE_MEASURES = tuple(m for m in OBS_MEASURES if m not in ("SkyCondition", "Visibility", "WeatherType", "WindSpeed"))


def _every(k: int) -> int:
    return 3 if k % 5 == 4 else 6 + k


def full_weather(spark: SparkSession, sf_dir: str, hourly: bool = False) -> DataFrame:
    """The raw observations with all measures of the feed and their flags."""
    eid, v = F.col("event_id"), F.col("value")
    e = table(spark, sf_dir, "events")
    more = []
    for k, m in enumerate(MORE_MEASURES):
        if m == "RecordType":
            text = F.when((eid + k) % 6 != 0, F.when((eid + k) % 2 == 0, "AA").otherwise("SP"))
        else:
            text = F.when((eid + k) % _every(k) == 0, F.lit("M")).otherwise((v * (k + 1) / 7).cast("string"))
        flag = F.when(eid * (k + 3) % 7 == 0, "s").when(eid * (k + 3) % 7 != 1, " ")
        more += [text.alias(m), flag.alias(flag_of(m))]
    return _raw_weather(e, hourly, more)


def full_weather_typed_sql(hourly: bool = False) -> str:
    more = []
    for k, m in enumerate(MORE_MEASURES):
        if m == "RecordType":
            more.append(f"CASE WHEN (event_id + {k}) % 6 <> 0 THEN CASE WHEN (event_id + {k}) % 2 = 0 THEN 'AA' ELSE 'SP' END END AS {m}")
        else:
            more.append(f"CASE WHEN (event_id + {k}) % {_every(k)} = 0 THEN NULL ELSE value * {k + 1} / 7 END AS {m}")
        more.append(f"CASE WHEN event_id * {k + 3} % 7 = 0 THEN 's' WHEN event_id * {k + 3} % 7 <> 1 THEN ' ' END AS {flag_of(m)}")
    return raw_weather_typed_sql(hourly).replace("\nFROM events", ",\n       " + ",\n       ".join(more) + "\nFROM events")


def raw_weather(spark: SparkSession, sf_dir: str, hourly: bool = False) -> DataFrame:
    """Every event as a raw observation; ``hourly`` puts readings on the hour."""
    return _raw_weather(table(spark, sf_dir, "events"), hourly, [])


def _raw_weather(e: DataFrame, hourly: bool, more: list) -> DataFrame:
    eid, v = F.col("event_id"), F.col("value")
    clock = F.hour("ts") * 100 if hourly else F.hour("ts") * 100 + F.minute("ts")
    return e.select(
        eid.alias("ObsId"),
        (F.col("user_id") % WBAN_MOD).cast("string").alias("WBAN"),
        clock.cast("string").alias("Time"),
        F.when(eid % 17 == 0, F.lit("M")).otherwise(F.lit("12")).alias("StationType"),
        F.col("event_type").alias("SkyCondition"),
        F.when(eid % 3 == 0, "s").when(eid % 3 == 1, " ").alias("SkyConditionFlag"),
        F.when(eid % 11 == 0, F.lit(None).cast("string")).when(eid % 13 == 0, F.lit("NaN"))
         .otherwise(v.cast("string")).alias("Visibility"),
        F.when(F.col("event_type") == "error", "s").when(F.col("event_type") == "signup", None)
         .otherwise(" ").alias("VisibilityFlag"),
        F.when(v > 50, "RA").when(v > 20, "BR").alias("WeatherType"),
        F.when(F.col("user_id") % 4 == 0, "s").otherwise(" ").alias("WeatherTypeFlag"),
        F.when(eid % 4 == 0, F.lit("M")).otherwise((v / 3).cast("string")).alias("WindSpeed"),
        F.when(eid % 5 == 0, "s").otherwise("").alias("WindSpeedFlag"),
        F.year("ts").alias("Year"),
        F.col("ts").cast("date").alias("Date"), *more)


# Typed twin of raw_weather for the oracle: the text measures are written as
# the doubles Spark parses them back to ('M' -> NULL, 'NaN' -> NaN).
def raw_weather_typed_sql(hourly: bool = False) -> str:
    clock = "hour(ts) * 100" if hourly else "hour(ts) * 100 + minute(ts)"
    return f"""SELECT event_id AS ObsId,
       CAST(user_id % {WBAN_MOD} AS VARCHAR) AS WBAN,
       CAST({clock} AS VARCHAR) AS Time,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE 12.0 END AS StationType,
       event_type AS SkyCondition,
       CASE WHEN event_id % 3 = 0 THEN 's' WHEN event_id % 3 = 1 THEN ' ' END AS SkyConditionFlag,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'NaN'::DOUBLE
            ELSE value END AS Visibility,
       CASE WHEN event_type = 'error' THEN 's' WHEN event_type = 'signup' THEN NULL
            ELSE ' ' END AS VisibilityFlag,
       CASE WHEN value > 50 THEN 'RA' WHEN value > 20 THEN 'BR' END AS WeatherType,
       CASE WHEN user_id % 4 = 0 THEN 's' ELSE ' ' END AS WeatherTypeFlag,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 3 END AS WindSpeed,
       CASE WHEN event_id % 5 = 0 THEN 's' ELSE '' END AS WindSpeedFlag,
       CAST(year(ts) AS INTEGER) AS Year,
       CAST(ts AS DATE) AS Date
FROM events"""


RAW_WEATHER_TYPED_SQL = raw_weather_typed_sql(False)

# The text version (missing report / flag report see the raw strings).
RAW_WEATHER_TEXT_SQL = f"""SELECT event_id AS ObsId,
       CAST(user_id % {WBAN_MOD} AS VARCHAR) AS WBAN,
       CAST(hour(ts) * 100 + minute(ts) AS VARCHAR) AS Time,
       CASE WHEN event_id % 17 = 0 THEN 'M' ELSE '12' END AS StationType,
       event_type AS SkyCondition,
       CASE WHEN event_id % 3 = 0 THEN 's' WHEN event_id % 3 = 1 THEN ' ' END AS SkyConditionFlag,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'NaN'
            ELSE 'x' END AS Visibility,
       CASE WHEN event_type = 'error' THEN 's' WHEN event_type = 'signup' THEN NULL
            ELSE ' ' END AS VisibilityFlag,
       CASE WHEN value > 50 THEN 'RA' WHEN value > 20 THEN 'BR' END AS WeatherType,
       CASE WHEN user_id % 4 = 0 THEN 's' ELSE ' ' END AS WeatherTypeFlag,
       CASE WHEN event_id % 4 = 0 THEN 'M' ELSE 'x' END AS WindSpeed,
       CASE WHEN event_id % 5 = 0 THEN 's' ELSE '' END AS WindSpeedFlag,
       CAST(year(ts) AS INTEGER) AS Year,
       CAST(ts AS DATE) AS Date
FROM events"""


# --- raw fact rows ----------------------------------------------------------------

def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pk, sk, ok, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber")
    dep = (ln * 300 + pk % 60)
    return li.select(
        (sk % 10).cast("string").alias("OP_CARRIER_AIRLINE_ID"),
        F.when(pk % 97 == 0, F.lit(None).cast("string")).otherwise(ok.cast("string"))
         .alias("OP_CARRIER_FL_NUM"),
        (pk % ORIGIN_MOD).cast("string").alias("ORIGIN_AIRPORT_ID"),
        (sk % NATIONS).cast("string").alias("DEST_AIRPORT_ID"),
        F.when(pk % 89 == 0, F.lit(None).cast("string"))
         .when(pk % 83 == 0, F.lit("2400"))
         .when(pk % 79 == 0, F.concat(dep.cast("string"), F.lit(".0")))
         .otherwise(dep.cast("string")).alias("CRS_DEP_TIME"),
        F.when(pk % 61 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity") - 10).alias("ARR_DELAY_NEW"),
        F.when(pk % 53 == 0, F.lit("1.00")).when(pk % 71 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("0.00")).alias("CANCELLED"),
        F.when(pk % 59 == 0, F.lit("1")).otherwise(F.lit("0")).alias("DIVERTED"),
        (ok % 5 * 45 + 60).cast("string").alias("CRS_ELAPSED_TIME"),
        F.when(pk % 3 == 0, F.lit(None).cast("string"))
         .otherwise((ln * 2).cast("string")).alias("WEATHER_DELAY"),
        F.when(pk % 4 == 0, F.lit(None).cast("string"))
         .otherwise((sk % 30).cast("string")).alias("NAS_DELAY"),
        F.lit(None).cast("string").alias("_c12"),
        F.year("l_shipdate").alias("Year"),
        F.col("l_shipdate").cast("date").alias("FL_DATE"))


RAW_FACTS_SQL = f"""SELECT CAST(l_suppkey % 10 AS VARCHAR) AS OP_CARRIER_AIRLINE_ID,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS OP_CARRIER_FL_NUM,
       CAST(l_partkey % {ORIGIN_MOD} AS VARCHAR) AS ORIGIN_AIRPORT_ID,
       CAST(l_suppkey % {NATIONS} AS VARCHAR) AS DEST_AIRPORT_ID,
       CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN '2400'
            WHEN l_partkey % 79 = 0 THEN CAST(l_linenumber * 300 + l_partkey % 60 AS VARCHAR) || '.0'
            ELSE CAST(l_linenumber * 300 + l_partkey % 60 AS VARCHAR) END AS CRS_DEP_TIME,
       CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE l_quantity - 10 END AS ARR_DELAY_NEW,
       CASE WHEN l_partkey % 53 = 0 THEN '1.00' WHEN l_partkey % 71 = 0 THEN NULL
            ELSE '0.00' END AS CANCELLED,
       CASE WHEN l_partkey % 59 = 0 THEN '1' ELSE '0' END AS DIVERTED,
       CAST(l_orderkey % 5 * 45 + 60 AS VARCHAR) AS CRS_ELAPSED_TIME,
       CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CAST(l_linenumber * 2 AS VARCHAR) END AS WEATHER_DELAY,
       CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_suppkey % 30 AS VARCHAR) END AS NAS_DELAY,
       CAST(NULL AS VARCHAR) AS _c12,
       CAST(year(l_shipdate) AS INTEGER) AS Year,
       CAST(l_shipdate AS DATE) AS FL_DATE
FROM lineitem"""


def raw_event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events but views as raw fact rows, departing on the hour, so they
    share dates and hours with the (hourly) raw observations."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") != "view")
    eid, v, u = F.col("event_id"), F.col("value"), F.col("user_id")
    return e.select(
        (u % 10).cast("string").alias("OP_CARRIER_AIRLINE_ID"),
        eid.cast("string").alias("OP_CARRIER_FL_NUM"),
        (u % NATIONS).cast("string").alias("ORIGIN_AIRPORT_ID"),
        (u % DEST_MOD).cast("string").alias("DEST_AIRPORT_ID"),
        (F.hour("ts") * 100).cast("string").alias("CRS_DEP_TIME"),
        v.alias("ARR_DELAY_NEW"),
        F.when(eid % 41 == 0, F.lit("1.00")).otherwise(F.lit("0.00")).alias("CANCELLED"),
        F.when(eid % 43 == 0, F.lit("1")).otherwise(F.lit("0")).alias("DIVERTED"),
        F.when(eid % 2 == 0, F.lit("120")).otherwise(F.lit("60")).alias("CRS_ELAPSED_TIME"),
        F.when(v > 40, F.floor(v / 3).cast("string")).alias("WEATHER_DELAY"),
        F.when(eid % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("5")).alias("NAS_DELAY"),
        F.lit(None).cast("string").alias("_c12"),
        F.year("ts").alias("Year"),
        F.col("ts").cast("date").alias("FL_DATE"))


RAW_EVENT_FACTS_SQL = f"""SELECT CAST(user_id % 10 AS VARCHAR) AS OP_CARRIER_AIRLINE_ID,
       CAST(event_id AS VARCHAR) AS OP_CARRIER_FL_NUM,
       CAST(user_id % {NATIONS} AS VARCHAR) AS ORIGIN_AIRPORT_ID,
       CAST(user_id % {DEST_MOD} AS VARCHAR) AS DEST_AIRPORT_ID,
       CAST(hour(ts) * 100 AS VARCHAR) AS CRS_DEP_TIME,
       value AS ARR_DELAY_NEW,
       CASE WHEN event_id % 41 = 0 THEN '1.00' ELSE '0.00' END AS CANCELLED,
       CASE WHEN event_id % 43 = 0 THEN '1' ELSE '0' END AS DIVERTED,
       CASE WHEN event_id % 2 = 0 THEN '120' ELSE '60' END AS CRS_ELAPSED_TIME,
       CASE WHEN value > 40 THEN CAST(CAST(floor(value / 3) AS BIGINT) AS VARCHAR) END AS WEATHER_DELAY,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE '5' END AS NAS_DELAY,
       CAST(NULL AS VARCHAR) AS _c12,
       CAST(year(ts) AS INTEGER) AS Year,
       CAST(ts AS DATE) AS FL_DATE
FROM events WHERE event_type <> 'view'"""


# --- delay triples ---------------------------------------------------------------------

def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    a = F.col("l_quantity")
    w = F.when(F.col("l_returnflag") == "R", a).when(F.col("l_returnflag") == "A", F.lit(0.0)) \
         .otherwise(a / 2)
    n = F.when(F.col("l_linestatus") == "F", a - w) \
         .when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), F.lit(0.0)) \
         .otherwise(a / 4)
    return li.select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("Year"),
                     a.alias("FT_ARR_DELAY_NEW"), w.alias("FT_WEATHER_DELAY"),
                     n.alias("FT_NAS_DELAY"))


DELAYS_SQL = """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS Year,
       l_quantity AS FT_ARR_DELAY_NEW,
       CASE WHEN l_returnflag = 'R' THEN l_quantity WHEN l_returnflag = 'A' THEN 0.0
            ELSE l_quantity / 2 END AS FT_WEATHER_DELAY,
       CASE WHEN l_linestatus = 'F' THEN l_quantity - (CASE WHEN l_returnflag = 'R' THEN l_quantity
                 WHEN l_returnflag = 'A' THEN 0.0 ELSE l_quantity / 2 END)
            WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 0.0
            ELSE l_quantity / 4 END AS FT_NAS_DELAY
FROM lineitem"""


def keyed_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay triples with a unique key (event_id) for balancing/splitting."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    return e.select(F.col("event_id"), v.alias("FT_ARR_DELAY_NEW"),
                    F.when(F.col("event_type") == "error", v).otherwise(F.lit(0.0)).alias("FT_WEATHER_DELAY"),
                    F.when(F.col("event_type") == "error", F.lit(0.0)).otherwise(v).alias("FT_NAS_DELAY"))


KEYED_DELAYS_SQL = """SELECT event_id, value AS FT_ARR_DELAY_NEW,
       CASE WHEN event_type = 'error' THEN value ELSE 0.0 END AS FT_WEATHER_DELAY,
       CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS FT_NAS_DELAY
FROM events"""


# --- scored documents -------------------------------------------------------------------

def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lb = table(spark, sf_dir, "labels")
    return d.join(lb, "doc_id", "inner").select(
        "doc_id", "lang", "source", "n_chars", F.col("quality").alias("label"),
        F.col("toxic"))


SCORED_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality AS label, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
