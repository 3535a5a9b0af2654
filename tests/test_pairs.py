"""Two-sided frame joins: frames go to the different keys of the facts, and
no shuffle has facts and frames in one row."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from lagjoin.operators import columns as C
from lagjoin.operators import lagged as L
from lagjoin.plans import workflow as W

T0 = dt.datetime(2024, 1, 2, 1, 0)
KW = dict(origin_col="o", origin_ts_col="t", station_col="st", obs_ts_col="ts", dest_col="d", dest_ts_col="arr")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _facts(spark):
    """Shared keys, equal rows, and every mix of NULL stations and times."""
    rows = [(k % 20, "A" if k % 2 else "B", "B" if k % 3 else "A", T0 - dt.timedelta(hours=k % 4),
             T0 + dt.timedelta(hours=k % 2)) for k in range(60)]
    rows += [(100 + k, *(None if k >> b & 1 else v for b, v in enumerate(("A", "B", T0, T0)))) for k in range(16)]
    return spark.createDataFrame(rows, "fid int, o string, d string, t timestamp_ntz, arr timestamp_ntz")


def _obs(spark):
    rows = [(s, T0 - dt.timedelta(hours=h), float(h) if h != 3 else None, "x" if h != 2 else None)
            for s in "AB" for h in range(-1, 14) if h != 5]
    return spark.createDataFrame(rows, "st string, ts timestamp_ntz, v double, w string")


def test_no_shuffle_has_facts_and_frames(spark):
    """Before, the frame of the origin went with each fact to its destination."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts, obs = _facts(spark).withColumn("payload", F.col("fid")), _obs(spark)
        for out in (L.lag_join_long(facts, obs, **KW), L.lag_join_long(facts, obs, duplicates="unique", **KW),
                    L.lag_join_wide(facts, obs, nested=True, **KW)):
            plan = out._jdf.queryExecution().executedPlan()
            nodes, shuffled = [plan], []
            while nodes:
                node = nodes.pop()
                if node.nodeName() == "Exchange":
                    shuffled.append(node.output().mkString(","))
                kids = node.children()
                nodes += [kids.apply(k) for k in range(kids.size())]
            assert any("payload" in x for x in shuffled)
            assert not any("payload" in x and re.search(r"__[od]#|__m#", x) for x in shuffled), shuffled
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_null_sides_and_shared_keys(spark, threshold):
    facts, obs = _facts(spark), _obs(spark)
    want = _rows(L.lag_join_long(facts, obs, strategy="joins", **KW))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for how in ("all", "unique"):
            assert _rows(L.lag_join_long(facts, obs, duplicates=how, **KW)) == want
        wide = L.lag_join_wide(facts, obs, **KW)
        nested = L.flatten_wide(L.lag_join_wide(facts, obs, nested=True, **KW), origin_ts_col="t", dest_ts_col="arr")
        assert _rows(nested.select(*wide.columns)) == _rows(wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_lag = wide.select("fid", "o", "d", "t", "arr", F.explode(F.array(*[
        F.struct(F.lit(h).alias("h"), *[F.col(f"{c}_{part}_{h}").alias(c + part) for part in ("Part", "Dest_Part")
                                        for c in "vw"]) for h in range(12)])).alias("x")).select("fid", "o", "d", "t", "arr", "x.*")
    long = L.lag_join_long(facts, obs, strategy="joins", **KW).select(
        "fid", "o", "d", "t", "arr", "hours_lag", "v_ORIG", "w_ORIG", "v_DEST", "w_DEST")
    assert _rows(by_lag) == _rows(long)


def test_changing_keys_raise(spark):
    """Facts whose keys differ between two reads must not lose readings."""
    new = F.udf(lambda: str(uuid.uuid4())).asNondeterministic()
    facts = spark.range(200).select(F.col("id").alias("fid"), new().alias("o"), F.lit("B").alias("d"),
                                    F.lit(T0).cast("timestamp_ntz").alias("t"), F.lit(T0).cast("timestamp_ntz").alias("arr"))
    with pytest.raises(Exception, match="differ between two reads"):
        L.lag_join_long(facts, _obs(spark), **KW).collect()


def test_means_are_rounded_before_the_join(spark):
    """One rounding a reading, none in the joined rows."""
    ft = spark.createDataFrame([("A", "B", T0.date(), T0, 60.0, 0)],
                               "FT_ORIGIN_AIRPORT_ID string, FT_DEST_AIRPORT_ID string, FT_FL_DATE date,"
                               " FT_TIMESTAMP timestamp_ntz, FT_CRS_ELAPSED_TIME double, FT_Delta_Lag int")
    ot = spark.createDataFrame([("A", T0, T0.date(), v) for v in (1.0, 1.0, 2.0)],
                               "OT_ORIGIN_AIRPORT_ID string, OT_WEATHER_TIMESTAMP timestamp_ntz, OT_Date date, v double")
    cols, lines = W.join(W.with_row_id(ft), ot, "both", dedupe="mean", digits=3, nested=True)
    assert lines.where("hours_lag = 0").first()["v_ORIG"] == 1.333
    assert cols.first()[L.ORIGIN_LAGS][0]["v"] == 1.333
    top = lines._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "round(" not in top


def test_text_is_parsed_by_one_function(spark):
    df = spark.createDataFrame([("M", "1.5", 2), ("", "NaN", 3), (None, "x", None), (" 4 ", "1e3", 5)], "a string, b string, n int")
    out = C.to_double_columns(df, ["a", "b", "n"])
    assert [tuple(map(str, r)) for r in out.collect()] == [
        ("None", "1.5", "2.0"), ("None", "nan", "3.0"), ("None", "None", "None"), ("4.0", "1000.0", "5.0")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction") == 1 and out.columns == df.columns


def test_lag_times_are_made_once_a_lag(spark):
    """Before, both times, and a sequence of copies, were made anew for every
    pair of readings."""
    facts, obs = _facts(spark), _obs(spark)
    obs = obs.unionByName(obs).unionByName(obs.withColumn("v", F.col("v") + 100))  # equal readings, and others of the key
    out = L.lag_join_long(facts, obs, **KW)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    top, *generators = plan.split("Generate explode(")[:5]
    assert "make_dt_interval" not in top and all("make_dt_interval" not in g for g in generators[:2])
    assert "make_dt_interval" in generators[2]  # under both sides' readings, above the lags
    assert generators[0].startswith("CASE WHEN")  # pairs that occur once take no sequence
    assert _rows(out) == _rows(L.lag_join_long(facts, obs, strategy="joins", **KW))
    one = dict(KW, dest_col=None, dest_ts_col=None)
    assert _rows(L.lag_join_long(facts, obs, **one)) == _rows(L.lag_join_long(facts, obs, strategy="joins", **one))
