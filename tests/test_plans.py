"""Plan-shape checks: the properties the library relies on at scale."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lagjoin.plans import catalog as Cat
from lagjoin.sources import ingest as I
from lagjoin.sources import parquet as P


def _final_plan(df) -> str:
    """The executed adaptive plan, final section only."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_align_prunes_partitions(spark, tmp_out):
    rows = [(dt.date(2020, 1, d), d) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "FL_DATE date, v int").withColumn("Year", F.year("FL_DATE"))
    I.write_partitioned(df, tmp_out + "/f", ["Year", "FL_DATE"])
    obs = spark.createDataFrame([(dt.date(2020, 1, 10),), (dt.date(2020, 1, 12),)], "Date date")
    f = P.read_parquet(spark, tmp_out + "/f")
    aligned, _, _ = P.align_pair(f, obs, "FL_DATE", "Date")
    plan = aligned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(FL_DATE" in plan
    assert aligned.count() == 3


def test_long_join_shuffles_facts_unexploded(spark):
    """The frames are built and shuffled once; the facts are multiplied by
    the lags above the last join only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _final_plan(Cat.q_j6(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    first_join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    above = [line for line in lines[:first_join] if "Generate explode" in line]
    below = [line for line in lines[first_join:] if "Generate explode" in line]
    assert len(above) == 4      # lags, both sides' readings, copies
    assert len(below) == 1      # the observations' anchors, in one of two uses


def test_scan_pushdown_and_pruning(spark):
    plan = Cat.q_j6(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,view))]" in plan
    assert "EqualTo(event_type,view)]" in plan
    # only the needed columns are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_quality_recipe_uses_two_statistics_jobs(spark):
    from lagjoin.operators import quality as Q
    sc = spark.sparkContext
    w = Cat._typed_weather(spark, SF_SMALL)
    tracker = sc.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    sc.setJobGroup("lagjoin-count", "stats passes")
    Q.impute_and_correct(w, *Cat._PAIRS, threshold=0.2)
    jobs = tracker.getJobIdsForGroup("lagjoin-count")
    sc.setJobGroup("", "")
    # two statistics passes; AQE runs every shuffle stage as its own job:
    # global aggregate (map + result) + mode count (two maps + result) = 5,
    # against one job per column and per flag pair done one by one
    assert len(jobs) <= 5, jobs
    assert before is not None


def test_wide_shuffles_observations_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _final_plan(Cat.q_j7(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the exploded observations are shuffled once and reused by the
    # destination join; the facts are never exploded before a shuffle
    assert "ReusedExchange" in plan
    assert plan.count("Generate explode") == 1
