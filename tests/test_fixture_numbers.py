"""The fixture views reproduce the numbers the survey computed independently
at sf0.01 (SURVEY §7.3): a guard against the Spark views and their SQL twins
drifting together."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_CHECK
from lagjoin.operators import datasets as D
from lagjoin.plans import catalog as Cat
from lagjoin.plans import fixtures as X
from lagjoin.sources import parquet as P


def test_delay_dataset_counts(spark):
    d = X.delays(spark, SF_CHECK)
    got = [d.where(D.delayed_condition(t, 15)).count() for t in D.DS_TYPES]
    assert got == [21451, 35822, 41940, 42950]
    assert d.where(D.on_time_condition(1.0)).count() == 1150


def test_lag_join_counts(spark):
    """The survey's numbers are those of purchases alone."""
    bought = X.table(spark, SF_CHECK, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("fact_id"))
    lj = Cat.q_j6(spark, SF_CHECK).join(bought, "fact_id")
    r = lj.agg(F.count(F.lit(1)).alias("n"), F.count("v_ORIG").alias("o"),
               F.count("v_DEST").alias("d")).first()
    assert (r["n"], r["o"], r["d"]) == (23772, 2483, 2518)
    assert Cat.q_j7(spark, SF_CHECK).join(bought, "fact_id").count() == 1981


def test_overlap_range(spark):
    f, o = Cat._pair(spark, SF_CHECK)
    assert P.common_range(f, "FL_DATE", o, "Date") == (dt.date(1995, 1, 2), dt.date(2001, 8, 1))
