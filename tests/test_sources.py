import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lagjoin.sources import ingest as I
from lagjoin.sources import parquet as P
from lagjoin.sources import sinks as K


def _write_csv(path, header, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write(header + "\n")
        for r in rows:
            fh.write(r + "\n")


def test_ingest_roundtrip(spark, tmp_out):
    _write_csv(tmp_out + "/fl", "FL_DATE,ARR_DELAY_NEW,ORIGIN_AIRPORT_ID,",
               ["2012-01-01,5.00,10,", "2012-01-02,M,11,", "2013-02-03,,10,"])
    _write_csv(tmp_out + "/wx", "WBAN,Date,Time", ["3972,20120101,53", "3972,20120102,153",
                                                    "94846,20140101,53"])
    I.create_parquet_tables(spark, tmp_out + "/fl", tmp_out + "/wx", tmp_out + "/fp", tmp_out + "/wp")
    f, w, stats = P.read_pair(spark, tmp_out + "/fp", tmp_out + "/wp")
    schema = dict(f.dtypes)
    assert schema["ARR_DELAY_NEW"] == "double" and schema["Year"] == "int" and schema["FL_DATE"] == "date"
    assert "_c3" in schema
    st = {r["dataset"]: (r["min_date"], r["max_date"], r["size"]) for r in stats.collect()}
    assert st["fact_initial"] == (dt.date(2012, 1, 1), dt.date(2013, 2, 3), 3)
    assert st["weather_initial"] == (dt.date(2012, 1, 1), dt.date(2014, 1, 1), 3)
    assert st["fact_filtered"] == (dt.date(2012, 1, 1), dt.date(2013, 2, 3), 3)
    assert st["weather_filtered"] == (dt.date(2012, 1, 1), dt.date(2012, 1, 2), 2)
    assert sorted(r["ARR_DELAY_NEW"] for r in f.collect() if r["ARR_DELAY_NEW"] is not None) == [5.0]


def _dates(spark, days):
    return spark.createDataFrame([(dt.date(2020, 1, d),) for d in days], "d date")


@pytest.mark.parametrize("a,b,n_a,n_b", [
    ([1, 5, 9], [4, 6, 12], 2, 2),       # overlap [4, 9]
    ([1, 20], [3, 4, 5], 2, 3),          # containment [3, 5]... a has none inside but 20/1 out
    ([1, 2], [5, 6], 0, 0),              # disjoint -> empty
])
def test_align_pair(spark, a, b, n_a, n_b):
    fa, fb = _dates(spark, a), _dates(spark, b)
    x, y, _ = P.align_pair(fa, fb, "d", "d")
    lo, hi = max(min(a), min(b)), min(max(a), max(b))
    assert x.count() == sum(lo <= d <= hi for d in a)
    assert y.count() == sum(lo <= d <= hi for d in b)


def test_align_pair_empty_raises(spark):
    with pytest.raises(ValueError):
        P.align_pair(_dates(spark, [1]).limit(0), _dates(spark, [1]), "d", "d")


def test_sample_rows(spark):
    df = spark.range(2000)
    a = I.sample_rows(df, 0.25, key_cols=["id"])
    assert 400 < a.count() < 600
    assert a.collect() == I.sample_rows(df, 0.25, key_cols=["id"]).collect()
    with pytest.raises(ValueError):
        I.sample_rows(df, 1.5)


def test_result_sinks(spark, tmp_out):
    df = spark.createDataFrame([(2013, dt.date(2013, 1, 1), 1.0), (2013, dt.date(2013, 1, 2), 2.0)],
                               "FT_Year int, FT_FL_DATE date, v double")
    K.store_results(df, tmp_out + "/lines")
    K.store_results(df.withColumn("w", F.lit(1)), tmp_out + "/cols")
    cols, lines = P.read_joined(spark, tmp_out + "/cols", tmp_out + "/lines", "both")
    assert cols.count() == 2 and lines.count() == 2 and "w" in cols.columns
    c, l2 = P.read_joined(spark, tmp_out + "/cols", None, "cols")
    assert l2 is None and c.count() == 2
    with pytest.raises(ValueError):
        P.read_joined(spark, None, None, "rows")


def test_report_schema_metrics(spark, tmp_out):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    K.write_report_csv(df, tmp_out + "/rep")
    files = [f for f in os.listdir(tmp_out + "/rep") if f.endswith(".csv")]
    assert len(files) == 1
    rows = K.schema_frame(df).collect()
    assert [(r["name"], r["type"]) for r in rows] == [("k", "string"), ("n", "int")]
    K.write_schema_json(df, tmp_out + "/schema")
    text = spark.read.text(tmp_out + "/schema").first()["value"]
    assert json.loads(text)["fields"][0]["name"] == "k"
    K.write_metrics_csv(spark, {"accuracy": 0.5, "numTrees": 20.0}, tmp_out + "/m")
    back = spark.read.option("header", "true").csv(tmp_out + "/m/metrics.csv").collect()
    assert {r["metric"]: float(r["value"]) for r in back} == {"accuracy": 0.5, "numTrees": 20.0}


def test_read_pair_joined_mode_writes_stats(spark, tmp_out):
    df = spark.createDataFrame([(dt.date(2013, 1, d), d) for d in (1, 2, 3)], "FT_FL_DATE date, v int")
    df.write.parquet(tmp_out + "/a")
    df.where("v > 1").write.parquet(tmp_out + "/b")
    f, o, st = P.read_pair(spark, tmp_out + "/a", tmp_out + "/b", aligned=False,
                           stats_csv=tmp_out + "/stats.csv")
    rows = {r["dataset"]: r["size"] for r in st.collect()}
    assert rows == {"fact_initial": 3, "weather_initial": 2}
    assert spark.read.option("header", "true").csv(tmp_out + "/stats.csv").count() == 2
