import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lagjoin.plans import fixtures as X
from lagjoin.plans import workflow as W
from lagjoin.sources import ingest as I


def _csv(df, path):
    df.write.mode("overwrite").option("header", "true").csv(path)


@pytest.fixture(scope="module")
def raw_files(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wf"))
    _csv(X.raw_event_facts(spark, SF_SMALL).drop("Year"), root + "/facts")
    w = X.raw_weather(spark, SF_SMALL, hourly=True).drop("Year") \
        .withColumn("Date", F.date_format("Date", "yyyyMMdd"))
    _csv(w, root + "/weather")
    _csv(X.stations(spark, SF_SMALL), root + "/stations")
    I.create_parquet_tables(spark, root + "/facts", root + "/weather", root + "/fp", root + "/wp")
    return root


def test_prepare_and_join(spark, raw_files):
    ft, ot, reps = W.prepare(spark, raw_files + "/fp", raw_files + "/wp", raw_files + "/stations")
    assert set(reps) == set(W.REPORTS)
    assert reps["parquet_files_stats"].count() == 4
    assert ft.columns[0].startswith("FT_") and ot.columns[0].startswith("OT_")
    ft = W.with_row_id(ft)
    cols, lines = W.join(ft, ot, "both", obs_cols=["OT_ORIGIN_AIRPORT_ID", "OT_WEATHER_TIMESTAMP",
                                                    "OT_Visibility"])
    n = ft.count()
    assert cols.count() == n
    assert lines.count() >= 12 * n
    assert lines.where("OT_Visibility_ORIG IS NOT NULL").count() > 0
    with pytest.raises(ValueError):
        W.join(ft.drop(W.FACT_KEY), ot, "cols")
    with pytest.raises(ValueError):
        W.join(ft, ot, "rows")


def test_run_end_to_end(spark, raw_files, tmp_out):
    out = os.path.join(tmp_out, "run")
    met = W.run(spark, raw_files + "/fp", raw_files + "/wp", raw_files + "/stations", out,
                mode="both", obs_cols=["OT_ORIGIN_AIRPORT_ID", "OT_WEATHER_TIMESTAMP", "OT_Visibility"],
                ds_type="DS4", delayed=15, on_time=5.0, fill_missing=0.0, num_trees=5, max_depth=3)
    assert set(met) == {"cols", "lines"}
    for m in met.values():
        assert 0.0 <= m["accuracy"] <= 1.0 and m["numTrees"] == 5.0
    for d in ("reports/carrier_stats.csv", "joined_cols", "joined_lines", "schema_lines.json",
              "metrics_DS4_lines/metrics.csv", "ft", "ot"):
        assert os.path.exists(os.path.join(out, d)), d


def test_cli_run(spark, raw_files, tmp_out):
    from lagjoin.__main__ import main
    out = os.path.join(tmp_out, "cli")
    assert main(["run", "--facts", raw_files + "/fp", "--obs", raw_files + "/wp",
                 "--stations", raw_files + "/stations", "--out", out, "--mode", "lines",
                 "--obs-cols", "OT_ORIGIN_AIRPORT_ID,OT_WEATHER_TIMESTAMP,OT_Visibility",
                 "--ds-type", "DS4", "--on-time", "5", "--trees", "3", "--depth", "2", "--fill-missing", "0"]) == 0
    assert os.path.exists(os.path.join(out, "metrics_DS4_lines", "metrics.csv"))


def test_cli_ingest(spark, raw_files, tmp_out):
    from lagjoin.__main__ import main
    fo, wo = os.path.join(tmp_out, "f"), os.path.join(tmp_out, "w")
    assert main(["ingest", "--facts", raw_files + "/facts", "--obs", raw_files + "/weather",
                 "--facts-out", fo, "--obs-out", wo]) == 0
    f, w = spark.read.parquet(fo), spark.read.parquet(wo)
    assert dict(f.dtypes)["FL_DATE"] == "date" and dict(w.dtypes)["Date"] == "date"
    assert f.count() == spark.read.parquet(raw_files + "/fp").count()
