import datetime as dt

import pytest
from pyspark.sql import functions as F

from lagjoin.operators import ml as M


def _frame(spark):
    rows = []
    for i in range(200):
        lab = 1 if i % 3 else 0
        rows.append((i, lab, "x" if lab else "y", float(i % 17) + lab * 5.0,
                     dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)))
    return spark.createDataFrame(rows, "id int, label int, cat string, num double, ts timestamp_ntz")


def test_index_strings_and_epoch(spark):
    df = spark.createDataFrame([("b", "p"), ("a", "q"), ("b", "q"), ("c", None)], "s string, t string")
    out = M.index_strings(df, ["s", "t"], "skip").collect()
    assert len(out) == 3                       # NULL t skipped
    idx = {r["s"] for r in out}
    assert idx == {0.0, 1.0}                   # b most frequent; a before c alphabetically
    e = spark.createDataFrame([(dt.datetime(1970, 1, 2, 0, 0, 1, 900000), dt.date(1970, 1, 3))],
                              "ts timestamp_ntz, d date")
    r = M.dates_to_epoch(e, ["ts", "d"]).first()
    assert r["ts"] == 86401.0 and r["d"] == 2 * 86400.0


def test_validation(spark):
    df = _frame(spark)
    with pytest.raises(ValueError):
        M.validate_inputs(df.withColumn("label", F.lit(-1)), "label", ["num"])
    with pytest.raises(ValueError):
        M.validate_inputs(df.withColumn("label", F.lit(None).cast("int")), "label", ["num"])
    with pytest.raises(ValueError):
        M.validate_inputs(df.withColumn("label", F.lit("a")), "label", ["num"])
    with pytest.raises(ValueError):
        M.validate_inputs(df, "label", [], 20, 5)
    with pytest.raises(ValueError):
        M.validate_inputs(df, "label", ["num"], folds=1)
    with pytest.raises(ValueError):
        M.validate_inputs(df.limit(0), "label", ["num"])
    M.validate_inputs(df, "label", ["num"], 20, 5, 3)


def test_train_and_metrics(spark):
    df = M.prepare_features(_frame(spark), "label")
    assert dict(df.dtypes)["cat"] == "double" and dict(df.dtypes)["ts"] == "double"
    train, test = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    model, pred, met = M.train_random_forest(train, test, "label", ["cat", "num", "ts"],
                                             num_trees=5, max_depth=3)
    assert set(met) == set(M.METRIC_NAMES)
    assert met["accuracy"] > 0.9 and met["numTrees"] == 5.0 and met["maxDepth"] == 3.0
    conf = M.confusion_metrics(pred, "indexedLabel", "prediction").first().asDict()
    for k in ("accuracy", "f1Score", "recall", "precision"):
        assert conf[k] == pytest.approx(met[k])
    auc = M.area_under_roc(pred.select(F.col("indexedLabel").alias("label"), "rawPrediction"))
    assert 0.9 < auc <= 1.0
    mf = M.metrics_frame(spark, met)
    assert mf.count() == 6


def test_cross_validation(spark):
    df = M.prepare_features(_frame(spark), "label")
    _, _, met = M.train_random_forest(df, df, "label", ["cat", "num"], num_trees=3, max_depth=2,
                                      folds=2)
    assert met["numTrees"] == 3.0


def test_single_class_and_null_features(spark):
    df = M.prepare_features(_frame(spark), "label").withColumn(
        "num", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("num")))
    _, pred, met = M.train_random_forest(df.where("label = 1"), df.where("label = 1"), "label",
                                         ["num"], num_trees=2, max_depth=2, handle_invalid="skip")
    assert met["accuracy"] == 1.0
    assert pred.count() == df.where("label = 1 AND num IS NOT NULL").count()


def test_random_forest_single_frame(spark):
    met = M.random_forest(_frame(spark), "label", ["cat", "num"], num_trees=4, max_depth=3)
    assert met["accuracy"] > 0.8 and met["numTrees"] == 4.0


def test_empty_test_part_raises(spark):
    df = M.prepare_features(_frame(spark), "label")
    with pytest.raises(ValueError):
        M.train_random_forest(df, df.limit(0), "label", ["num"], num_trees=2, max_depth=2)
