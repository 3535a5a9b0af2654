"""NULL keys keep their rows; wide categories train."""

from pyspark.sql import functions as F

from lagjoin.operators import datasets, ml
from lagjoin.sources import ingest


def keyed(spark):
    return spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("k"))


def test_split_and_sample_keep_null_keys(spark):
    x = keyed(spark)
    train, test = datasets.train_test_split(x, ["k"])
    assert sorted(r["id"] for r in train.unionByName(test).collect()) == list(range(100))
    assert ingest.sample_rows(x, 1.0, key_cols=["k"]).count() == 100
    assert datasets.smallest_by_hash(x, 40, ["k"]).count() == 40


def test_forest_with_forty_categories(spark):
    x = spark.range(400).select((F.col("id") % 40).cast("string").alias("c"),
                                (F.col("id") % 40 < 20).cast("double").alias("y"))
    x = ml.index_strings(x, ["c"])
    metrics = ml.train_random_forest(x, x, "y", ["c"], num_trees=3)[2]
    assert metrics["accuracy"] > 0.9
