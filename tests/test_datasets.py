import pytest
from pyspark.sql import functions as F

from lagjoin.functions import scalar as S
from lagjoin.operators import datasets as D

T = 15.0


def _delays(spark):
    # (id, a, w, n)
    rows = [(1, T, 0.0, 0.0),        # a = T: DS4 only
            (2, 1.0, 0.0, 0.0),      # a = on-time threshold
            (3, 20.0, 12.0, 8.0),    # a = w + n: DS1..DS4
            (4, 20.0, 0.0, 0.0),     # w = 0, n = 0: DS4 only
            (5, 30.0, 0.0, T),       # n = T: DS2, DS3, DS4
            (6, None, 0.0, 0.0),     # unknown delay: no class
            (7, 0.0, 0.0, 0.0), (8, 0.5, 0.0, 0.0), (9, 0.0, 0.0, 0.0)]
    return spark.createDataFrame(rows, "id int, FT_ARR_DELAY_NEW double, FT_WEATHER_DELAY double, "
                                       "FT_NAS_DELAY double")


@pytest.mark.parametrize("ds,ids", [("DS1", {3}), ("DS2", {3, 5}), ("DS3", {3, 5}),
                                    ("DS4", {1, 3, 4, 5})])
def test_delayed_filters(spark, ds, ids):
    got = {r["id"] for r in _delays(spark).where(D.delayed_condition(ds, T)).collect()}
    assert got == ids


def test_on_time_filter(spark):
    got = {r["id"] for r in _delays(spark).where(D.on_time_condition(1.0)).collect()}
    assert got == {2, 7, 8, 9}


def test_guards(spark):
    df = _delays(spark)
    with pytest.raises(ValueError):
        D.delayed_condition("DS5", T)
    with pytest.raises(ValueError):
        D.labelled_datasets(df, "DS1", 1.0, 15.0)
    with pytest.raises(ValueError):
        D.labelled_datasets(df.where("id = 2"), "DS1", T, 1.0)      # no delayed rows
    with pytest.raises(ValueError):
        D.labelled_datasets(df.where("id = 3"), "DS1", T, 1.0)      # no on-time rows
    e = D.labelled_datasets(df.limit(0), "DS1", T, 1.0)
    assert len(e) == 4 and all(p.count() == 0 for p in e)


def test_labels_balance_and_split(spark):
    d_tr, d_te, o_tr, o_te = D.labelled_datasets(_delays(spark), "DS4", T, 1.0, key_cols=["id"])
    delayed = d_tr.union(d_te).collect()
    on_time = o_tr.union(o_te).collect()
    assert {r["id"] for r in delayed} == {1, 3, 4, 5}
    assert {r["FT_OnTime"] for r in delayed} == {0} and {r["FT_OnTime"] for r in on_time} == {1}
    # on-time (4 rows) is not larger than delayed (4 rows): kept whole
    assert {r["id"] for r in on_time} == {2, 7, 8, 9}
    # DS1 has one delayed row: on-time cut to exactly 1 row, the smallest md5(id)
    d_tr, d_te, o_tr, o_te = D.labelled_datasets(_delays(spark), "DS1", T, 1.0, key_cols=["id"])
    kept = [r["id"] for r in o_tr.union(o_te).collect()]
    import hashlib
    expect = min([2, 7, 8, 9], key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert kept == [expect]
    # a single row goes to train
    assert d_tr.count() == 1 and d_te.count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_split_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    tr, te = D.train_test_split(df, ["k"], 75, count=n)
    a, b = {r["k"] for r in tr.collect()}, {r["k"] for r in te.collect()}
    assert a | b == set(range(n)) and not (a & b)
    if n == 1:
        assert a == {0}
    if n == 1000:
        assert 650 < len(a) < 850
    # reproducible: same split again
    assert {r["k"] for r in D.train_test_split(df, ["k"], 75, count=n)[0].collect()} == a


def test_smallest_by_hash_multi_round(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").withColumn("p", F.col("k") % 7)
    expect = [r["k"] for r in df.withColumn("h", S.md5_hex("k")).orderBy("h").limit(1234).collect()]
    # tiny final bucket forces several histogram rounds
    got = D.smallest_by_hash(df, 1234, ["k"])
    assert sorted(r["k"] for r in got.collect()) == sorted(expect)
    assert D.smallest_by_hash(df, 0, ["k"]).count() == 0
    assert D.smallest_by_hash(df, 9999, ["k"]).count() == 5000


def test_smallest_by_hash_keeps_rows_apart(spark):
    rows = [(1, "a", None, None), (1, None, "a", None), (1, None, None, "a")]
    df = spark.createDataFrame(rows, "k int, x string, y string, z string")
    for keys in (None, ["k"]):
        got = D.smallest_by_hash(df, 2, keys).collect()
        assert len(got) == len(set(got)) == 2, keys


def test_smallest_by_hash_identical_rows(spark):
    df = spark.range(300).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    got = D.smallest_by_hash(df, 120, None)
    assert got.count() == 120 and got.distinct().count() == 1


def test_hash_fraction_is_approximate(spark):
    df = spark.range(10000).withColumnRenamed("id", "k")
    n = D.hash_fraction(df, 2500, 10000, ["k"]).count()
    assert 2200 < n < 2800
