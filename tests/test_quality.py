import math

import pytest

from lagjoin.operators import quality as Q

NAN = float("nan")


def _raw_obs(spark):
    # x: 1 null + 1 NaN of 10 (20 % -> NOT imputed at 0.20); y: 1 of 10 (imputed)
    # k: int column with a null (imputed with the truncated mean)
    rows = [
        (1, None, 1.0, 1, "a", "s", "s"),
        (2, NAN, 2.0, 2, "a", " ", " "),
        (3, 3.0, None, 4, "b", " ", None),
        (4, 4.0, 4.0, None, "b", " ", " "),
        (5, 5.0, 5.0, 5, None, " ", "s"),
        (6, 6.0, 6.0, 6, None, " ", " "),
        (7, 7.0, 7.0, 7, "c", " ", " "),
        (8, 8.0, 8.0, 8, "", "s", " "),
        (9, 9.0, 9.0, 9, "c", None, " "),
        (10, 10.0, 10.0, 10, "a", " ", " "),
    ]
    return spark.createDataFrame(rows, "id int, x double, y double, k int, txt string, xf string, tf string")


def test_missing_report(spark):
    rep = {r["Column"]: (r["Missing_values"], r["Pct_missing_values"])
           for r in Q.missing_report(_raw_obs(spark)).collect()}
    assert rep["x"] == (2, 20.0)      # null + NaN
    assert rep["y"] == (1, 10.0)
    assert rep["k"] == (1, 10.0)
    assert rep["txt"] == (3, 30.0)    # two nulls + ''
    assert rep["id"] == (0, 0.0)


def test_missing_report_empty_table(spark):
    rep = Q.missing_report(_raw_obs(spark).limit(0)).collect()
    assert all(r["Missing_values"] == 0 and r["Pct_missing_values"] is None for r in rep)


def test_flag_report(spark):
    df = _raw_obs(spark).withColumnRenamed("xf", "xFlag").withColumnRenamed("tf", "tFlag")
    rep = {r["FlagColumn"]: r["Count"] for r in Q.flag_report(df).collect()}
    assert rep == {"xFlag": 2, "tFlag": 2}
    assert Q.flag_report(_raw_obs(spark)).count() == 0


def test_impute_threshold_is_strict(spark):
    out = {r["id"]: r for r in Q.impute_mean(_raw_obs(spark), 0.20).collect()}
    assert out[1]["x"] is None and math.isnan(out[2]["x"])    # exactly 20 %: untouched
    mean_y = (1 + 2 + 4 + 5 + 6 + 7 + 8 + 9 + 10) / 9
    assert out[3]["y"] == pytest.approx(mean_y)
    assert out[4]["k"] == int((1 + 2 + 4 + 5 + 6 + 7 + 8 + 9 + 10) / 9)   # int stays int
    out2 = {r["id"]: r for r in Q.impute_mean(_raw_obs(spark), 0.21).collect()}
    assert out2[1]["x"] == pytest.approx((3 + 4 + 5 + 6 + 7 + 8 + 9 + 10) / 8)


def test_impute_median_strategy(spark):
    out = {r["id"]: r for r in Q.impute_mean(_raw_obs(spark), 0.5, strategy="median").collect()}
    assert out[3]["y"] == 6.0


def test_flag_correction_numeric_sees_imputed_values(spark):
    df = _raw_obs(spark)
    out = {r["id"]: r for r in Q.impute_and_correct(df, ["y"], ["xf"], threshold=0.2).collect()}
    mean_y = (1 + 2 + 4 + 5 + 6 + 7 + 8 + 9 + 10) / 9
    # reference set: xf != 's' (rows 2..7, 10; row 9 has NULL flag, excluded);
    # row 3's y is imputed first
    ref = [2.0, mean_y, 4.0, 5.0, 6.0, 7.0, 10.0]
    assert out[1]["y"] == pytest.approx(sum(ref) / len(ref))
    assert out[8]["y"] == pytest.approx(sum(ref) / len(ref))
    assert out[9]["y"] == 9.0     # NULL flag: kept


def test_flag_correction_nan_propagates_without_imputation(spark):
    out = {r["id"]: r for r in Q.correct_by_flag(_raw_obs(spark), ["x"], ["xf"]).collect()}
    assert math.isnan(out[8]["x"])          # mean over a set containing NaN is NaN


def test_mode_correction_tie_and_null_group(spark):
    df = _raw_obs(spark)
    # tf != 's': ids 1,2,4,6,7,8,9,10 -> txt a,a,b,None,c,'',c,a -> 'a' (3)
    out = {r["id"]: r["txt"] for r in Q.correct_by_flag(df, ["txt"], ["tf"]).collect()}
    assert out[5] == "a"
    # tie: only ids 4 ('b') and 6 (None) as reference rows -> NULL wins (NULL first)
    small = df.where("id in (4, 5, 6)")
    out = {r["id"]: r["txt"] for r in Q.correct_by_flag(small, ["txt"], ["tf"]).collect()}
    assert out[5] is None and out[4] == "b"


def test_all_flagged_column_unchanged(spark):
    df = _raw_obs(spark).where("xf = 's'")
    out = Q.correct_by_flag(df, ["y", "txt"], ["xf", "xf"]).orderBy("id").collect()
    assert [r["y"] for r in out] == [1.0, 8.0] and [r["txt"] for r in out] == ["a", ""]


def test_mode_and_mean_helpers(spark):
    df = _raw_obs(spark)
    m = Q.mode_where(df, "txt").first()
    assert (m["value"], m["count"]) == ("a", 3)
    assert Q.mean_where(df, "y", "xf").first()["mean"] == pytest.approx((2 + 4 + 5 + 6 + 7 + 10) / 6)


def test_columns_by(spark):
    df = _raw_obs(spark)
    assert Q.columns_by(df, kind="imputable") == ["id", "x", "y", "k"]
    assert Q.columns_by(df, suffix="f") == ["xf", "tf"]


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        Q.impute_and_correct(_raw_obs(spark), ["x"], [])
    with pytest.raises(ValueError):
        Q.impute_and_correct(_raw_obs(spark), ["nope"], ["xf"])


def test_odd_names_in_repairs(spark):
    df = _raw_obs(spark).withColumnRenamed("y", "y.val").withColumnRenamed("xf", "x flag")
    out = {r["id"]: r for r in Q.impute_and_correct(df, ["y.val"], ["x flag"], 0.2).collect()}
    assert out[3]["y.val"] == pytest.approx((1 + 2 + 4 + 5 + 6 + 7 + 8 + 9 + 10) / 9)
    assert Q.mean_where(df, "y.val", "x flag").first()["mean"] is not None
    assert Q.mode_where(df, "y.val", "x flag").count() == 1
