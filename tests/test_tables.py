import datetime as dt

import pytest

from lagjoin.plans import tables as T

RAW_FACT_COLS = ("OP_CARRIER_AIRLINE_ID string, OP_CARRIER_FL_NUM string, ORIGIN_AIRPORT_ID string, "
                 "DEST_AIRPORT_ID string, CRS_DEP_TIME string, ARR_DELAY_NEW double, CANCELLED string, "
                 "DIVERTED string, CRS_ELAPSED_TIME string, WEATHER_DELAY string, NAS_DELAY string, "
                 "_c12 string, Year int, FL_DATE date")
D = dt.date(2013, 5, 6)


def _stations(spark):
    return spark.createDataFrame(
        [("10", "3972", "-5"), ("11", "3972", "-6"), ("12", "94846", "-8")],
        "AirportID string, WBAN string, TimeZone string")


def _raw_facts(spark):
    rows = [
        ("1", "100", "10", "12", "745", 30.0, "0.00", "0", "120", None, "5", None, 2013, D),
        ("1", "101", "10", "12", "600.0", None, "0.00", "0", "M", "3", None, None, 2013, D),
        ("1", "102", "10", "11", "5", 1.0, "0.00", "0", "60", "0", "0", None, 2013, D),
        ("1", "103", "10", "11", "2400", 1.0, "0.00", "0", "60", "0", "0", None, 2013, D),
        ("1", "104", "10", "11", None, 1.0, "0.00", "0", "60", "0", "0", None, 2013, D),
        ("1", "105", "10", "11", "900", 1.0, "1.00", "0", "60", "0", "0", None, 2013, D),
        ("1", "106", "10", "11", "900", 1.0, None, "0", "60", "0", "0", None, 2013, D),
        ("1", "107", "10", "11", "900", 1.0, "0", "1", "60", "0", "0", None, 2013, D),
        ("1", "108", "99", "11", "900", 1.0, "0", "0", "60", "0", "0", None, 2013, D),
    ]
    return spark.createDataFrame(rows, RAW_FACT_COLS)


def test_fact_table(spark):
    out = {r["FT_OP_CARRIER_FL_NUM"]: r for r in T.fact_table(_raw_facts(spark), _stations(spark)).collect()}
    # cancelled ("1.00"), NULL-cancelled, diverted and unknown-origin rows are gone
    assert set(out) == {"100", "101", "102", "103", "104"}
    assert out["100"]["FT_CRS_DEP_TIME"] == "07:45"
    assert out["100"]["FT_TIMESTAMP"] == dt.datetime(2013, 5, 6, 7, 45)
    assert out["100"]["FT_WEATHER_DELAY"] == 0.0 and out["100"]["FT_NAS_DELAY"] == 5.0
    assert out["100"]["FT_Delta_Lag"] == -3
    assert out["101"]["FT_CRS_DEP_TIME"] == "06:00" and out["101"]["FT_ARR_DELAY_NEW"] == 0.0
    assert out["101"]["FT_CRS_ELAPSED_TIME"] is None
    assert out["102"]["FT_CRS_DEP_TIME"] == "00:05"
    assert out["103"]["FT_CRS_DEP_TIME"] == "24:00" and out["103"]["FT_TIMESTAMP"] is None
    assert out["104"]["FT_CRS_DEP_TIME"] == "" and out["104"]["FT_TIMESTAMP"] is None
    assert out["102"]["FT_Delta_Lag"] == -1
    assert len(next(iter(out.values()))) == 14


def test_fact_table_keep_unknown_delay(spark):
    out = {r["FT_OP_CARRIER_FL_NUM"]: r for r in
           T.fact_table(_raw_facts(spark), _stations(spark), fill_unknown_delay=False).collect()}
    assert out["101"]["FT_ARR_DELAY_NEW"] is None


def _raw_obs(spark):
    cols = ("WBAN string, Time string, StationType string, SkyCondition string, SkyConditionFlag string, "
            "Visibility string, VisibilityFlag string, Year int, Date string")
    rows = [("3972", "53", "12", "CLR", " ", "10", " ", 2013, "2013-05-06"),
            ("3972", "153", "12", "OVC", "s", "M", " ", 2013, "2013-05-06"),
            ("94846", "2353", "M", "CLR", " ", "4", "s", 2013, "2013-05-06"),
            ("777", "53", "12", "BKN", " ", "2", " ", 2013, "2013-05-06")]
    return spark.createDataFrame(rows, cols)


def test_observation_table(spark):
    out = T.observation_table(_raw_obs(spark), _stations(spark), measures=("SkyCondition", "Visibility"))
    rows = out.collect()
    # WBAN 3972 serves two airports (fan-out); 777 is unknown (dropped)
    assert len(rows) == 5
    assert "OT_SkyConditionFlag" not in out.columns
    by = {(r["OT_ORIGIN_AIRPORT_ID"], r["OT_Time"]): r for r in rows}
    r = by[("10", "0153")]
    assert r["OT_SkyCondition"] == "CLR"                      # flagged -> mode
    assert r["OT_Visibility"] is None        # 1 of 4 missing = 25 %: not imputed
    assert r["OT_WEATHER_TIMESTAMP"] == dt.datetime(2013, 5, 6, 1, 53)
    z = by[("12", "2353")]
    assert z["OT_StationType"] is None       # 'M' -> NULL, 25 % missing: kept NULL
    assert z["OT_TimeZone"] == "-8"
    assert z["OT_Visibility"] == pytest.approx((10 + 2) / 2)   # flagged -> mean of unflagged


def test_station_padding(spark):
    obs = spark.createDataFrame([("03972", 1)], "WBAN string, v int")
    assert T.join_stations(obs, _stations(spark)).count() == 0
    assert T.join_stations(obs, _stations(spark), pad_width=5).count() == 2


def test_require_rows(spark):
    with pytest.raises(ValueError):
        T.require_rows(_stations(spark).limit(0))
    T.require_rows(_stations(spark))
