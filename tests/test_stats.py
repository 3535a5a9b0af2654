import pytest

from lagjoin.operators import columns as C
from lagjoin.operators import stats as A

COLS = ("Year int, OP_CARRIER_FL_NUM string, OP_CARRIER_AIRLINE_ID string, ORIGIN_AIRPORT_ID string, "
        "DEST_AIRPORT_ID string, ARR_DELAY_NEW double, CANCELLED string, DIVERTED string, "
        "WEATHER_DELAY string, NAS_DELAY string")


def _facts(spark):
    rows = [(2012, "1", "AA", "10", "20", 15.0, "0.00", "0", "5", "5"),    # = threshold: both classes
            (2012, "2", "AA", "10", "21", 3.0, "0.00", "0", None, "1"),   # on time
            (2012, None, "BB", "10", "20", None, "1.00", "0", None, None),  # cancelled, NULL delay
            (2012, "4", "BB", "11", "20", 40.0, "0", "1", "10", "10"),    # delayed + diverted
            (2013, "5", "AA", "11", "22", 0.0, "0", "0", "0", "0")]
    return spark.createDataFrame(rows, COLS)


def test_airport_summary(spark):
    out = {r["ORIGIN_AIRPORT_ID"]: tuple(r)[1:] for r in A.airport_summary(_facts(spark)).collect()}
    assert out["10"] == (2, 2, 2)     # NULL carrier number not counted
    assert out["11"] == (2, 2, 2)


def test_carrier_performance_semantics(spark):
    out = {r["year"]: r for r in A.carrier_performance(_facts(spark), on_time=15).collect()}
    r = out[2012]
    # on-time {15, 3} = 2, delayed {15, 40} = 2, cancelled 1, diverted 1 -> total 6
    assert r["nbs de vol"] == 3
    assert r["% On-time"] == pytest.approx(200 / 6)
    assert r["% Delayed"] == pytest.approx(200 / 6)
    assert r["% Cancelled"] == pytest.approx(100 / 6)
    assert r["% Diverted"] == pytest.approx(100 / 6)


def test_delay_breakdown(spark):
    out = {r["year"]: r for r in A.delay_breakdown(_facts(spark)).collect()}
    # 2012 non-zero delays: 15, 3, 40 (NULL excluded) -> total 58; weather 5+10; NAS 5+1+10
    r = out[2012]
    assert r["% Weather_delay"] == pytest.approx(15 / 58 * 100)
    assert r["% Nas_delay"] == pytest.approx(16 / 58 * 100)
    assert r["% Other_delay"] == pytest.approx((58 - 31) / 58 * 100)
    assert 2013 not in out    # only a zero delay


def test_top_value_and_union(spark):
    df = _facts(spark)
    top = C.top_value(df, "OP_CARRIER_AIRLINE_ID").first()
    assert (top["OP_CARRIER_AIRLINE_ID"], top["count"]) == ("AA", 3)
    u = C.union_all([df.select("Year", "ARR_DELAY_NEW"), df.select("ARR_DELAY_NEW", "Year")])
    assert u.count() == 10 and u.columns == ["Year", "ARR_DELAY_NEW"]
