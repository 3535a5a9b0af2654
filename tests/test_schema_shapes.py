"""Full-width default recipes: the table shapes of the original workflow
(14 fact columns + 4 keys = 18; 28 observation columns + 2 keys = 30)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lagjoin.plans import fixtures as X
from lagjoin.plans import tables as T
from lagjoin.plans import workflow as W


def _full_weather(spark):
    e = X.table(spark, SF_SMALL, "events")
    eid, v = F.col("event_id"), F.col("value")
    cols = [(F.col("user_id") % 20).cast("string").alias("WBAN"),
            (F.hour("ts") * 100).cast("string").alias("Time"),
            F.lit("12").alias("StationType")]
    for i, m in enumerate(T.OBS_MEASURES):
        if m in T.OBS_TEXT_MEASURES:
            val = F.col("event_type")
        else:
            val = F.when(eid % (7 + i) == 0, F.lit("M")).otherwise((v + i).cast("string"))
        cols += [val.alias(m), F.when(eid % (5 + i) == 0, "s").otherwise(" ").alias(T.flag_of(m))]
    cols += [F.year("ts").alias("Year"), F.col("ts").cast("date").alias("Date")]
    return e.select(*cols)


def test_default_recipes_and_long_join_shape(spark):
    st = X.stations(spark, SF_SMALL)
    raw_w = _full_weather(spark)
    assert len(raw_w.columns) == 45
    ot = T.observation_table(raw_w, st)
    assert len(ot.columns) == 28
    dtypes = dict(ot.dtypes)
    assert dtypes["OT_Visibility"] == "double" and dtypes["OT_SkyCondition"] == "string"
    assert dtypes["OT_WEATHER_TIMESTAMP"] == "timestamp_ntz"
    ft = T.fact_table(X.raw_event_facts(spark, SF_SMALL), st)
    assert len(ft.columns) == 14
    cols, lines = W.join(W.with_row_id(ft), ot, "both", dedupe="mean")
    # long: 15 fact (+ row id) + 4 keys + lag + 2 lag times + 30 + 30 observation columns
    assert len(lines.columns) == 15 + 4 + 3 + 30 + 30
    assert lines.count() >= 12 * ft.count()
    # wide: facts + keys + 24 lag times + 12 x 2 x 30 observation columns
    assert len(cols.columns) == 15 + 4 + 24 + 12 * 2 * 30
    assert cols.count() == ft.count()
    assert cols.where(F.col("OT_Visibility_Part_0").isNotNull()).count() > 0
