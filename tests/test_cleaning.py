"""Cleaning cases (FIXTURES.md §2) on hand-made frames."""

from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import clean as C


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


SCHEMA = ("place string, slot long, ts timestamp_ntz, event_id long, country string, temperature string, "
          "humidity string, pressure string, wind_speed string, aqi string, pm25 string, pm10 string, "
          "no2 string, o3 string")


def _row(place="Lyon", slot=2023010112, ts="2023-01-01 12:00:00", eid=1, country="FR", t="20.5", h="50",
         p="1013", w="3.2", aqi="40", pm25="10", pm10="12", no2="5", o3="30"):
    import datetime
    return (place, slot, datetime.datetime.fromisoformat(ts), eid, country, t, h, p, w, aqi, pm25, pm10, no2, o3)


def test_coercion_bad_text_becomes_null(spark):
    df = _frame(spark, [_row(t="abc"), _row(place="Nice", t="21")], SCHEMA)
    valid, _ = C.apply_cleaning_rules(df)
    got = {r.place: r.temperature for r in valid.collect()}
    assert got == {"Lyon": None, "Nice": 21.0}


def test_country_default(spark):
    df = _frame(spark, [_row(country=None)], SCHEMA)
    valid, _ = C.apply_cleaning_rules(df)
    assert valid.first().country == "ND"


def test_status_weather_failed_air_ok(spark):
    df = _frame(spark, [_row(t=None, h=None, p=None, w=None)], SCHEMA)
    r = C.apply_cleaning_rules(df)[0].first()
    assert (r.weather_status, r.air_status) == ("FAILED", "OK")


def test_one_pollutant_missing_keeps_air_ok(spark):
    r = C.apply_cleaning_rules(_frame(spark, [_row(pm25=None)], SCHEMA))[0].first()
    assert r.air_status == "OK"


def test_dead_row_rejected_not_dropped(spark):
    dead = _row(t=None, h=None, p=None, w=None, aqi=None, pm25=None, pm10=None, no2=None, o3=None)
    valid, rejects = C.apply_cleaning_rules(_frame(spark, [dead, _row(place="Nice")], SCHEMA))
    assert valid.count() == 1
    assert [r.reject_reason for r in rejects.collect()] == ["dead_row"]


def test_missing_key_rejected(spark):
    valid, rejects = C.apply_cleaning_rules(_frame(spark, [_row(place=None), _row(slot=None, place="Nice")], SCHEMA))
    assert valid.count() == 0
    assert sorted(r.reject_reason for r in rejects.collect()) == ["missing_key", "missing_key"]


def test_duplicate_keeps_last_by_time_then_id(spark):
    rows = [_row(ts="2023-01-01 12:05:00", eid=1, t="1"), _row(ts="2023-01-01 12:09:00", eid=2, t="2"),
            _row(ts="2023-01-01 12:09:00", eid=3, t="3")]
    valid, _ = C.apply_cleaning_rules(_frame(spark, rows, SCHEMA))
    assert [r.temperature for r in valid.collect()] == [3.0]


def test_range_flag(spark):
    df = spark.createDataFrame([(-60.0,), (61.0,), (None,), (20.0,)], "t double")
    got = [r.f for r in df.select(X.range_flag("t").alias("f")).collect()]
    assert got == [False, False, True, True]


def test_missing_columns_added(spark):
    df = spark.createDataFrame([("Lyon", 2023010112)], "place string, slot long")
    out = C.ensure_columns(df)
    assert len(out.columns) == 14
    assert out.first().pm25 is None


def test_one_source_empty_keeps_rows(spark):
    from hourlake.operators.merge import full_outer_merge
    w = spark.createDataFrame([("Lyon", 1, 20.0)], "place string, slot long, temperature double")
    a = spark.createDataFrame([], "place string, slot long, aqi int")
    m = C.add_source_status(C.ensure_columns(full_outer_merge(w, a, ("place", "slot"), ())))
    r = m.first()
    assert (r.place, r.weather_status, r.air_status) == ("Lyon", "OK", "FAILED")


def test_valid_plus_rejects_plus_duplicates_equals_input(spark):
    from hourlake.plans.catalog import Gold
    from tests.conftest import SF001
    g = Gold(spark, SF001)
    merged = g.merged
    valid, rejects = C.apply_cleaning_rules(merged, order_cols=())
    assert valid.count() + rejects.count() == merged.count()


def test_keep_last_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = C.keep_last(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_contracts_and_gates(spark):
    import pytest
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    with pytest.raises(C.ContractError):
        C.require_columns(df, ["a", "c"])
    ok, rej = C.contract_rejects(df, ["a", "z"], "2023010112")
    assert ok is None and rej.first().context == "z"
    assert C.has_rows(df) and not C.has_rows(df.limit(0))
