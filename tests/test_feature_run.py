"""Feature zones, reject zones and scoring of runs, end to end."""

import datetime

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from hourlake.operators import feature_run as FR
from hourlake.operators import features as FE
from hourlake.operators import model as ML
from hourlake.operators import versions as V
from hourlake.sources import zones

T0 = datetime.datetime(2024, 1, 6, 0)  # a Saturday
PLACES = ["A", "B", "C"]
MEASURES = "place string, slot long, hour_ts timestamp_ntz, temperature double, humidity long, pressure long, wind_speed double, aqi long"


def at(h):
    return T0 + datetime.timedelta(hours=h)


def slot(h):
    return int(at(h).strftime("%Y%m%d%H"))


@pytest.fixture(scope="module")
def inputs(spark):
    rows = [(p, slot(h), at(h), 10.0 + h, 50, 1000, 2.0, (20 if p == "A" else 150) + h) for p in "AB" for h in range(10) if (p, h) != ("B", 9)]
    measures = spark.createDataFrame(rows, MEASURES)
    runs = spark.createDataFrame([(slot(8), at(8)), (slot(9), at(9))], "slot long, run_ts timestamp_ntz")
    docs = [(slot(r), p, at(r + k), 10 * k, k, float(k % 2)) for r in (8, 9) for p in "AB" for k in range(-2, 8)]
    docs += [(slot(8), "C", at(9), 1, 1, None)]
    forecasts = spark.createDataFrame(docs, "slot long, place string, fc_ts timestamp_ntz, wind_direction int, cloud_cover int, precipitation double")
    return measures, runs, forecasts


def test_runs_take_their_own_forecast(inputs):
    measures, runs, forecasts = inputs
    rows = FR.run_features(measures, runs, forecasts, PLACES).collect()
    by = {}
    for r in rows:
        by.setdefault((r.place, r.run_slot), []).append(r)
    assert set(by) == {("A", slot(8)), ("A", slot(9)), ("B", slot(8))}
    for (place, run), some in by.items():
        h = 8 if run == slot(8) else 9
        some.sort(key=lambda r: r.target_ts)
        assert [r.target_ts for r in some] == [at(h + k) for k in range(1, 7)]
        assert [r.cloud_cover for r in some] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
        assert [r.precipitation_bin for r in some] == [1, 0, 1, 0, 1, 0]
        assert {r.aqi_mean_6h for r in some} == {(20 if place == "A" else 150) + h - 3.5}  # the six hours before
        assert {(r.place_A, r.place_B, r.place_C) for r in some} == {(1, 0, 0) if place == "A" else (0, 1, 0)}
        assert {r.is_weekend for r in some} == {1}


def test_zones_and_verdicts(spark, inputs, tmpdir_path):
    measures, runs, forecasts = inputs
    verdicts = {r.slot: (r.n_rejected, r.verdict) for r in FR.feature_run(tmpdir_path, measures, runs, forecasts, PLACES).collect()}
    assert verdicts == {slot(8): (1, "partial"), slot(9): (2, "partial")}
    hours = [zones.hour_of(slot(8)), zones.hour_of(slot(9))]
    rejects = zones.read_model_rejects(spark, f"{tmpdir_path}/{zones.MODEL_REJECTS}", hours)
    assert sorted((r.hour, r.place, r.reason) for r in rejects.collect()) == [
        ("08", "C", FE.NO_CLEANED_ROW), ("09", "B", FE.NO_CLEANED_ROW), ("09", "C", FE.NO_CLEANED_ROW)]
    stored = zones.read_hours(spark, f"{tmpdir_path}/{zones.FEATURES}", FR.feature_schema(PLACES), hours[1:])
    assert stored.count() == 6 and {r.place for r in stored.collect()} == {"A"}
    # the late row arrives and the run is built again
    late = measures.unionByName(measures.filter(f"slot = {slot(8)} AND place = 'B'").withColumns(
        {"slot": F.lit(slot(9)), "hour_ts": F.lit(at(9))}))
    FR.feature_run(tmpdir_path, late, runs.filter(f"slot = {slot(9)}"), forecasts, PLACES)
    rejects = zones.read_model_rejects(spark, f"{tmpdir_path}/{zones.MODEL_REJECTS}", hours)
    assert sorted((r.hour, r.place) for r in rejects.collect()) == [("08", "C"), ("09", "C")]
    none = FR.feature_run(tmpdir_path, late.limit(0), runs, forecasts, PLACES)
    assert {r.verdict for r in none.collect()} == {"none"}
    assert zones.read_hours(spark, f"{tmpdir_path}/{zones.FEATURES}", FR.feature_schema(PLACES), hours).count() == 0


def test_scoring_run(spark, inputs, tmpdir_path):
    measures, runs, forecasts = inputs
    FR.feature_run(tmpdir_path, measures, runs, forecasts, PLACES)
    names = FE.feature_names(PLACES)
    stored = zones.read_hours(spark, f"{tmpdir_path}/{zones.FEATURES}", FR.feature_schema(PLACES))
    train = stored.withColumn("target", F.when(F.col("place") == "A", 30.0).otherwise(160.0))
    model = ML.pipeline(names, DecisionTreeRegressor(labelCol="target", featuresCol="features", maxDepth=2)).fit(ML._double_features(train, names))
    warehouse = V.Warehouse(spark, f"{tmpdir_path}/wh")
    warehouse.commit({"places": warehouse.write("places", spark.createDataFrame([(1, "A"), (2, "B")], "place_id int, place string"), "p")}, None)
    done = FR.scoring_run(warehouse, model, tmpdir_path, runs, PLACES, "scheduled__1", "2024-01-06 09:00:00")
    assert done == (13, 0)  # A: hours 9 to 15, B: 9 to 14
    assert FR.scoring_run(warehouse, model, tmpdir_path, runs, PLACES, "scheduled__1", "2024-01-06 09:00:00") == (0, 13)
    rows = warehouse.read("predictions").groupBy("place_id", "alert").count().collect()
    assert sorted(map(tuple, rows)) == [(1, "OK", 7), (2, "ALERTE", 6)]
    assert warehouse.read("alerts").count() == 6
    nothing = runs.select((F.col("slot") + 100).alias("slot"), "run_ts")
    assert FR.scoring_run(warehouse, model, tmpdir_path, nothing, PLACES, "scheduled__2", "2024-01-07 09:00:00") == (0, 0)
