"""The versioned load: ordered, atomic, repeatable; zones, compaction, log."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from hourlake.operators import load as LD
from hourlake.operators import versions as V
from hourlake.sources import zones

MEASURES = ("place string, slot long, hour_ts timestamp_ntz, temperature double, humidity long, pressure long, wind_speed double, "
            "aqi long, pm25 double, pm10 double, no2 double, o3 double, weather_status string, air_status string, batch_id string")


def measure(place, hour, aqi, day=1):
    ts = datetime.datetime(2024, 1, day, hour)
    return (place, int(ts.strftime("%Y%m%d%H")), ts, 10.0, 50, 1000, 1.0, aqi, 1.0, 2.0, 3.0, 4.0, "OK", None, None)


@pytest.fixture()
def warehouse(spark, tmpdir_path):
    return V.Warehouse(spark, f"{tmpdir_path}/wh")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_load_adds_members_and_merges(spark, warehouse):
    first = spark.createDataFrame([measure("B", 1, 10), measure("A", 1, 20), measure("A", 2, 30, day=2)], MEASURES)
    assert LD.load_run(warehouse, first, "manual__1", "2024-01-03 00:00:00") == 1
    second = spark.createDataFrame([measure("A", 1, 21), measure("0", 5, 40)], MEASURES)
    rejects = spark.createDataFrame([("X", 1, "dead_row")], "place string, slot long, reason string")
    assert LD.load_run(warehouse, second, "manual__2", "2024-01-04 00:00:00", rejects) == 2
    # keys of old places stay, a new place gets the next although it sorts first
    assert rows(warehouse.read("places"), "place", "place_id") == [("0", 3), ("A", 1), ("B", 2)]
    t1, t2 = datetime.datetime(2024, 1, 3), datetime.datetime(2024, 1, 4)
    assert rows(warehouse.read("fact"), "place_id", "slot", "aqi", "batch_id", "inserted_at", "modified_at", "air_status") == [
        (1, 2024010101, 21, "manual__2", t1, t2, "OK"), (1, 2024010202, 30, "manual__1", t1, t1, "OK"),
        (2, 2024010101, 10, "manual__1", t1, t1, "OK"), (3, 2024010105, 40, "manual__2", t2, t2, "OK")]
    log = warehouse.read("load_log").orderBy("loaded_at").collect()
    assert [(r.batch_id, r.staged, r.inserted, r.updated, r.rejected, r.new_places, r.new_times) for r in log] == [
        ("manual__1", 3, 3, 0, 0, 2, 2), ("manual__2", 2, 1, 1, 1, 1, 1)]
    # the log equals counts taken the slow way
    old, new = warehouse.read("fact", 1), warehouse.read("fact", 2)
    assert new.join(old, ["place_id", "slot"], "left_anti").count() == log[1].inserted
    assert new.filter("batch_id = 'manual__2'").join(old, ["place_id", "slot"], "left_semi").count() == log[1].updated
    # the day that the second load didn't touch keeps its folder
    one, two = warehouse.manifest(1)["fact"].folders, warehouse.manifest(2)["fact"].folders
    assert one["2024-01-02"] == two["2024-01-02"] and one["2024-01-01"] != two["2024-01-01"]
    # an older version is still there
    assert rows(warehouse.read("fact", 1), "place_id", "slot", "aqi") == [(1, 2024010101, 20), (1, 2024010202, 30), (2, 2024010101, 10)]


def test_load_again_changes_nothing(spark, warehouse):
    batch = spark.createDataFrame([measure("A", 1, 20), measure("B", 1, 10)], MEASURES)
    LD.load_run(warehouse, batch, "manual__1", "2024-01-03 00:00:00")
    before = {n: rows(warehouse.read(n), "*") for n in ("places", "times", "fact")}
    LD.load_run(warehouse, batch, "manual__1", "2024-01-03 00:00:00")
    assert {n: rows(warehouse.read(n), "*") for n in before} == before


def test_load_that_dies_between_dimensions_and_facts(spark, warehouse, monkeypatch):
    LD.load_run(warehouse, spark.createDataFrame([measure("A", 1, 20)], MEASURES), "manual__1", "2024-01-03 00:00:00")
    before = {n: rows(warehouse.read(n), "*") for n in ("places", "times", "fact")}
    batch = spark.createDataFrame([measure("A", 1, 99), measure("Z", 9, 10)], MEASURES)

    def dies(*args, **kw):
        raise RuntimeError("lost")

    monkeypatch.setattr(LD, "_merge_days", dies)
    with pytest.raises(RuntimeError, match="lost"):
        LD.load_run(warehouse, batch, "manual__2", "2024-01-04 00:00:00")
    assert warehouse.versions() == [1]
    assert {n: rows(warehouse.read(n), "*") for n in before} == before
    monkeypatch.undo()
    LD.load_run(warehouse, batch, "manual__2", "2024-01-04 00:00:00")
    assert rows(warehouse.read("fact"), "place_id", "aqi") == [(1, 99), (2, 10)]


def test_duplicate_keys_fail_the_load(spark, warehouse):
    batch = spark.createDataFrame([measure("A", 1, 20), measure("A", 1, 21)], MEASURES)
    with pytest.raises(Exception, match="duplicate upsert key"):
        LD.load_run(warehouse, batch, "manual__1", "2024-01-03 00:00:00")
    assert warehouse.versions() == []


def test_empty_load(spark, warehouse):
    assert LD.load_run(warehouse, spark.createDataFrame([], MEASURES), "manual__1", "2024-01-03 00:00:00") == 1
    assert warehouse.read("fact").count() == 0 and warehouse.read("places").count() == 0
    LD.load_run(warehouse, spark.createDataFrame([measure("A", 1, 20)], MEASURES), "manual__2", "2024-01-03 00:00:00")
    assert warehouse.read("fact").count() == 1


def test_two_loads_at_once_conflict(spark, warehouse):
    tables = {"places": warehouse.write("places", spark.createDataFrame([(1, "A")], "place_id int, place string"), "x")}
    assert warehouse.commit(tables, None) == 1
    with pytest.raises(V.CommitConflict):
        warehouse.commit(tables, None)
    assert warehouse.commit(tables, 1) == 2


def test_staging_is_reset(spark, warehouse):
    frame = spark.createDataFrame([(1,)], "x int")
    warehouse.stage("a", {"t": frame})
    again = warehouse.stage("a", {"t": frame})["t"]
    assert again.count() == 2  # appends
    warehouse.reset_staging()
    assert warehouse.stage("a", {"t": frame})["t"].count() == 1


def test_withdrawn_batch_and_rollback(spark, warehouse):
    LD.load_run(warehouse, spark.createDataFrame([measure("A", 1, 20), measure("A", 2, 30, day=2)], MEASURES), "manual__1", "2024-01-03 00:00:00")
    LD.load_run(warehouse, spark.createDataFrame([measure("A", 3, 50, day=3), measure("A", 4, 60)], MEASURES), "manual__2", "2024-01-04 00:00:00")
    LD.delete_batch(warehouse, "fact", "manual__2")
    assert rows(warehouse.read("fact"), "slot") == [(2024010101,), (2024010202,)]
    assert sorted(warehouse.manifest()["fact"].folders) == ["2024-01-01", "2024-01-02"]  # the day it owned is gone
    assert warehouse.roll_back_to(2) == 4
    assert warehouse.read("fact").count() == 4


def test_compaction_and_retention(spark, warehouse):
    frame = spark.range(0, 3000).select(F.col("id"), F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("day"))
    entry = warehouse.write("t", frame.filter("id < 1000"), "a", "day")
    entry = warehouse.appended_entry(entry, warehouse.write("t", frame.filter("id BETWEEN 1000 AND 1999"), "b", "day"))
    entry = warehouse.appended_entry(entry, warehouse.write("t", frame.filter("id >= 2000"), "c", "day"))
    warehouse.commit({"t": entry}, None)
    old = warehouse.read("t")
    assert len(warehouse._files(sum(warehouse.manifest()["t"].folders.values(), []))) == 9
    assert warehouse.compact("t") == 2
    assert len(warehouse._files(sum(warehouse.manifest()["t"].folders.values(), []))) == 3
    assert rows(warehouse.read("t"), "id", "day") == rows(frame, "id", "day")
    assert warehouse.compact("t") is None
    size = warehouse._files(warehouse.manifest()["t"].folders["2024-01-01"])[0]
    assert warehouse.compact("t", target_bytes=size // 2) is None  # one file is no more than two
    assert warehouse.retain("t", "2024-01-02") == 3 and warehouse.retain("t", "2024-01-02") is None
    assert {r.day for r in warehouse.read("t").collect()} == {"2024-01-02", "2024-01-03"}
    assert old.count() == 3000  # a reader of the first version is undisturbed
    gone = warehouse.vacuum(keep=1)
    assert sorted(gone) == ["load=a", "load=b", "load=c"] and warehouse.versions() == [3]
    assert warehouse.read("t").count() == 2000


def test_pruned_read(spark, warehouse):
    frame = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, day string")
    warehouse.commit({"t": warehouse.write("t", frame, "a", "day")}, None)
    one = warehouse.read("t", partitions=["2024-01-02", "2024-01-09"])
    assert rows(one, "id") == [(2,)] and len(one.inputFiles()) == 1


def test_predictions_and_alerts(spark, warehouse):
    warehouse.commit({"places": warehouse.write("places", spark.createDataFrame([(1, "A"), (2, "B")], "place_id int, place string"), "p")}, None)
    t = datetime.datetime(2024, 1, 1, 5)
    scored = spark.createDataFrame([("A", t, 120, "ALERTE"), ("B", t, 80, "OK"), ("?", t, 300, "ALERTE")],
                                   "place string, target_ts timestamp_ntz, aqi_pred int, alert string")
    scored = scored.withColumn("aqi_pred", F.col("aqi_pred").cast("decimal(6,2)"))
    assert LD.store_predictions(warehouse, scored, "scheduled__1", "2024-01-01 04:00:00") == (2, 0)
    assert LD.store_predictions(warehouse, scored, "scheduled__1", "2024-01-01 04:00:00") == (0, 2)  # again
    better = scored.filter("place = 'A'").withColumns({"aqi_pred": F.lit(90).cast("decimal(6,2)"), "alert": F.lit("OK")})
    assert LD.store_predictions(warehouse, better, "scheduled__2", "2024-01-01 05:00:00") == (0, 1)
    assert [(r.place_id, float(r.aqi_pred), r.alert, r.batch_id) for r in warehouse.read("predictions").orderBy("place_id").collect()] == [
        (1, 90.0, "OK", "scheduled__2"), (2, 80.0, "OK", "scheduled__1")]
    assert rows(warehouse.read("alerts"), "place", "batch_id") == [("A", "scheduled__1")]
    none = scored.limit(0)
    assert LD.store_predictions(warehouse, none, "scheduled__3", "2024-01-01 06:00:00") == (0, 0)


def test_local_now(spark):
    row = spark.range(1).select(LD.local_now(now="2024-01-15 12:00:00").alias("winter"), LD.local_now(now="2024-07-15 12:00:00").alias("summer"),
                                LD.local_now().alias("now"), F.convert_timezone(F.lit("UTC"), F.lit("Europe/Paris"), F.localtimestamp()).alias("want")).first()
    assert (row.winter.hour, row.summer.hour) == (13, 14)
    assert abs((row.now - row.want).total_seconds()) < 5


# Hourly zones

HOURS = [("2024", "01", "01", "00"), ("2024", "01", "01", "01"), ("2024", "01", "02", "00")]


def test_zones(spark, tmpdir_path):
    root = f"{tmpdir_path}/{zones.CLEANED}"
    frame = spark.createDataFrame([("A", datetime.datetime(2024, 1, 1, 0), 1), ("A", datetime.datetime(2024, 1, 1, 1), 2),
                                   ("B", datetime.datetime(2024, 1, 2, 0), 3)], "place string, hour_ts timestamp_ntz, x int")
    zones.write_hours(frame, root)
    one = zones.read_hours(spark, root, frame.schema, [HOURS[1], ("2030", "01", "01", "00")])
    assert rows(one, "place", "x", "hour") == [("A", 2, "01")] and len(one.inputFiles()) == 1
    assert rows(zones.read_hours(spark, root, frame.schema), "x", "month") == [(1, "01"), (2, "01"), (3, "01")]
    zones.write_hours(frame.filter("x = 2").withColumn("x", F.lit(9)), root, hours=HOURS[:2])  # the first hour has no rows now
    assert rows(zones.read_hours(spark, root, frame.schema), "x") == [(3,), (9,)]
    assert zones.read_hours(spark, f"{root}-none", frame.schema, HOURS).count() == 0
    assert zones.hour_of(2024010100) == HOURS[0]


def test_rejects_of_a_run_are_replaced(spark, tmpdir_path):
    root = f"{tmpdir_path}/{zones.MODEL_REJECTS}"
    kind = "place string, reason string, context map<string,string>, hour_ts timestamp_ntz"
    t = datetime.datetime(2024, 1, 1, 0)
    zones.write_model_rejects(spark.createDataFrame([("A", "forecast unavailable", {}, t), ("B", "no future", {"last": "x"}, t)], kind), root)
    got = zones.read_model_rejects(spark, root, HOURS[:1])
    assert rows(got, "place", "reason") == [("A", "forecast unavailable"), ("B", "no future")]
    line = json.loads(sorted(r.value for r in spark.read.text(root).collect())[1])
    assert line["place"] == "B" and line["context"] == {"last": "x"}
    zones.write_model_rejects(spark.createDataFrame([], kind), root, hours=HOURS[:1])
    assert zones.read_model_rejects(spark, root, HOURS[:1]).count() == 0
