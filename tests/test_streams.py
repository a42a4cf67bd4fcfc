"""Keyed streaming state, epoch files, and ingest by touched hours."""

import datetime
import json
import os

from pyspark.sql import functions as F

from hourlake.operators import clean
from hourlake.operators import load as LD
from hourlake.operators import versions as V
from hourlake.sources import raw
from hourlake.streaming import incremental as ST

T0 = datetime.datetime(2024, 1, 1, 0)
KIND = "place string, ts timestamp_ntz, event_id long, value decimal(12,2)"


def reading(place, minutes, event_id, value):
    return place, T0 + datetime.timedelta(minutes=minutes), event_id, value


def test_keyed_state_over_epochs_and_a_restart(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, n) for n in ("in", "out", "ck"))
    d = lambda x: F.lit(x).cast("decimal(12,2)")
    first = [reading("A", 5, 1, None), reading("A", 50, 2, None), reading("A", 50, 2, None), reading("B", 61, 3, None)]
    second = [reading("A", 20, 9, None), reading("A", 59, 4, None), reading("B", 62, 3, None), reading("A", 200, 5, None)]
    third = [reading("A", 201, 6, None), reading("A", 3, 7, None)]  # three hours late: its hour is closed

    def land(rows, name):
        spark.createDataFrame(rows, KIND).withColumn("value", F.col("event_id").cast("decimal(12,2)") * d(2)).withColumn(
            "value", F.col("value").cast("decimal(12,2)")).coalesce(1).write.parquet(os.path.join(src, name))

    def run():
        stream = spark.readStream.schema(spark.createDataFrame([], KIND).schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
        last = ST.last_readings(stream)
        ST.run_to_epochs(last, out, ck)
        return ST.read_epochs(spark, out, last.schema, ("place", "window_start"))

    land(first, "f1")
    run()
    land(second, "f2")
    run()  # from the checkpoint
    land(third, "f3")
    got = run()
    everything = spark.createDataFrame(first + second + third[:1], KIND)
    twin = clean.keep_last(everything.withColumn("window_start", F.date_trunc("hour", "ts").cast("timestamp_ntz")), ["place", "window_start"], ("ts", "event_id"))
    rows = lambda df: sorted((r.place, r.window_start, r.event_id) for r in df.select("place", "window_start", "event_id").collect())
    assert rows(got) == rows(twin)
    hourly = {r.window_start: (r.n_places, float(r.value_mean)) for r in ST.hourly_of(got).collect()}
    assert hourly[T0] == (1, 8.0)


def test_epoch_run_again_is_written_once(spark, tmpdir_path):
    frame = spark.createDataFrame([(1, 2)], "k int, v int")
    for _ in range(2):
        frame.write.mode("overwrite").parquet(f"{tmpdir_path}/e/{ST.EPOCH}={3:012d}")
    frame.withColumn("v", F.lit(5)).write.parquet(f"{tmpdir_path}/e/{ST.EPOCH}={10:012d}")
    assert [tuple(r) for r in ST.read_epochs(spark, f"{tmpdir_path}/e", frame.schema, ("k",)).collect()] == [(1, 5)]
    assert [tuple(r) for r in ST.read_epochs(spark, f"{tmpdir_path}/e", frame.schema).collect()] == [(1, 5)]


def payload(temp):
    return json.dumps({"main": {"temp": temp, "humidity": 40, "pressure": 1000}, "wind": {"speed": 2.0}})


def air(aqi):
    return json.dumps({"status": "ok", "data": {"aqi": str(aqi), "iaqi": {"pm25": {"v": "7"}}}})


def test_late_source_meets_the_other(spark, tmpdir_path):
    roots = [os.path.join(tmpdir_path, n) for n in ("weather", "air", "state")]
    warehouse = V.Warehouse(spark, os.path.join(tmpdir_path, "wh"))
    kind = "place string, payload string, run_ts timestamp_ntz"
    seen = []

    def land(rows, root):
        raw.land_raw(spark.createDataFrame([(p, x, T0 + datetime.timedelta(hours=h)) for p, x, h in rows], kind), root)

    def sink(cleaned, rejects, epoch):
        seen.append((epoch, cleaned.count(), rejects.count()))
        LD.load_run(warehouse, cleaned, f"scheduled__{epoch}", "2024-01-02 00:00:00")

    def fact():
        f = warehouse.read("fact").join(warehouse.read("places"), "place_id")
        return sorted((r.place, r.slot, None if r.temperature is None else float(r.temperature), r.aqi, r.air_status) for r in f.collect())

    land([("A", payload(1.5), 0), ("B", payload(2.5), 0), ("A", payload(3.5), 1), ("X", "{}", 1)], roots[0])
    land([("A", air(10), 0)], roots[1])
    ST.ingest_touched(spark, *roots, sink)
    assert fact() == [("A", 2024010100, 1.5, 10, "OK"), ("A", 2024010101, 3.5, None, "FAILED"), ("B", 2024010100, 2.5, None, "FAILED")]
    assert sum(n for _, _, n in seen) >= 1  # X has no metric at all
    land([("A", air(20), 1), ("B", json.dumps({"status": "error"}), 1)], roots[1])  # late, and an error envelope
    ST.ingest_touched(spark, *roots, sink)
    assert fact() == [("A", 2024010100, 1.5, 10, "OK"), ("A", 2024010101, 3.5, 20, "OK"), ("B", 2024010100, 2.5, None, "FAILED")]
    versions = warehouse.versions()
    ST.ingest_touched(spark, *roots, sink)  # nothing new
    assert warehouse.versions() == versions


def test_stream_keeps_nothing_in_the_driver(spark):
    import inspect
    assert 'format("memory")' not in inspect.getsource(ST)
