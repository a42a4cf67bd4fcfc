"""Loads, checks and profiles on the cases that once went wrong."""

from pyspark.sql import functions as F

from hourlake.operators import profile as P
from hourlake.operators import reports as R
from hourlake.operators import star as S
from hourlake.operators import upsert as U
from hourlake.sources import raw as RAW
from hourlake.streaming import incremental as ST


def _load(spark, path, rows, batch):
    source = spark.createDataFrame(rows, "id int, v int, day int")
    U.upsert_partitioned(spark, path, source, ["id"], ["v"], "day", "2024-01-01 00:00:00", batch)


def test_first_load_has_audit_columns_and_rolls_back(spark, tmpdir_path):
    path = f"{tmpdir_path}/table"
    _load(spark, path, [(1, 10, 1), (2, 20, 1)], "b1")
    assert {r.batch_id for r in spark.read.parquet(path).collect()} == {"b1"}
    assert spark.read.parquet(path).where("inserted_at IS NULL OR modified_at IS NULL").count() == 0
    _load(spark, path, [(3, 30, 2)], "b2")
    U.delete_batch_partitioned(spark, path, "b2", "day")  # the batch owns its whole partition
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]


def test_rollback_keeps_rows_without_batch(spark):
    rows = spark.createDataFrame([(1, "b"), (2, None), (3, "c")], "id int, batch_id string")
    assert sorted(r.id for r in U.rollback_batch(rows, "b").collect()) == [2, 3]


def test_histogram_of_a_constant(spark):
    got = P.histogram(spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double"), ["x"]).collect()
    assert [(r.bin, r.n) for r in got] == [(1, 2)]


def test_fk_ignores_null_and_finds_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert [r.k for r in S.check_fk(child, parent, "k").collect()] == [2]


def test_newest_forecast_run_wins(spark):
    hourly = "hourly struct<time:array<string>,wind_direction_10m:array<int>,cloud_cover:array<int>,precipitation:array<double>>"
    rows = [("p", 1, ((["2024-01-01T01:00", "2024-01-01T02:00"], [1, 1], [1, 1], [1.0, 1.0]),)),
            ("p", 2, ((["2024-01-01T02:00"], [9], [9], [9.0]),))]
    df = spark.createDataFrame(rows, f"place string, run int, doc struct<{hourly.replace(' ', ':', 1)}>")
    got = {str(r.fc_ts): r.wind_direction for r in RAW.zip_forecast(df, run_col="run").collect()}
    assert got == {"2024-01-01 01:00:00": 1, "2024-01-01 02:00:00": 9}


def test_hourly_means_keep_their_digits(spark):
    rows = spark.createDataFrame([("p", 0.001), ("p", 0.002)], "place string, value double")
    rows = rows.withColumn("ts", F.to_timestamp_ntz(F.lit("2024-01-01 00:10:00")))
    assert ST.hourly_window_batch(rows).first().value_mean == 0.0015


def test_poisson_draws_reach_the_tail(spark):
    draw = spark.range(1).select(P._poisson1(F.lit(1 - 2.0 ** -52)).alias("k"), P._poisson1(F.lit(0.0)).alias("z"))
    assert draw.first().k > 12 and draw.first().z == 0


def test_stored_places_keep_their_keys(spark):
    stored = S.place_dim(spark.createDataFrame([("B",), ("C",)], "place string"))
    rows = spark.createDataFrame([("A",), ("B",), ("D",), ("A",)], "place string")
    got = {r.place: r.place_id for r in S.place_dim(rows, existing=stored).collect()}
    assert got == {"B": 1, "C": 2, "A": 3, "D": 4}


def test_landed_payloads_read_back(spark, tmpdir_path):
    root = f"{tmpdir_path}/landed"
    rows = [("Lyon", '{"main": {"temp": 12.5}, "sys": {"country": "FR"}}', "2024-03-05 07:00:00"), ("Nice", "no json", "2024-03-05 08:00:00")]
    docs = spark.createDataFrame(rows, "place string, payload string, t string").withColumn("run_ts", F.to_timestamp_ntz("t"))
    RAW.land_raw(docs, root)
    flat = RAW.flatten_weather(RAW.read_landed(spark, root, RAW.WEATHER_SCHEMA).withColumn("slot", F.lit(1)))
    got = {r.place: (r.temperature, r.country) for r in flat.collect()}
    assert got == {"Lyon": (12.5, "FR"), "Nice": (None, None)}
    one = RAW.read_landed(spark, root, RAW.WEATHER_SCHEMA, hours=[("2024", "03", "05", "08")])
    assert [r.place for r in one.collect()] == ["Nice"]


def test_join_loss_and_coverage(spark):
    before = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert tuple(R.join_loss(before, other, ("k",)).first()) == (4, 2, 2)
    rows = spark.createDataFrame([("a", "OK", "FAILED"), ("a", "OK", "OK")], "place string, weather_status string, air_status string")
    got = {r.place: tuple(r)[1:] for r in R.config_coverage(rows, spark.createDataFrame([("a",), ("b",)], "place string")).collect()}
    assert got == {"a": (2, 2, 1, True), "b": (0, 0, 0, False)}


def test_changed_rows_and_one_batch(spark):
    fact = spark.createDataFrame([(1, "b1", 1, 1), (2, "b1", 1, 2), (3, "b10", 1, 3)], "id int, batch_id string, inserted_at int, modified_at int")
    assert sorted(r.id for r in R.changed_rows(fact).collect()) == [2, 3]
    assert sorted(r.id for r in R.batch_rows(fact, "b1").collect()) == [1, 2]
