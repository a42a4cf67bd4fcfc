"""Sources and sinks: nested JSON, raw zone, CSV with preamble, forecast
arrays, configuration (SURVEY §2.1)."""

import json
import os

from pyspark.sql import functions as F

from hourlake.sources import raw as RAW

WEATHER = {"coord": {"lat": 45.76, "lon": 4.84}, "sys": {"country": "FR"},
           "main": {"temp": 12.5, "humidity": 70, "pressure": 1012}, "wind": {"speed": 3.1},
           "weather": [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"}],
           "dt": 1700000000, "name": "Lyon", "cod": "200"}
AIR = {"status": "ok", "data": {"aqi": "42", "iaqi": {"pm25": {"v": "17"}, "no2": {"v": "9.5"}},
                                "time": {"s": "2023-11-14 22:00:00"}}}


def _land(root, source, place, doc, y="2023", m="03", d="05", h="07"):
    p = os.path.join(root, source, f"year={y}", f"month={m}", f"day={d}", f"hour={h}")
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, f"{place}.json"), "w") as f:
        json.dump(doc, f, indent=2)


def test_read_nested_weather_place_from_file_name(spark, tmpdir_path):
    _land(tmpdir_path, "owm", "Lyon", WEATHER)
    _land(tmpdir_path, "owm", "Nice", {"main": {"temp": 18.0}}, h="08")
    df = RAW.read_raw_json(spark, os.path.join(tmpdir_path, "owm"), RAW.WEATHER_SCHEMA,
                           hours=[("2023", "03", "05", "07"), ("2023", "03", "05", "08")])
    flat = RAW.flatten_weather(df.withColumn("slot", F.lit(1)))
    rows = {r.place: r for r in flat.collect()}
    assert rows["Lyon"].temperature == 12.5 and rows["Lyon"].country == "FR" and rows["Lyon"].latitude == 45.76
    assert rows["Nice"].humidity is None and rows["Nice"].country is None
    # partition values stay zero-padded strings
    assert df.filter(F.col("month") == "03").count() == 2


def test_partition_filter_prunes_hours(spark, tmpdir_path):
    _land(tmpdir_path, "owm", "Lyon", WEATHER, h="07")
    _land(tmpdir_path, "owm", "Lyon", WEATHER, h="09")
    df = RAW.read_raw_json(spark, os.path.join(tmpdir_path, "owm"), RAW.WEATHER_SCHEMA, hours=[("2023", "03", "05", "09")])
    assert df.count() == 1
    assert len(df.inputFiles()) == 2  # what the folder holds
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert all(f"{name}#" in filters for name in ("year", "month", "day", "hour"))


def test_air_map_missing_pollutant_is_null_and_envelope(spark, tmpdir_path):
    _land(tmpdir_path, "aqicn", "Lyon", AIR)
    _land(tmpdir_path, "aqicn", "Nice", {"status": "error", "data": "Unknown station"})
    df = RAW.read_raw_json(spark, os.path.join(tmpdir_path, "aqicn"), RAW.AIR_SCHEMA)
    ok = RAW.accept_air(df)
    r = RAW.flatten_air(ok.withColumn("slot", F.lit(1))).first()
    assert (r.place, r.aqi, r.pm25, r.pm10, r.no2) == ("Lyon", 42, 17.0, None, 9.5)
    assert ok.count() == 1


def test_weather_404_refused(spark):
    df = spark.createDataFrame([("404",), ("200",), (None,)], "cod string")
    assert RAW.accept_weather(df).count() == 2


def test_zip_forecast_keeps_last_duplicate_time(spark):
    doc = {"hourly": {"time": ["2023-03-05T08:00", "2023-03-05T09:00", "2023-03-05T09:00"],
                      "wind_direction_10m": [10, 20, 30], "cloud_cover": [1, 2, 3], "precipitation": [0.0, 0.5, 0.7]}}
    df = spark.createDataFrame([("Lyon", json.dumps(doc))], "place string, payload string")
    df = df.select("place", F.from_json("payload", RAW.FORECAST_SCHEMA).alias("doc"))
    rows = sorted(RAW.zip_forecast(df).collect(), key=lambda r: r.fc_ts)
    assert [(r.wind_direction, r.precipitation) for r in rows] == [(10, 0.0), (30, 0.7)]


def test_archive_csv_with_preamble(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "archive")
    os.makedirs(d)
    for place in ("Lyon", "Nice"):
        with open(os.path.join(d, f"{place}.csv"), "w") as f:
            f.write("latitude,longitude,elevation\n45.7,4.8,170\n\n")
            f.write("time,wind_direction_10m (°),cloud_cover (%),precipitation (mm)\n")
            f.write("2023-03-05T08:00,10,50,0.0\n2023-03-05T09:00,20,60,0.4\n")
    df = RAW.read_archive_csvs(spark, d, ["time", "wind_direction_10m", "cloud_cover", "precipitation"])
    assert df.count() == 4
    assert sorted({r.place for r in df.collect()}) == ["Lyon", "Nice"]


def test_land_raw_overwrites_only_its_hour(spark, tmpdir_path):
    import datetime
    root = os.path.join(tmpdir_path, "bronze")
    t1, t2 = datetime.datetime(2023, 3, 5, 7), datetime.datetime(2023, 3, 5, 8)
    docs = spark.createDataFrame([("Lyon", "{}", t1), ("Lyon", "{}", t2)], "place string, payload string, run_ts timestamp_ntz")
    RAW.land_raw(docs, root)
    again = spark.createDataFrame([("Nice", "{}", t2)], "place string, payload string, run_ts timestamp_ntz")
    RAW.land_raw(again, root)
    back = spark.read.parquet(root)
    got = sorted((r.hour, r.place) for r in back.collect())
    assert got == [("07", "Lyon"), ("08", "Nice")]


def test_config_and_history_csv(spark, tmpdir_path):
    cfg = os.path.join(tmpdir_path, "cfg.json")
    with open(cfg, "w") as f:
        json.dump({"variables": ["cloud_cover"], "cities": [{"name": "Lyon", "latitude": 45.7, "longitude": 4.8}]}, f)
    c = RAW.read_config(spark, cfg)
    assert c.first().name == "Lyon"
    hist = os.path.join(tmpdir_path, "hist.csv")
    with open(hist, "w") as f:
        f.write("NomVille,DateHeure,AqiGlobal\nLyon,2023-03-05 08:00:00,42\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("NomVille", T.StringType()), T.StructField("DateHeure", T.StringType()),
                           T.StructField("AqiGlobal", T.DoubleType())])
    h = RAW.read_history_csv(spark, hist, schema, "DateHeure")
    assert h.first().DateHeure.hour == 8
