"""Checks on violating rows, seeds, configuration, CSV results."""

import csv
import glob
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourlake.operators import clean
from hourlake.operators import star as S
from hourlake.sources import raw


def test_range_checks_name_the_violations(spark):
    df = spark.createDataFrame([(1, 101, 1, 0), (2, 50, 13, 24), (3, None, 12, 23), (4, 0, 1, 0), (5, -1, 0, None)],
                               "slot long, humidity int, month int, hour int")
    got = sorted((r.slot, r.failed_check) for r in S.check_range(df, S.RANGE_CHECKS).collect())
    assert got == [(1, "humidity"), (2, "hour"), (2, "month"), (5, "humidity"), (5, "month")]


def test_keys_of_fact_dimensions_and_predictions(spark):
    fact = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 2), (None, 2)], "place_id int, slot long")
    assert [tuple(r) for r in S.check_pk(fact.dropna(), ["place_id", "slot"]).collect()] == [(1, 2, 2)]
    assert {r.occurrences for r in S.check_pk(fact, ["place_id", "slot"]).collect()} == {2}
    places = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "place_id int, place string")
    assert S.check_pk(places, ["place_id"]).count() == 0
    assert [r.place for r in S.check_pk(places, ["place"]).collect()] == ["A"]
    predictions = spark.createDataFrame([(1, "t"), (1, "t"), (2, "t")], "place_id int, target string")
    assert [r.place_id for r in S.check_pk(predictions, ["place_id", "target"]).collect()] == [1]


def test_loaded_tables_keep_their_keys(spark):
    from hourlake.plans.queries_load import two_loads
    from tests.conftest import SF001
    warehouse = two_loads(spark, SF001)
    for table, keys in (("fact", ["place_id", "slot"]), ("places", ["place_id"]), ("places", ["place"]), ("times", ["slot"])):
        assert S.check_pk(warehouse.read(table), keys).count() == 0
    assert S.check_fk(warehouse.read("fact"), warehouse.read("places"), "place_id").count() == 0
    assert S.check_fk(warehouse.read("fact"), warehouse.read("times"), "slot").count() == 0


def test_seeds(spark):
    limits = S.thresholds(spark).collect()
    assert [r.threshold_id for r in limits] == [1, 2, 3, 4, 5]
    assert {r.pollutant for r in limits if r.level == S.LIMIT_LEVEL} == {"PM2.5", "PM10", "NO2", "O3"}
    assert [tuple(r) for r in S.countries(spark).collect()] == [("FR", "France")]


def test_dedup_without_an_order_is_stable(spark):
    rows = [("A", 1, float(x)) for x in range(20)]
    want = None
    for n in (1, 3, 7):
        df = spark.createDataFrame(rows[n:] + rows[:n], "place string, slot long, temperature double").repartition(n)
        got = [r.temperature for r in clean.apply_cleaning_rules(df, order_cols=())[0].collect()]
        want = want or got
        assert got == want and len(got) == 1


def test_config_with_a_schema(spark, tmpdir_path):
    alone, inside = (os.path.join(tmpdir_path, n) for n in ("a.json", "b.json"))
    with open(alone, "w") as f:
        json.dump([{"city": "Lyon", "country": "FR"}, {"city": "Nice"}], f)
    with open(inside, "w") as f:
        json.dump({"variables": ["x"], "cities": [{"city": "Lyon", "latitude": 45.7, "longitude": 4.8}]}, f)
    rows = raw.read_config(spark, alone, raw.CONFIG_SCHEMA).collect()
    assert [(r.city, r.country, r.latitude) for r in rows] == [("Lyon", "FR", None), ("Nice", None, None)]
    assert [(r.city, r.latitude) for r in raw.read_config(spark, inside, raw.CONFIG_SCHEMA).collect()] == [("Lyon", 45.7)]


def test_csv_results(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "out")
    df = spark.createDataFrame([("Lyon", 1.5, None), ('a "b", c', None, "x")], "place string, v double, w string")
    raw.write_csv(df.coalesce(1), path)
    raw.write_csv(df.coalesce(1), path)  # replaces
    lines = [row for name in glob.glob(path + "/*.csv") for row in csv.reader(open(name), escapechar="\\")]
    assert lines[0] == ["place", "v", "w"] and sorted(lines[1:]) == [["Lyon", "1.5", ""], ['a "b", c', "", "x"]]
    back = spark.read.schema(df.schema).option("header", True).csv(path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_upsert_of_a_duplicate_key_fails(spark):
    from hourlake.operators import upsert as U
    target = spark.createDataFrame([], "k int, v int, inserted_at timestamp_ntz, modified_at timestamp_ntz, batch_id string")
    twice = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    with pytest.raises(PySparkException, match="duplicate upsert key"):
        U.merge_upsert(target, twice, ["k"], ["v"], "2024-01-01 00:00:00", "b").collect()
    actions = U.merge_upsert(spark.createDataFrame([(1, 1), (2, 2)], "k int, v int").withColumns(
        {"inserted_at": F.lit(None).cast("timestamp_ntz"), "modified_at": F.lit(None).cast("timestamp_ntz"), "batch_id": F.lit("a")}),
        spark.createDataFrame([(2, 5), (3, 6)], "k int, v int"), ["k"], ["v"], "2024-01-01 00:00:00", "b", action_col="did")
    assert sorted((r.k, r.v, r.did) for r in actions.collect()) == [(1, 1, "kept"), (2, 5, "updated"), (3, 6, "inserted")]


def test_audit_and_prediction_defaults(spark):
    from hourlake.operators import load as LD
    now = LD.local_now(now="2024-01-15 12:00:00")
    facts = spark.createDataFrame([(1, None), (2, "2024-01-01 00:00:00")], "slot long, inserted_at string")
    rows = S.audit_defaults(facts.withColumn("inserted_at", F.col("inserted_at").cast("timestamp_ntz")), now).orderBy("slot").collect()
    assert [(str(r.inserted_at), str(r.modified_at)) for r in rows] == [
        ("2024-01-15 13:00:00", "2024-01-15 13:00:00"), ("2024-01-01 00:00:00", "2024-01-15 13:00:00")]
    kind = "place_id int, target_ts string, aqi_pred double, alert string, batch_id string"
    good = spark.createDataFrame([(1, "t", 5.0, "OK", "b")], kind)
    assert str(S.prediction_defaults(good, now).first().predicted_at) == "2024-01-15 13:00:00"
    with pytest.raises(PySparkException, match="prediction without alert"):
        S.prediction_defaults(good.union(spark.createDataFrame([(1, "t", 5.0, None, "b")], kind)), now).collect()
