"""Exact quantiles, selection, and sensor signals against plain Python."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourlake.operators import profile as P
from hourlake.operators import quantiles as Q
from hourlake.operators import signals as SG


def test_quantiles_by_group(spark):
    rng = random.Random(1)
    data = {g: [round(rng.gauss(0, 5), 1) for _ in range(n)] for g, n in (("hot", 900), ("b", 7), ("one", 1), (None, 5))}
    rows = [(g, x, None if i % 3 else -x) for g, xs in data.items() for i, x in enumerate(xs)] + [("hot", None, float("nan")), ("empty", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    wanted = {"a": 0.0, "q1": 0.25, "mid": 0.5, "p99": 0.99, "z": 1.0}
    got = {(r.g, r.column): r for r in Q.quantiles(df, ["x", "y"], wanted, ["g"]).collect()}
    assert ("empty", "x") not in got
    for g, xs in data.items():
        for column, values in (("x", xs), ("y", [-x for i, x in enumerate(xs) if i % 3 == 0])):
            r = got[g, column]
            assert r.total == len(values)
            for name, p in wanted.items():
                assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_hold_no_column_in_one_task(spark):
    """A range of values a task, whatever the group."""
    df = spark.range(0, 5000).select(F.lit("one").alias("g"), F.col("id").cast("double").alias("x"))
    running = Q.running_counts(Q.value_counts(df, ["x"], ["g"]), ["g"])
    assert running.agg(F.max("below")).first()[0] == 4999
    plan = running._jdf.queryExecution().toString()
    assert "percentile" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would go to one task
    try:
        sizes = Q.cut_lineage(Q.value_counts(df, ["x"], ["g"]).repartitionByRange("g", "column", "value")).select(
            F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500


def test_winsorize_by_ranks(spark):
    rng = random.Random(2)
    for n, nulls in ((250, 40), (100, 0), (10, 3), (300, 290)):
        xs = [float(rng.randint(0, 50)) for _ in range(n - nulls)] + [None] * nulls
        df = spark.createDataFrame(list(enumerate(xs)), "id int, x double").repartition(4)
        got = [r.x_w for r in P.winsorize(df, ["x"], limit=0.05).orderBy("id").collect()]
        median = float(np.median([x for x in xs if x is not None]))
        filled = [median if x is None else x for x in xs]
        order, k = sorted(filled), int(0.05 * n)
        assert got == [min(max(x, order[k]), order[n - k - 1]) for x in filled]
    empty = spark.createDataFrame([], "id int, x double")
    assert P.winsorize(empty, ["x"]).columns == ["id", "x", "x_w"]
    nothing = spark.createDataFrame([(1, None)], "id int, x double")
    assert P.winsorize(nothing, ["x"]).first().x_w is None


def test_fences_of_a_group_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.5), ("a", 100.0), ("b", None)], "g string, x double")
    got = {r.g: r for r in P.box_summary(df, "g", "x").collect()}
    assert got["a"].n_outliers == 1 and got["a"].max == 100.0
    assert (got["b"].n, got["b"].n_outliers, got["b"].median) == (0, 0, None)


def test_permutation_test_equals_sorting(spark):
    """The same p as ranking all rows of every replicate by (key, id)."""
    rng = random.Random(3)
    rows = [(i, rng.random() + (0.3 if i % 3 == 0 else 0), "a" if i % 3 == 0 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double, g string").repartition(5)
    keys = df.select("id", "x", "g", F.explode(F.sequence(F.lit(1), F.lit(40))).alias("r")).withColumn(
        "k", F.pmod(F.xxhash64(F.lit(42), "id", "r"), F.lit(1 << 52))).collect()
    na = sum(r[2] == "a" for r in rows)
    mean = lambda xs: sum(xs) / len(xs)
    observed = abs(mean([r[1] for r in rows if r[2] == "a"]) - mean([r[1] for r in rows if r[2] == "b"]))
    diffs = []
    for r in range(1, 41):
        own = sorted((k.k, k.id, k.x) for k in keys if k.r == r)
        diffs.append(abs(mean([x for _, _, x in own[:na]]) - mean([x for _, _, x in own[na:]])))
    want = mean([d >= observed - 1e-12 for d in diffs])
    for buckets, resolved in ((256, 1 << 10), (4, 5), (2, 1), (16, 20)):
        got = P.permutation_test(df, "x", "g", "a", "b", replicates=40, row_id="id", buckets=buckets, resolved=resolved).first()
        assert got.p_value == pytest.approx(want) and got.replicates == 40
        assert got.observed_diff == pytest.approx(observed)
    assert P.permutation_test(df, "x", "g", "a", "none", replicates=5, row_id="id").first().p_value is None


# Signals

T0 = datetime.datetime(2024, 1, 1, 0)
KIND = "place string, hour_ts timestamp_ntz, m double, k double"


def hours(place, values, start=0, skip=()):
    return [(place, T0 + datetime.timedelta(hours=start + i), v, 1.0) for i, v in enumerate(values) if i not in skip]


def test_runs_cross_midnight_and_end_at_gaps(spark):
    rows = hours("A", [1, None, None] + [2] * 18 + [None] * 6 + [3], 0)          # 21..26: six hours over midnight
    rows += hours("B", [None] * 7, 0, skip=(3,))                                  # a missing hour cuts 3 and 3
    rows += hours("C", [5.0] * 60, 10)                                            # stuck over three days
    rows += hours("D", [1, 1, 1, 1, 2, 2, 2, 2, 2, 1])
    df = spark.createDataFrame([(p, t, None if v is None else float(v), k) for p, t, v, k in rows], KIND).repartition(6)
    got = sorted((r.place, r.metric, r.first_ts, r.last_ts, r.hours) for r in SG.missing_runs(df, ["m", "k"]).collect())
    at = lambda h: T0 + datetime.timedelta(hours=h)
    assert got == [("A", "m", at(21), at(26), 6), ("B", "m", at(0), at(2), 3), ("B", "m", at(4), at(6), 3)]
    stuck = sorted((r.place, r.value, r.first_ts, r.last_ts, r.hours) for r in SG.stuck_runs(df, ["m"]).collect())
    assert stuck == [("A", 2.0, at(3), at(20), 18), ("C", 5.0, at(10), at(69), 60), ("D", 2.0, at(4), at(8), 5)]
    assert SG.missing_runs(df.limit(0), ["m"]).count() == 0


def test_runs_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(p, T0 + datetime.timedelta(hours=h), rng.choice([None, None, 1.0, 2.0]), 0.0)
            for p in "AB" for h in range(24 * 12) if rng.random() > 0.05]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    values = {(p, int((t - T0).total_seconds() // 3600)): v for p, t, v, _ in rows}
    want = set()
    for p, h in values:
        if values.get((p, h - 1), 0) is not None or (p, h - 1) not in values:
            end = h
            while (p, end) in values and values[p, end] is None:
                end += 1
            if values[p, h] is None and end - h >= 3 and not ((p, h - 1) in values and values[p, h - 1] is None):
                want.add((p, T0 + datetime.timedelta(hours=h), end - h))
    got = {(r.place, r.first_ts, r.hours) for r in SG.missing_runs(df, ["m"]).collect()}
    assert got == want and len(want) > 20


def test_drift(spark):
    split = T0 + datetime.timedelta(hours=10)
    rows = hours("same", [1.0, 9.0] * 10) + hours("moved", [0.0] * 10 + [10.0] * 10) + hours("early", [5.0] * 3) + hours("const", [None] * 20)
    df = spark.createDataFrame([(p, t, None if v is None else float(v), k) for p, t, v, k in rows], KIND)
    got = {r.place: r for r in SG.drift(df, "m", F.lit(split), bins=10).collect()}
    assert set(got) == {"same", "moved"}
    assert got["same"].distance == 0 and got["same"].mean_ratio == 1
    assert got["moved"].distance == 1 and got["moved"].mean_ratio is None  # from a mean of nothing
    one = SG.drift(df.filter("place = 'same'").withColumn("m", F.lit(4.0)), "m", F.lit(split)).first()
    assert one.distance == 0 and one.mean_before == 4.0


def test_source_agreement(spark):
    left = spark.createDataFrame([("A", 1, 10.0), ("A", 2, 20.0), ("A", 3, None), ("B", 1, 1.0)], "place string, slot long, x double")
    right = spark.createDataFrame([("A", 1, 11.0), ("A", 2, 30.0), ("A", 3, 5.0)], "place string, slot long, x double")
    r = SG.source_agreement(left, right, ["place", "slot"], "x", 5.0).collect()
    assert [(x.place, x.pairs, x.mean_difference, x.max_difference, x.disagreeing) for x in r] == [("A", 2, 5.5, 10.0, 1)]


def test_batch_refused_whole(spark):
    live = spark.createDataFrame([("b1",), ("b1",), (None,)], "batch_id string")
    dead = spark.createDataFrame([("b1",), ("b2",), (None,)], "batch_id string")
    got = {r.batch_id: (r.valid, r.rejected, r.all_rejected) for r in SG.batch_rejection(live, dead).collect()}
    assert got == {"b1": (2, 1, False), "b2": (0, 1, True), None: (1, 1, False)}


def test_histogram_of_one_pass(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0), (5.0, None), (9.99, 5.0)], "x double, c double")
    got = sorted(map(tuple, P.histogram(df, ["x", "c"], bins=10).collect()))
    assert got == [("c", 1, 5.0, 5.0, 3), ("x", 1, 0.0, 1.0, 1), ("x", 6, 5.0, 6.0, 1), ("x", 10, 9.0, 10.0, 2)]
    assert math.isclose(sum(r[4] for r in got if r[0] == "x"), 4)
