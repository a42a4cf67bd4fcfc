"""Stages fitted on places, the registry and its gate, reject reasons."""

import datetime
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from hourlake.operators import features as FE
from hourlake.operators import model as ML
from hourlake.operators import registry as RG
from hourlake.operators import stages as ST

KIND = "place string, slot long, hour_ts timestamp_ntz, a double, b double, target double"
T0 = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def planted(spark):
    """Targets that a place's own level and one feature explain."""
    rng = random.Random(1)
    level = {"A": 10.0, "B": 50.0, "C": 90.0}
    rows = []
    for i in range(600):
        place = "ABC"[i % 3]
        a = level[place] + rng.gauss(0, 1)
        b = rng.random()
        rows.append((place, i, T0 + datetime.timedelta(hours=i // 3), a if rng.random() > 0.2 else None, b, level[place] + 5 * b))
    return spark.createDataFrame(rows, KIND).repartition(4)


def test_imputer_fills_by_place_and_persists(spark, planted, tmpdir_path):
    model = Pipeline(stages=[ST.PlaceImputer(inputCols=["a", "b"]), ST.PlaceEncoder(inputCol="place", outputCol="v")]).fit(planted)
    path = f"{tmpdir_path}/m"
    ML.save_model(model, path)
    again = ML.load_model(path)
    new = spark.createDataFrame([("A", None, float("nan")), ("C", None, 1.0), ("Z", None, None), (None, 2.0, 3.0)], "place string, a double, b double")
    for m in (model, again):
        got = {r.place: r for r in m.transform(new).collect()}
        assert got["A"].a__filled == pytest.approx(10, abs=0.5) and got["C"].a__filled == pytest.approx(90, abs=0.5)
        assert got["Z"].a__filled == pytest.approx(50, abs=2)  # over all places
        assert (got["A"].a__missing, got["A"].b__missing, got["C"].b__missing, got[None].a__missing) == (1.0, 1.0, 0.0, 0.0)
        assert got["A"].v.toArray().tolist() == [1, 0, 0] and got["C"].v.toArray().tolist() == [0, 0, 1]
        assert got["Z"].v.toArray().tolist() == [0, 0, 0] and got[None].v.toArray().tolist() == [0, 0, 0]
    # exact medians of the training rows
    want = planted.filter("place = 'B'").agg(F.percentile("a", F.lit(0.5))).first()[0]
    assert again.stages[0].getOrDefault("fills")["a"]["B"] == pytest.approx(want)


def test_imputer_of_a_feature_without_values(spark):
    df = spark.createDataFrame([("A", None)], "place string, a double")
    assert ST.PlaceImputer(inputCols=["a"]).fit(df).transform(df).first().a__filled == 0.0


def test_vocabulary_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(ST, "LARGEST", 2)
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "place string")
    with pytest.raises(ValueError, match="more than 2 places"):
        ST.PlaceEncoder(inputCol="place", outputCol="v").fit(df)


def place_pipe(depth=5):
    return ML.place_pipeline(["a"], ["b"], DecisionTreeRegressor(labelCol="target", featuresCol="features", maxDepth=depth, seed=1))


def test_planted_signal_is_found(spark, planted):
    folds = FE.temporal_folds(planted.select("place", "slot", "hour_ts"))
    cv = ML.cross_validate_pipeline(spark, planted, folds, place_pipe())
    rows = cv.orderBy("fold").collect()
    assert [(r.n_train, r.n_test) for r in rows] == [(150, 150), (300, 150), (450, 150)]
    assert min(r.r2 for r in rows) > 0.97
    model = place_pipe().fit(planted)
    assert ML.place_feature_names(model) == ["a__filled", "a__missing", "b", "place_A", "place_B", "place_C"]
    scored = model.transform(planted.withColumn("a", F.lit(None).cast("double")))  # the place alone must do
    assert ML.metrics(scored, "target", "prediction").first().r2 > 0.9


def test_retrain_gate(spark, planted, tmpdir_path):
    registry = RG.ModelRegistry(spark, f"{tmpdir_path}/models")
    assert registry.serving() is None and registry.tries().count() == 0
    folds = ML.cut_lineage(FE.temporal_folds(planted.select("place", "slot", "hour_ts")))
    worse, better = place_pipe(1), place_pipe(5)
    names = ["a", "b"]
    assert registry.retrain({"stump": worse}, planted, folds, names)
    first = registry.serving()
    assert first["name"] == "stump"
    assert registry.retrain({"tree": better, "stump": worse}, planted, folds, names)  # K6: the better of two
    second = registry.serving()
    assert second["name"] == "tree" and second["r2"] > first["r2"]
    assert not registry.retrain({"stump": worse}, planted, folds, names)
    assert registry.serving() == second
    assert [(t.name, t.accepted) for t in registry.tries().collect()] == [("stump", True), ("tree", True), ("stump", False)]
    assert ML.metrics(registry.load().transform(planted), "target", "prediction").first().r2 > 0.97


def test_choose_takes_the_best_mean(spark):
    kind = "fold int, r2 double"
    results = {"a": spark.createDataFrame([(1, 0.9), (2, 0.1)], kind), "b": spark.createDataFrame([(1, 0.6), (2, 0.6)], kind)}
    assert ML.choose(results) == "b"


def test_linear_model_in_the_place_pipeline(spark, planted):
    pipe = ML.place_pipeline(["a"], ["b"], LinearRegression(labelCol="target", featuresCol="features", regParam=0.01))
    assert ML.metrics(pipe.fit(planted).transform(planted), "target", "prediction").first().r2 > 0.95


def test_three_reject_reasons(spark):
    t = lambda h: T0 + datetime.timedelta(hours=h)
    runs = spark.createDataFrame([(1, t(1)), (2, t(2)), (3, t(3))], "slot long, run_ts timestamp_ntz")
    measures = spark.createDataFrame([("A", 1), ("B", 1), ("C", 1), ("A", 2), ("Q", 2)], "place string, slot long")
    forecasts = spark.createDataFrame([("A", 1, t(5)), ("B", 1, t(1)), ("B", 1, t(0)), ("A", 2, t(9))], "place string, slot long, fc_ts timestamp_ntz")
    rejects = FE.feature_rejects(runs, ["A", "B", "C"], measures, forecasts)
    got = sorted((r.slot, r.place, r.reason, bool(r.context)) for r in rejects.collect())
    assert got == [(1, "B", FE.NO_FUTURE_SLOT, True), (1, "C", FE.NO_FORECAST, False), (2, "B", FE.NO_CLEANED_ROW, False),
                   (2, "C", FE.NO_CLEANED_ROW, False), (3, "A", FE.NO_CLEANED_ROW, False), (3, "B", FE.NO_CLEANED_ROW, False),
                   (3, "C", FE.NO_CLEANED_ROW, False)]
    context = rejects.filter("place = 'B' AND slot = 1").first().context
    assert context == {"run_ts": "2024-01-01 01:00:00", "last_forecast_ts": "2024-01-01 01:00:00", "forecast_times": "2"}
    verdicts = {r.slot: (r.n_rejected, r.verdict) for r in FE.run_verdicts(runs, 3, rejects).collect()}
    assert verdicts == {1: (2, "partial"), 2: (2, "partial"), 3: (3, "none")}
