
from decimal import Decimal

from pyspark.ml.regression import RandomForestRegressor

from hourlake.operators import model as ML
from hourlake.operators import star


def test_save_load_score(spark, tmpdir_path):
    rows = [(float(i), None if i % 5 == 0 else float(i % 7), 2.0 * i + i % 7) for i in range(60)]
    data = spark.createDataFrame(rows, "a double, b double, target double")
    fitted = ML.fit_all(data, ["a", "b"], RandomForestRegressor(labelCol="target", featuresCol="features", numTrees=3, seed=1))
    path = f"{tmpdir_path}/model"
    for _ in range(2):  # saving again replaces
        ML.save_model(fitted, path)
    loaded = ML.load_model(path)
    scores = lambda m: [r.prediction for r in m.transform(data.orderBy("a")).select("prediction").collect()]
    assert scores(loaded) == scores(fitted) and len(set(scores(loaded))) > 5


def test_threshold_seed(spark):
    got = [tuple(r)[:6] for r in star.thresholds(spark).orderBy("threshold_id").collect()]
    assert got == [
        (1, "PM2.5", "Moyenne 24h", Decimal("15.00"), "µg/m³", "Limite OMS"),
        (2, "PM2.5", "Moyenne 24h", Decimal("25.00"), "µg/m³", "Danger"),
        (3, "PM10", "Moyenne 24h", Decimal("45.00"), "µg/m³", "Limite OMS"),
        (4, "NO2", "Moyenne 24h", Decimal("25.00"), "µg/m³", "Limite OMS"),
        (5, "O3", "Moyenne 8h", Decimal("100.00"), "µg/m³", "Limite OMS")]
