"""Forecast model: MLlib training, temporal cross-validation, scoring,
metrics and alert evaluation (SURVEY §2.11 K3-K12, A17).

Training data is cut from its lineage (checkpoint in the shared checkpoint
folder) before the fold loop, so each of the fits re-reads the checkpoint,
not the raw scan, and a lost executor recomputes from there.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import stages as ST
from hourlake.session import cut_lineage

# ---- fixed values: model hyper-parameters ------------------------------------
FOREST_PARAMS = dict(numTrees=200, maxDepth=12, minInstancesPerNode=5, featureSubsetStrategy="0.5", seed=42)
BOOSTING_PARAMS = dict(maxIter=200, maxDepth=6, stepSize=0.1, subsamplingRate=0.8,
                       featureSubsetStrategy="0.8", seed=42)
N_FOLDS = 3


def pipeline(features, estimator) -> Pipeline:
    """MLlib trees take no missing values: every feature with NULLs is
    imputed with its median (learned on the training rows, kept in the
    model), then assembled."""
    imputed = [f"{f}__imp" for f in features]
    imp = Imputer(inputCols=list(features), outputCols=imputed, strategy="median")
    vec = VectorAssembler(inputCols=imputed, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[imp, vec, estimator])


def forest(label: str = "target") -> RandomForestRegressor:
    """K3."""
    return RandomForestRegressor(labelCol=label, featuresCol="features", **FOREST_PARAMS)


def boosting(label: str = "target") -> GBTRegressor:
    """K4 (L1/L2 penalties have no MLlib counterpart)."""
    return GBTRegressor(labelCol=label, featuresCol="features", **BOOSTING_PARAMS)


def _double_features(df: DataFrame, features) -> DataFrame:
    return df.withColumns({f: F.col(f).cast("double") for f in features})


def place_pipeline(numeric, others, estimator, place: str = "place") -> Pipeline:
    """Features in ``numeric`` are filled by their place's median, with
    a missing indicator each, ``others`` are taken as they are, and the place
    is encoded by the vocabulary of the training rows."""
    imputer = ST.PlaceImputer(inputCols=list(numeric), place=place)
    encoder = ST.PlaceEncoder(inputCol=place, outputCol="_place_vector")
    columns = [c + suffix for c in numeric for suffix in (ST.FILLED, ST.MISSING)] + list(others) + ["_place_vector"]
    vector = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[imputer, encoder, vector, estimator])


def place_feature_names(model: PipelineModel) -> list[str]:
    """Names of the assembled features of a fitted ``place_pipeline``."""
    imputer, encoder, vector, _ = model.stages
    return [c for c in vector.getInputCols() if c != encoder.getOutputCol()] + [f"place_{w}" for w in encoder.words()]


def cross_validate_pipeline(spark: SparkSession, data: DataFrame, folds: DataFrame, pipe: Pipeline,
                            label: str = "target", keys=("place", "slot")) -> DataFrame:
    """K5: fit on each expanding-window fold's train rows, score its test
    rows; returns fold, sizes, R², MAE, RMSE (one row per fold).  Each fold's
    rows are written once; fitting, scoring and counting read them there."""
    members = cut_lineage(folds.select(*keys, "fold", "role"))
    rows = []
    for k in range(1, N_FOLDS + 1):
        fk = members.filter(F.col("fold") == k).drop("fold")
        split = cut_lineage(data.join(fk, list(keys)))
        train, test = split.filter("role = 'train'"), split.filter("role = 'test'")
        pred = pipe.fit(train).transform(test)
        m = metrics(pred, label, "prediction").first()
        sizes = {r["role"]: r["count"] for r in split.groupBy("role").count().collect()}
        rows.append((k, sizes.get("train", 0), sizes.get("test", 0), m["r2"], m["mae"], m["rmse"]))
    return spark.createDataFrame(rows, "fold int, n_train long, n_test long, r2 double, mae double, rmse double")


def cross_validate(spark: SparkSession, data: DataFrame, folds: DataFrame, features, estimator,
                   label: str = "target", keys=("place", "slot")) -> DataFrame:
    """K5 with medians over all places (``pipeline``)."""
    data = cut_lineage(_double_features(data, features))
    return cross_validate_pipeline(spark, data, folds, pipeline(features, estimator), label, keys)


def choose(cv_results: dict) -> str:
    """K6: the model name with the best mean R²."""
    return max(cv_results, key=lambda k: cv_results[k].agg(F.avg("r2")).first()[0])


def fit_all(data: DataFrame, features, estimator) -> PipelineModel:
    """K7: refit on every row, written once for the passes of the fit."""
    return pipeline(features, estimator).fit(cut_lineage(_double_features(data, features)))


def save_model(model: PipelineModel, path: str) -> None:
    """A17."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importances(spark: SparkSession, model: PipelineModel, features, top: int = 10) -> DataFrame:
    """Importances of the fitted trees, highest first."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, imp)), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


def metrics(df: DataFrame, actual: str, predicted: str, digits: int = 9) -> DataFrame:
    """K8: n, MAE, RMSE, R² in one aggregation (R² = 1 - SSE / SST with
    SST = n * population variance of the actual values)."""
    err = F.col(predicted).cast("double") - F.col(actual).cast("double")
    a = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"),
        F.var_pop(F.col(actual).cast("double")).alias("vy"))
    return a.select("n", F.round("mae", digits).alias("mae"), F.round(F.sqrt("mse"), digits).alias("rmse"),
                    F.round(1 - F.col("mse") / F.col("vy"), digits).alias("r2"))


def alert_confusion(df: DataFrame, actual: str, predicted: str, limit: int = X.ALERT_LIMIT) -> DataFrame:
    """K9: alert confusion counts and accuracy (the share of agreeing
    verdicts, which the reference reported as 'precision')."""
    a_al, p_al = F.col(actual) > limit, F.col(predicted) > limit
    c = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).agg(
        F.sum((a_al & p_al).cast("long")).alias("tp"), F.sum((~a_al & p_al).cast("long")).alias("fp"),
        F.sum((a_al & ~p_al).cast("long")).alias("fn"), F.sum((~a_al & ~p_al).cast("long")).alias("tn"),
        F.count(F.lit(1)).alias("n"))
    acc = F.round((F.col("tp") + F.col("tn")).cast("decimal(20,0)") / F.col("n").cast("decimal(20,0)"), 6)
    return c.select("tp", "fp", "fn", "tn", acc.cast("double").alias("alert_accuracy"))


def score(model: PipelineModel, features_df: DataFrame, features, batch_id: str, run_ts) -> DataFrame:
    """Score serving rows, apply the alert rule, shape prediction rows
    (place, target time, value as DECIMAL(6,2), alert, run time, batch)."""
    p = model.transform(_double_features(features_df, features))
    val = F.round("prediction", 2).cast("decimal(6,2)")
    return p.select("place", "target_ts", val.alias("aqi_pred"), X.alert_rule(val).alias("alert"),
                    F.lit(run_ts).cast("timestamp_ntz").alias("predicted_at"), F.lit(batch_id).alias("batch_id"))
