"""Feature and scoring runs over hours: features of every configured place, the
rejects that explain what is missing, zones, and predictions
(SURVEY §2.11 K1, K12-K14; §2.1 A7-A9).

One plan serves all places and any number of run hours (a backfill is the same
code with more of them).  A run takes the forecast that it fetched itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions import columns as X
from hourlake.operators import clean
from hourlake.operators import features as FE
from hourlake.operators import load as LD
from hourlake.operators import model as ML
from hourlake.operators.versions import Warehouse
from hourlake.session import cut_lineage
from hourlake.sources import zones


def run_features(measures: DataFrame, runs: DataFrame, forecasts: DataFrame, vocabulary, n: int = FE.FUTURE_HOURS) -> DataFrame:
    """The features of the first ``n`` future hours of each run and place.

    ``measures`` holds the history that the six-hour means need; ``runs`` are
    ``slot, run_ts``; ``forecasts`` are ``slot`` (of the run that fetched them),
    ``place, fc_ts, wind_direction, cloud_cover, precipitation``."""
    current = FE.prev_hours_mean(measures, "aqi", "aqi_mean_6h").join(runs, "slot")
    key = F.concat_ws("|", "place", "slot")
    current = current.select(key.alias("_run"), "place", F.col("slot").alias("run_slot"), "run_ts",
                             *[F.col(m).cast("double").alias(m) for m in X.WEATHER_METRICS], "aqi_mean_6h")
    fetched = forecasts.select(key.alias("_run"), "fc_ts", "wind_direction", "cloud_cover", "precipitation")
    future = FE.future_slots(current, fetched, n, place="_run", run_ts="run_ts").drop("_run")
    future = future.withColumnRenamed("fc_ts", "target_ts").withColumn("slot", X.slot_key("target_ts"))
    future = FE.one_hot(FE.forecast_features(FE.time_features(future, "target_ts")), "place", vocabulary)
    return future.select("place", "run_slot", "run_ts", "target_ts", "slot", *FE.feature_names(vocabulary))


def feature_run(root: str, measures: DataFrame, runs: DataFrame, forecasts: DataFrame, places) -> DataFrame:
    """Build the features of the runs, write them and the rejects into their
    zones (hours that have none any more are emptied), and give the verdict of
    each run.  Features that break the contract are not written; every place is
    then a reject."""
    hours = [zones.hour_of(r["slot"]) for r in runs.select("slot").distinct().collect()]  # the runs asked for
    features = run_features(measures, runs, forecasts, places)
    rejects = FE.feature_rejects(runs, places, measures, forecasts)
    whole, broken = clean.contract_rejects(features, FE.feature_names(places), "run")
    if broken is not None:
        every = runs.select("slot", "run_ts", F.explode(F.array(*[F.lit(p) for p in places])).alias("place"))
        missing = F.create_map(F.lit("missing"), F.lit(broken.first()["context"]))
        rejects = every.select("slot", "run_ts", "place", F.lit("features missing").alias("reason"), missing.alias("context"))
        whole = features.limit(0)
    rejects = cut_lineage(rejects)
    zones.write_hours(whole, f"{root}/{zones.FEATURES}", "run_ts", hours)
    zones.write_model_rejects(rejects, f"{root}/{zones.MODEL_REJECTS}", "run_ts", hours)
    return FE.run_verdicts(runs, len(places), rejects)


def feature_schema(places) -> T.StructType:
    """Schema of the feature zone."""
    kinds = {"is_weekend": T.IntegerType(), "precipitation_bin": T.IntegerType()}
    kinds |= {FE.ONE_HOT_PREFIX + p: T.IntegerType() for p in places}
    keys = [T.StructField("place", T.StringType()), T.StructField("run_slot", T.LongType()), T.StructField("run_ts", T.TimestampNTZType()),
            T.StructField("target_ts", T.TimestampNTZType()), T.StructField("slot", T.LongType())]
    return T.StructType([*keys, *[T.StructField(n, kinds.get(n, T.DoubleType())) for n in FE.feature_names(places)]])


def scoring_run(warehouse: Warehouse, model, root: str, runs: DataFrame, places, batch_id: str, predicted_at: str) -> tuple[int, int]:
    """Score the stored features of the runs, merge the predictions and
    append the alerts; gives rows inserted and updated.  Runs without features
    give no predictions."""
    spark = runs.sparkSession
    hours = [zones.hour_of(r["slot"]) for r in runs.select("slot").distinct().collect()]
    features = zones.read_hours(spark, f"{root}/{zones.FEATURES}", feature_schema(places), hours)
    # of several runs in one go, the newest forecast of an hour counts
    features = clean.keep_last(features, ["place", "target_ts"], ("run_slot",))
    scored = ML.score(model, features, FE.feature_names(places), batch_id, predicted_at)
    return LD.store_predictions(warehouse, cut_lineage(scored.select("place", "target_ts", "aqi_pred", "alert")), batch_id, predicted_at)
