"""Query keys for features, folds, evaluation and the model (SURVEY §2.6
F1-F6, §2.4 D8, D11, D13, §2.11 K1-K14, §2.2 B30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import features as FE
from hourlake.operators import model as ML
from hourlake.plans.catalog import PLACE_VOCAB, Gold, new_warehouse, predictions_from, query

TRIG = ("hour_sin", "hour_cos", "month_sin", "month_cos", "wind_dir_sin", "wind_dir_cos")


def _round_trig(df):
    return df.withColumns({c_: F.round(c_, 9) for c_ in TRIG if c_ in df.columns})


@query("rolling_6h_mean")
def q_rolling_6h_mean(spark, sf_dir):
    """training-time mean, current hour included."""
    m = Gold(spark, sf_dir).measures
    return FE.rolling_mean(m, "aqi", "aqi_mean_6h").select("place", "slot", "aqi", "aqi_mean_6h")


@query("prev_6h_mean")
def q_prev_6h_mean(spark, sf_dir):
    """serving-time mean of the six previous hours."""
    m = Gold(spark, sf_dir).measures
    return FE.prev_hours_mean(m, "aqi", "aqi_mean_6h").select("place", "slot", "aqi", "aqi_mean_6h")


@query("history_join")
def q_history_join(spark, sf_dir):
    """Measures history joined to the forecast archive by place-hour,
    sorted by place and time."""
    g = Gold(spark, sf_dir)
    j = FE.history_join(g.measures, g.forecast().withColumnRenamed("fc_ts", "hour_ts"))
    return (j.select("place", "hour_ts", "aqi", "temperature", "wind_direction", "cloud_cover", "precipitation")
            .orderBy("place", "hour_ts"))


@query("future_slots")
def q_future_slots(spark, sf_dir):
    """Every place-hour as a run, its first six future forecast
    hours."""
    g = Gold(spark, sf_dir)
    runs = g.measures.select("place", F.col("hour_ts").alias("run_ts"))
    return FE.future_slots(runs, g.forecast(), run_ts="run_ts").select(
        "place", "run_ts", F.col("fc_ts").alias("target_ts"))


@query("serving_features")
def q_serving_features(spark, sf_dir):
    """K1: the 25 serving features for every run hour (backfill)."""
    g = Gold(spark, sf_dir)
    return _round_trig(FE.serving_features(g.measures, g.forecast(), PLACE_VOCAB))


def training_set(g: Gold):
    return FE.training_features(g.measures, g.forecast(), PLACE_VOCAB)


@query("training_features")
def q_training_features(spark, sf_dir):
    """K2 with the leakage-free mean (F2)."""
    return _round_trig(training_set(Gold(spark, sf_dir)))


@query("feature_projection")
def q_feature_projection(spark, sf_dir):
    """The model matrix only (features + target)."""
    return _round_trig(training_set(Gold(spark, sf_dir))).select(*FE.feature_names(PLACE_VOCAB), "target")


@query("temporal_folds")
def q_temporal_folds(spark, sf_dir):
    """expanding-window fold membership over the training rows ordered
    by (time, place)."""
    t = training_set(Gold(spark, sf_dir)).select("place", "slot", "hour_ts")
    return FE.temporal_folds(t, ("hour_ts", "place")).select("place", "slot", "fold", "role")


@query("missing_places")
def q_missing_places(spark, sf_dir):
    """Configured places without a cleaned row for an hour: each
    hour expands to the fixed configured list (a generator, not a join),
    then anti-joins the measures."""
    g = Gold(spark, sf_dir)
    cand = g.times.select("slot", F.explode(F.array(*[F.lit(v) for v in PLACE_VOCAB])).alias("place"))
    miss = cand.join(g.measures.select("place", "slot"), ["place", "slot"], "left_anti")
    return miss.select("slot", "place", F.lit("cleaned row missing").alias("reason"))


@query("coverage_verdict")
def q_coverage_verdict(spark, sf_dir):
    """Per hour, how many configured places lack a row, and the
    verdict (complete / partial / none)."""
    g = Gold(spark, sf_dir)
    present = g.measures.filter(F.col("place").isin(*PLACE_VOCAB)).groupBy("slot").agg(
        F.count_distinct("place").alias("n_present"))
    v = g.times.select("slot").join(present, "slot", "left").withColumn(
        "n_missing", F.lit(len(PLACE_VOCAB)) - F.coalesce("n_present", F.lit(0)))
    verdict = (F.when(F.col("n_missing") == 0, F.lit("complete"))
               .when(F.col("n_missing") == len(PLACE_VOCAB), F.lit("none")).otherwise(F.lit("partial")))
    return v.select("slot", "n_missing", verdict.alias("verdict"))


def _pairs(g: Gold):
    """Prediction vs actual pairs (baseline predictor: previous-6-hour
    mean), keyed by place and target hour."""
    pred = predictions_from(g.fact)
    actual = g.fact.filter(F.col("aqi").isNotNull()).select("place_id", F.col("hour_ts").alias("target_ts"), "aqi")
    return pred.join(actual, ["place_id", "target_ts"]).join(g.places, "place_id")


@query("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    """K8."""
    return ML.metrics(_pairs(Gold(spark, sf_dir)), "aqi", "aqi_pred")


@query("alert_confusion")
def q_alert_confusion(spark, sf_dir):
    """K9."""
    return ML.alert_confusion(_pairs(Gold(spark, sf_dir)), "aqi", "aqi_pred")


@query("pred_vs_actual")
def q_pred_vs_actual(spark, sf_dir):
    """Predicted vs actual series per place."""
    p = _pairs(Gold(spark, sf_dir))
    return p.select("place", "target_ts", F.col("aqi").cast("double").alias("actual"),
                    F.col("aqi_pred").cast("double").alias("predicted")).orderBy("place", "target_ts")


# ---- MLlib (rows-only: model fits have no SQL oracle) -----------------------

def _cv(spark, sf_dir, estimator):
    g = Gold(spark, sf_dir)
    data = training_set(g)
    folds = FE.temporal_folds(data.select("place", "slot", "hour_ts"), ("hour_ts", "place"))
    return ML.cross_validate(spark, data, folds, FE.feature_names(PLACE_VOCAB), estimator)


@query("forest_cv")
def q_forest_cv(spark, sf_dir):
    """K3/K5: random forest R², MAE, RMSE per temporal fold."""
    return _cv(spark, sf_dir, ML.forest())


@query("boosting_cv")
def q_boosting_cv(spark, sf_dir):
    """K4/K5: boosted trees per temporal fold."""
    return _cv(spark, sf_dir, ML.boosting())


@query("model_evaluation")
def q_model_evaluation(spark, sf_dir):
    """K8/K9: the forest fitted on the last fold's train rows, judged on its
    test rows: errors, and its alerts against the actual ones."""
    g = Gold(spark, sf_dir)
    names = FE.feature_names(PLACE_VOCAB)
    data = ML.cut_lineage(ML._double_features(training_set(g), names))
    folds = FE.temporal_folds(data.select("place", "slot", "hour_ts"), ("hour_ts", "place")).filter(F.col("fold") == ML.N_FOLDS)
    split = ML.cut_lineage(data.join(folds.select("place", "slot", "role"), ["place", "slot"]))
    model = ML.pipeline(names, ML.forest()).fit(split.filter("role = 'train'"))
    scored = ML.cut_lineage(model.transform(split.filter("role = 'test'")).select("place", "hour_ts", "target", "prediction"))
    errors = ML.metrics(scored, "target", "prediction")
    return ML.alert_confusion(scored, "target", "prediction").select(*[errors.select(c).scalar().alias(c) for c in errors.columns], "*")


@query("feature_importances")
def q_feature_importances(spark, sf_dir):
    """Refit the forest on all rows, top-10 importances."""
    g = Gold(spark, sf_dir)
    names = FE.feature_names(PLACE_VOCAB)
    model = ML.fit_all(training_set(g), names, ML.forest())
    return ML.feature_importances(spark, model, names, 10)


@query("score_alerts")
def q_score_alerts(spark, sf_dir):
    """Fit on all rows, score the serving features of every run
    hour, apply the alert rule."""
    g = Gold(spark, sf_dir)
    names = FE.feature_names(PLACE_VOCAB)
    model = ML.fit_all(training_set(g), names, ML.forest())
    serving = FE.serving_features(g.measures, g.forecast(), PLACE_VOCAB)
    return ML.score(model, serving, names, "scheduled__score", "2024-02-01 00:00:00")


# ---- streaming twins (L1/L2) ---------------------------------------------

@query("tumbling_hour")
def q_tumbling_hour(spark, sf_dir):
    """L2 batch twin: hourly event-time windows of raw readings per place."""
    from hourlake.sources import testdata as TD
    from hourlake.streaming import incremental as ST
    # the events' values have two decimals; as decimals their means are exact
    r = TD.readings(TD.table(spark, sf_dir, "events")).withColumn("value", F.col("value").cast("decimal(12,2)"))
    return ST.hourly_window_batch(r, "ts", "place", "value")


def _event_stream(spark, sf_dir):
    """The events file read as a file stream, as readings with exact values."""
    from hourlake.sources import testdata as TD
    schema = TD.table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf_dir))
    return TD.readings(stream).withColumn("value", F.col("value").cast("decimal(12,2)"))


def _stream_folders(spark, name):
    import uuid
    from hourlake.session import ensure_checkpoint_dir
    root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return f"{root}/rows", f"{root}/checkpoint"


@query("tumbling_hour_stream")
def q_tumbling_hour_stream(spark, sf_dir):
    """L2 on a stream: hourly windows with a watermark and de-duplication of
    repeated readings, drained with availableNow into files by epoch."""
    from hourlake.streaming import incremental as ST
    agg = ST.hourly_window(_event_stream(spark, sf_dir), "ts", "place", "value", dedup_keys=("event_id", "ts"))
    folder, checkpoint = _stream_folders(spark, "tumbling")
    ST.run_to_epochs(agg, folder, checkpoint, mode="complete")
    return ST.read_epochs(spark, folder, agg.schema)


@query("keyed_hour_stream")
def q_keyed_hour_stream(spark, sf_dir):
    """L2 with keep-last per (place, slot) as streaming state: each hour's
    number of places and mean of their last values."""
    from hourlake.streaming import incremental as ST
    readings = _event_stream(spark, sf_dir).select("place", "ts", "event_id", "value")
    last = ST.last_readings(readings)
    folder, checkpoint = _stream_folders(spark, "keyed")
    ST.run_to_epochs(last, folder, checkpoint)
    return ST.hourly_of(ST.read_epochs(spark, folder, last.schema, ("place", "window_start")))


@query("keyed_hour")
def q_keyed_hour(spark, sf_dir):
    """L2 batch twin of ``keyed_hour_stream``."""
    from hourlake.operators import clean
    from hourlake.sources import testdata as TD
    from hourlake.streaming import incremental as ST
    r = TD.readings(TD.table(spark, sf_dir, "events")).withColumn("value", F.col("value").cast("decimal(12,2)"))
    last = clean.keep_last(r.select("place", F.col("hour_ts").alias("window_start"), "ts", "event_id", "value"),
                           ["place", "window_start"], ("ts", "event_id"))
    return ST.hourly_of(last)


@query("touched_ingest")
def q_touched_ingest(spark, sf_dir):
    """L1: raw payloads land in two deliveries, the second with the late air
    documents of a third of the hours; the fact after both ingests."""
    import uuid
    from hourlake.operators import clean
    from hourlake.operators import load as LD
    from hourlake.session import ensure_checkpoint_dir
    from hourlake.sources import raw
    from hourlake.sources import testdata as TD
    from hourlake.streaming import incremental as ST
    events = TD.table(spark, sf_dir, "events")
    root = f"{ensure_checkpoint_dir(spark)}/ingest-{uuid.uuid4().hex}"
    keys, order = ["place", "slot"], ("ts", "event_id")
    last = {name: clean.keep_last(rows, keys, order) for name, rows in (("weather", TD.weather_readings(events)), ("air", TD.air_readings(events)))}

    def land(payloads, name):
        raw.land_raw(payloads.withColumn("run_ts", X.slot_to_ts("slot")), f"{root}/{name}")

    warehouse = new_warehouse(spark)

    def sink(cleaned, rejects, epoch):
        LD.load_run(warehouse, cleaned, f"scheduled__{epoch}", "2024-02-01 00:00:00")

    late = F.col("slot") % 3 == 0
    land(raw.weather_payloads(last["weather"]), "weather")
    land(raw.air_payloads(last["air"].filter(~late)), "air")
    roots = (f"{root}/weather", f"{root}/air", f"{root}/state")
    ST.ingest_touched(spark, *roots, sink)
    land(raw.air_payloads(last["air"].filter(late)), "air")
    ST.ingest_touched(spark, *roots, sink)
    fact = warehouse.read("fact").join(warehouse.read("places"), "place_id")
    return fact.select("place", "slot", *[F.col(m).cast("double").alias(m) for m in X.ALL_METRICS], "weather_status", "air_status")
