"""Query registry: one callable per SURVEY §2 query key.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame built from
the driver's tables through the library's operators.  Nothing is collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import features as FE
from hourlake.operators import reports as R
from hourlake.operators import star as S
from hourlake.operators import upsert as U
from hourlake.operators.versions import Warehouse
from hourlake.plans import measures as M
from hourlake.session import cut_lineage, scratch_root
from hourlake.sources import testdata as TD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# ---- fixed query parameters ---------------------------------------------
LOAD_TS = "2024-02-01 00:00:00"          # load time of the upsert run
LOAD_BATCH = "manual__2024020100"        # batch id of the upsert run
FIRST_TS = "2024-01-31 00:00:00"         # load time and batch of the load before it
FIRST_BATCH = "manual__2024013100"
AS_OF = "2024-01-25 00:00:00"            # "now" of the future-predictions report
REPORT_DAY = 20240115                    # day of the day-slots report
REPORT_PLACES = ("V01", "V02", "V05")    # place filter of the dashboard report
REPORT_START, REPORT_END = "2024-01-10", "2024-01-20"
NEW_PLACE = "V10"                        # place absent from the existing warehouse
PLACE_VOCAB = tuple(f"V{i:02d}" for i in range(TD.N_PLACES))  # serving one-hot vocabulary


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


class Gold:
    """The Gold frames derived, lazily, from one sf directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.events = TD.table(spark, sf_dir, "events")
        self.merged = M.merged_from_events(self.events)
        self.measures = M.clean_measures(self.merged)
        self.places = S.place_dim(self.measures)
        self.times = S.time_dim(self.measures)
        self.fact = gold_fact(self.measures, self.places)

    def thresholds(self) -> DataFrame:
        return S.thresholds(self.spark)

    def predictions(self) -> DataFrame:
        return predictions_from(self.fact)

    def forecast(self) -> DataFrame:
        return TD.forecast_rows(self.measures.select("place", "slot", "hour_ts")) \
            .withColumnRenamed("hour_ts", "fc_ts").drop("slot")

    def staged(self) -> DataFrame:
        """Staging batch: last-day rows re-delivered with AQI + 1 (updates)
        plus every row of the place the warehouse does not hold (inserts)."""
        m = self.measures
        last_day = m.agg(F.max(F.to_date("hour_ts"))).scalar()
        upd = (m.filter((F.to_date("hour_ts") == last_day) & (F.col("place") != NEW_PLACE))
               .withColumn("aqi", F.col("aqi") + 1))
        return upd.unionByName(m.filter(F.col("place") == NEW_PLACE))

    def existing_measures(self) -> DataFrame:
        return self.measures.filter(F.col("place") != NEW_PLACE)


class StoredGold(Gold):
    """Gold frames whose measures are written once, so that what is derived
    from them several times (dimensions, facts, batches) reads that table and
    not the events again."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.measures = cut_lineage(self.measures)
        self.places = S.place_dim(self.measures)
        self.times = S.time_dim(self.measures)
        self.fact = gold_fact(self.measures, self.places)


def new_warehouse(spark: SparkSession) -> Warehouse:
    """An empty warehouse in the session's shared folder."""
    return Warehouse(spark, f"{scratch_root(spark)}/loads-{uuid.uuid4().hex}")


def gold_fact(measures: DataFrame, places: DataFrame) -> DataFrame:
    """Typed fact with audit columns (loaded at the top of its hour)."""
    f = S.warehouse_types(S.fact(measures, places))
    return f.withColumns({"inserted_at": F.col("hour_ts"), "modified_at": F.col("hour_ts")})


def predictions_from(fact: DataFrame) -> DataFrame:
    """Prediction rows for every place-hour: the previous-6-hour AQI mean as
    the predicted value, made one hour before the target."""
    p = FE.prev_hours_mean(fact, "aqi", "_m6", partition=("place_id",))
    p = p.filter(F.col("_m6").isNotNull()).withColumn("aqi_pred", F.round("_m6", 2).cast("decimal(6,2)"))
    return p.select("place_id", F.col("hour_ts").alias("target_ts"), "aqi_pred",
                    X.alert_rule("aqi_pred").alias("alert"),
                    (F.col("hour_ts") - F.expr("INTERVAL 1 HOUR")).alias("predicted_at"), "batch_id")


def out(df: DataFrame) -> DataFrame:
    """Final projection: decimals to double."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                       else F.col(f.name) for f in df.schema.fields])


# ---- reports -------------------------------------------------------------

@query("scan_fact")
def q_scan_fact(spark, sf_dir):
    return out(StoredGold(spark, sf_dir).fact)


@query("kpi_counts")
def q_kpi_counts(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.kpi_counts(g.fact, g.places)


@query("runs_by_type")
def q_runs_by_type(spark, sf_dir):
    return R.runs_by_type(Gold(spark, sf_dir).fact)


@query("rows_by_type")
def q_rows_by_type(spark, sf_dir):
    return R.rows_by_type(Gold(spark, sf_dir).fact)


@query("availability_global")
def q_availability_global(spark, sf_dir):
    return R.availability_global(Gold(spark, sf_dir).fact)


@query("availability_by_place")
def q_availability_by_place(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.availability_by_place(g.fact, g.places)


@query("time_range")
def q_time_range(spark, sf_dir):
    return R.time_range(Gold(spark, sf_dir).times)


@query("temp_by_place")
def q_temp_by_place(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.temp_by_place(g.fact, g.places)


@query("aqi_by_place")
def q_aqi_by_place(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.aqi_by_place(g.fact, g.places)


@query("places_per_slot")
def q_places_per_slot(spark, sf_dir):
    return R.places_per_slot(Gold(spark, sf_dir).fact)


@query("latest_rows")
def q_latest_rows(spark, sf_dir):
    g = StoredGold(spark, sf_dir)
    return R.latest_rows(g.fact, g.places, 22)


@query("partial_outages")
def q_partial_outages(spark, sf_dir):
    g = StoredGold(spark, sf_dir)
    return R.partial_outages(g.fact, g.places, g.times)


@query("threshold_status")
def q_threshold_status(spark, sf_dir):
    g = StoredGold(spark, sf_dir)
    return R.threshold_status(g.fact, g.places, g.times, g.thresholds())


@query("exceedances_by_place")
def q_exceedances_by_place(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.exceedances_by_place(g.fact, g.places, g.thresholds())


@query("slot_gaps_key")
def q_slot_gaps_key(spark, sf_dir):
    return R.slot_gaps(Gold(spark, sf_dir).times, true_hours=False)


@query("slot_gaps_hours")
def q_slot_gaps_hours(spark, sf_dir):
    return R.slot_gaps(Gold(spark, sf_dir).times, true_hours=True)


def peak_times(g: Gold) -> DataFrame:
    """Time dimension of the hours with at least one AQI peak (> 100): the
    hours an alert-driven load would have written.  It has real holes."""
    return S.time_dim(g.measures.filter(F.col("aqi") > X.ALERT_LIMIT))


@query("peak_gaps_key")
def q_peak_gaps_key(spark, sf_dir):
    return R.slot_gaps(peak_times(Gold(spark, sf_dir)), true_hours=False)


@query("peak_gaps_hours")
def q_peak_gaps_hours(spark, sf_dir):
    return R.slot_gaps(peak_times(Gold(spark, sf_dir)), true_hours=True)


@query("gap_count")
def q_gap_count(spark, sf_dir):
    return R.gap_count(Gold(spark, sf_dir).times)


@query("last_batch")
def q_last_batch(spark, sf_dir):
    return R.last_batch(Gold(spark, sf_dir).fact)


@query("last_run")
def q_last_run(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.last_run(g.fact, g.times)


@query("outages_by_source")
def q_outages_by_source(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.outages_by_source(g.fact, g.places)


@query("kpi_means")
def q_kpi_means(spark, sf_dir):
    return R.kpi_means(Gold(spark, sf_dir).fact)


@query("daily_means")
def q_daily_means(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.daily_means(g.fact, g.places)


@query("pollutants_by_place")
def q_pollutants_by_place(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.pollutants_by_place(g.fact, g.places)


@query("status_counts")
def q_status_counts(spark, sf_dir):
    return R.status_counts(Gold(spark, sf_dir).fact)


@query("staging_counts")
def q_staging_counts(spark, sf_dir):
    return R.staging_counts(Gold(spark, sf_dir).staged())


@query("batch_filter")
def q_batch_filter(spark, sf_dir):
    return out(R.batch_filter(Gold(spark, sf_dir).fact, X.MANUAL_PREFIX))


@query("metric_pair")
def q_metric_pair(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.metric_pair(g.fact, g.places)


@query("day_slots")
def q_day_slots(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.day_slots(g.fact, g.places, REPORT_DAY)


@query("place_date_filter")
def q_place_date_filter(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.place_date_filter(g.fact, g.places, REPORT_PLACES, REPORT_START, REPORT_END)


@query("peaks_by_place")
def q_peaks_by_place(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.peaks_by_place(g.fact, g.places)


@query("predictions_listing")
def q_predictions_listing(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.predictions_listing(g.predictions(), g.places)


@query("future_predictions")
def q_future_predictions(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.future_predictions(g.predictions(), g.places, AS_OF)


@query("alerts_only")
def q_alerts_only(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.alerts_only(g.predictions(), g.places)


@query("predicted_by_place")
def q_predicted_by_place(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.predicted_by_place(g.predictions(), g.places)


@query("latest_prediction")
def q_latest_prediction(spark, sf_dir):
    g = Gold(spark, sf_dir)
    return R.latest_prediction(g.predictions(), g.places)


# ---- star load -----------------------------------------------------------

def existing_gold(g: Gold):
    em = g.existing_measures()
    places = S.place_dim(em)
    return em, places, gold_fact(em, places)


@query("new_members")
def q_new_members(spark, sf_dir):
    """New places (with identity keys) and new hours of the
    staging batch."""
    g = StoredGold(spark, sf_dir)
    em, places, _ = existing_gold(g)
    staged = g.staged()
    new_p = S.new_members(staged.select("place").distinct(), places, "place", "place_id")
    new_t = S.new_members(staged.select("slot").distinct(), S.time_dim(em).select("slot"), "slot")
    return (new_p.select(F.lit("place").alias("member_type"), F.col("place").alias("member_key"),
                         F.col("place_id").cast("long").alias("member_id"))
            .unionByName(new_t.select(F.lit("time").alias("member_type"), F.col("slot").cast("string").alias("member_key"),
                                      F.col("slot").alias("member_id"))))


def loaded_places(g: Gold) -> DataFrame:
    _, places, _ = existing_gold(g)
    staged_places = g.staged().select("place").distinct()
    return places.unionByName(S.new_members(staged_places, places, "place", "place_id").select("place_id", "place"))


@query("key_lookup")
def q_key_lookup(spark, sf_dir):
    g = StoredGold(spark, sf_dir)
    return S.key_lookup(g.staged(), loaded_places(g), "place", "place_id").select("place", "place_id", "slot")


UPDATE_COLS = X.ALL_METRICS + ("weather_status", "air_status")


@query("upsert_fact")
def q_upsert_fact(spark, sf_dir):
    """I4: the existing warehouse after the MERGE of the staging batch."""
    g = StoredGold(spark, sf_dir)
    _, _, target = existing_gold(g)
    src = S.warehouse_types(S.key_lookup(g.staged(), loaded_places(g), "place", "place_id").drop("place"))
    merged = U.merge_upsert(target, src, ["place_id", "slot"], UPDATE_COLS, LOAD_TS, LOAD_BATCH,
                            insert_only_cols=("hour_ts",))
    return out(merged)


@query("upsert_predictions")
def q_upsert_predictions(spark, sf_dir):
    """Existing predictions merged with a re-scored last day (value + 0.5)
    and the new place's last-day predictions."""
    g = StoredGold(spark, sf_dir)
    pred = predictions_from(gold_fact(g.measures, g.places))
    new_id = g.places.filter(F.col("place") == NEW_PLACE).select("place_id")
    target = pred.join(new_id, "place_id", "left_anti")
    last_day = pred.agg(F.max(F.to_date("target_ts"))).scalar()
    src = (pred.filter(F.to_date("target_ts") == last_day)
           .withColumn("aqi_pred", (F.col("aqi_pred") + F.lit(0.5)).cast("decimal(6,2)"))
           .withColumn("alert", X.alert_rule("aqi_pred")))
    merged = U.merge_upsert(target, src, ["place_id", "target_ts"], ("aqi_pred", "alert"), LOAD_TS, LOAD_BATCH,
                            inserted_col=None, modified_col="predicted_at")
    return out(merged)


@query("rollback_batch")
def q_rollback_batch(spark, sf_dir):
    """Remove the latest batch (G2) from the fact."""
    g = Gold(spark, sf_dir)
    latest = R.last_batch(g.fact).select("batch_id").scalar()
    return out(U.rollback_batch(g.fact, latest))


@query("insert_defaults")
def q_insert_defaults(spark, sf_dir):
    """I8: a load whose source lacks statuses and batch id gets the column
    defaults."""
    g = Gold(spark, sf_dir)
    valid, _ = M.clean.split_dead(g.merged)
    src = valid.withColumns({"weather_status": F.lit(None).cast("string"),
                             "air_status": F.lit(None).cast("string"),
                             "batch_id": F.lit(None).cast("string")})
    return S.insert_defaults(src).select("place", "slot", "weather_status", "air_status", "batch_id")


# Query keys defined in the sibling modules register themselves on import.
from hourlake.plans import queries_quality, queries_profile, queries_features, queries_load, queries_signals, queries_scoring  # noqa: E402,F401
from hourlake.plans import oracle_quality, oracle_features  # noqa: E402,F401
