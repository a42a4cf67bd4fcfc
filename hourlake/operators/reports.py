"""Warehouse reports (SURVEY §2.5 E1-E15, E27-E31; §2.7 G1-G3; §2.3
C12-C22; §2.4 D2-D5, D9, D14).

Inputs are the Gold frames: ``fact`` (place_id, slot, hour_ts, typed
metrics, statuses, batch_id, inserted_at, modified_at), ``places``
(place_id, place), ``times`` (slot, hour_ts, calendar parts),
``thresholds`` and ``predictions`` (place_id, target_ts, aqi_pred, alert,
predicted_at, batch_id).  Every report is one declarative plan:
aggregations run partial-then-final, dimensions join without hints so AQE
broadcasts them once it has measured them, the fixed-size threshold seed is
broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.functions import columns as X


def both_ok():
    return (F.col("weather_status") == X.STATUS_OK) & (F.col("air_status") == X.STATUS_OK)


def dbl(*cols):
    """Decimal columns to double for the final projection."""
    return [F.col(c_).cast("double").alias(c_) for c_ in cols]


def with_place(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Fact joined to the place dimension."""
    return fact.join(places, "place_id")


def with_place_time(fact: DataFrame, places: DataFrame, times: DataFrame) -> DataFrame:
    """D3: star join fact -> place, time."""
    return fact.drop("hour_ts").join(places, "place_id").join(times.select("slot", "hour_ts"), "slot")


# ---- counts and availability --------------------------------------------

def kpi_counts(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Measures, distinct slots, places."""
    return fact.agg(F.count(F.lit(1)).alias("n_measures"), F.count_distinct("slot").alias("n_slots"),
                    places.agg(F.count(F.lit(1))).scalar().alias("n_places"))


def runs_by_type(fact: DataFrame) -> DataFrame:
    """Distinct batches per run type.  Distinct is computed as a
    two-level aggregation (type, batch) then count, both partial."""
    return (fact.groupBy(X.run_type("batch_id").alias("run_type"))
            .agg(F.count_distinct("batch_id").alias("n_runs")))


def rows_by_type(fact: DataFrame) -> DataFrame:
    """E4."""
    return fact.groupBy(X.run_type("batch_id").alias("run_type")).agg(F.count(F.lit(1)).alias("n_rows"))


def availability_global(fact: DataFrame) -> DataFrame:
    """E5."""
    a = fact.agg(F.count(F.lit(1)).alias("total_runs"), F.sum(both_ok().cast("long")).alias("complete_runs"))
    return a.select(X.pct_1dp("complete_runs", "total_runs").alias("pct_available"))


def availability_by_place(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Runs, complete runs and availability % per place."""
    agg = (with_place(fact, places).groupBy("place")
           .agg(F.count(F.lit(1)).alias("total_runs"),
                F.sum(both_ok().cast("long")).alias("complete_runs")))
    return (agg.withColumn("pct_available", X.pct_1dp("complete_runs", "total_runs"))
            .orderBy("pct_available", "place"))


def time_range(times: DataFrame) -> DataFrame:
    """first/last slot time, days and hours crossed (boundary
    counting, as DATEDIFF does)."""
    a = times.agg(F.min("hour_ts").alias("first_ts"), F.max("hour_ts").alias("last_ts"))
    return a.select("first_ts", "last_ts",
                    F.datediff(F.to_date("last_ts"), F.to_date("first_ts")).alias("n_days"),
                    F.expr("timestampdiff(HOUR, first_ts, last_ts)").alias("n_hours"))


def temp_by_place(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Temperature mean/min/max per place as DECIMAL(5,2)."""
    f = with_place(fact, places).filter(F.col("temperature").isNotNull())
    return (f.groupBy("place")
            .agg(X.decimal_mean("temperature", 2).alias("temp_avg"),
                 F.min("temperature").cast("double").alias("temp_min"),
                 F.max("temperature").cast("double").alias("temp_max"))
            .orderBy(F.desc("temp_avg"), "place"))


def aqi_by_place(fact: DataFrame, places: DataFrame) -> DataFrame:
    """AQI mean truncated as an INT average, PM2.5 mean as
    DECIMAL(6,2), band from the truncated mean."""
    f = with_place(fact, places).filter(F.col("aqi").isNotNull())
    a = f.groupBy("place").agg(F.sum("aqi").alias("_s"), F.count("aqi").alias("_n"),
                               X.decimal_mean("pm25", 2).alias("pm25_mean"))
    a = a.withColumn("aqi_mean", X.int_div_mean("_s", "_n"))
    return (a.select("place", "aqi_mean", "pm25_mean", X.aqi_band("aqi_mean").alias("air_quality"))
            .orderBy(F.desc("aqi_mean"), "place"))


def places_per_slot(fact: DataFrame) -> DataFrame:
    """E10."""
    return fact.groupBy("slot").agg(F.count(F.lit(1)).alias("n_places")).orderBy(F.desc("slot"))


def latest_rows(fact: DataFrame, places: DataFrame, n: int = 22) -> DataFrame:
    """G1: the n most recent measures (top-k, place as tie-break).  Spark
    plans this as TakeOrderedAndProject: a top-n per task, then a merge."""
    f = with_place(fact, places)
    return (f.orderBy(F.desc("slot"), "place").limit(n)
            .select("slot", "place", *dbl("temperature"), "humidity", "aqi", "weather_status",
                    "air_status", "inserted_at"))


def partial_outages(fact: DataFrame, places: DataFrame, times: DataFrame) -> DataFrame:
    """Rows where either source failed."""
    f = fact.filter((F.col("weather_status") == X.STATUS_FAILED) | (F.col("air_status") == X.STATUS_FAILED))
    return (with_place_time(f, places, times)
            .select("place", "hour_ts", "weather_status", "air_status")
            .orderBy(F.desc("hour_ts"), "place"))


def limit_row(thresholds: DataFrame, pollutant: str = "PM2.5", level: str = "Limite OMS") -> DataFrame:
    return thresholds.filter((F.col("pollutant") == pollutant) & (F.col("level") == level))


def threshold_status(fact: DataFrame, places: DataFrame, times: DataFrame, thresholds: DataFrame,
                     metric: str = "pm25", pollutant: str = "PM2.5") -> DataFrame:
    """Every measure against the legal limit of its pollutant.  The
    reference cross-joins a one-row filter of the seed; here the limit and
    its level are scalar subqueries over the fixed five-row seed, so the
    fact is only projected (no join, no nested loop)."""
    lim = limit_row(thresholds, pollutant)
    f = with_place_time(fact.filter(F.col(metric).isNotNull()), places, times).withColumns({
        "limit_value": lim.select("limit_value").scalar(), "level": lim.select("level").scalar()})
    return (f.select("place", "hour_ts", *dbl(metric, "limit_value"), "level",
                     X.threshold_verdict(metric, "limit_value").alias("status"))
            .orderBy(F.desc("hour_ts"), "place"))


def exceedances_by_place(fact: DataFrame, places: DataFrame, thresholds: DataFrame,
                         metric: str = "pm25", pollutant: str = "PM2.5") -> DataFrame:
    """Measures above the limit, counted per place.  The reference's
    inequality join against the seed is a filter against the limit as a
    scalar subquery: pushed below the place join, partial aggregation."""
    lim = limit_row(thresholds, pollutant).select("limit_value").scalar()
    j = fact.filter(F.col(metric) > lim)
    return (with_place(j, places).groupBy("place").agg(F.count(F.lit(1)).alias("n_exceedances"))
            .orderBy(F.desc("n_exceedances"), "place"))


def slot_gaps(times: DataFrame, true_hours: bool = False) -> DataFrame:
    """Consecutive slots and the missing count between them.

    ``true_hours=False`` reproduces the key difference (each midnight looks
    like a gap); ``True`` counts real missing hours.  The ``lead`` window has
    no partition: it runs over the distinct-slot set (one row per hour, 8,760
    a year), whose size is bounded by the time span, not by the data.
    """
    w = Window.orderBy("slot")
    s = times.select("slot", "hour_ts").withColumns({
        "next_slot": F.lead("slot").over(w), "next_ts": F.lead("hour_ts").over(w)})
    if true_hours:
        missing = F.expr("timestampdiff(HOUR, hour_ts, next_ts)") - 1
    else:
        missing = F.col("next_slot") - F.col("slot") - 1
    return (s.filter(F.col("next_slot").isNotNull())
            .select(F.col("slot").alias("last_slot"), "next_slot", missing.alias("n_missing"))
            .filter("n_missing > 0").orderBy("last_slot"))


def gap_count(times: DataFrame) -> DataFrame:
    """E12."""
    return slot_gaps(times).agg(F.count(F.lit(1)).alias("n_gaps"))


def last_batch(fact: DataFrame) -> DataFrame:
    """The batch with the latest modification (max_by: partial
    aggregation, no global sort)."""
    return fact.agg(F.max_by("batch_id", F.struct("modified_at", "batch_id")).alias("batch_id"),
                    F.max("modified_at").alias("modified_at"))


def last_run(fact: DataFrame, times: DataFrame) -> DataFrame:
    """Measure time, insert time and batch of the latest insert."""
    j = fact.drop("hour_ts").join(times.select("slot", "hour_ts"), "slot")
    best = j.agg(F.max_by(F.struct("hour_ts", "inserted_at", "batch_id"),
                          F.struct("inserted_at", "hour_ts", "batch_id")).alias("r"))
    return best.select("r.hour_ts", "r.inserted_at", "r.batch_id")


def outages_by_source(fact: DataFrame, places: DataFrame) -> DataFrame:
    """E13."""
    a = (with_place(fact, places).groupBy("place")
         .agg(F.sum((F.col("weather_status") == X.STATUS_FAILED).cast("long")).alias("weather_outages"),
              F.sum((F.col("air_status") == X.STATUS_FAILED).cast("long")).alias("air_outages")))
    return a.orderBy(F.desc(F.col("weather_outages") + F.col("air_outages")), "place")


def kpi_means(fact: DataFrame) -> DataFrame:
    """Dashboard KPIs in one global aggregation."""
    return fact.agg(
        F.count(F.lit(1)).alias("n_measures"),
        F.count_distinct("place_id").alias("n_places"),
        X.decimal_mean(F.col("aqi").cast("decimal(10,0)"), 4).alias("aqi_mean"),
        X.decimal_mean("temperature", 4).alias("temp_mean"),
        X.decimal_mean(F.col("humidity").cast("decimal(10,0)"), 4).alias("humidity_mean"),
        X.decimal_mean("pm10", 4).alias("pm10_mean"),
        X.decimal_mean("wind_speed", 4).alias("wind_mean"),
        F.sum((F.col("aqi") > X.ALERT_LIMIT).cast("long")).alias("n_alerts"))


def daily_means(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Daily means per place."""
    f = with_place(fact, places).withColumn("day", F.date_format("hour_ts", "yyyy-MM-dd"))
    return (f.groupBy("place", "day")
            .agg(X.decimal_mean(F.col("aqi").cast("decimal(10,0)"), 2).alias("aqi_mean"),
                 X.decimal_mean("temperature", 2).alias("temp_mean"),
                 X.decimal_mean(F.col("humidity").cast("decimal(10,0)"), 2).alias("humidity_mean"))
            .orderBy("place", "day"))


def pollutants_by_place(fact: DataFrame, places: DataFrame) -> DataFrame:
    """E29."""
    return (with_place(fact, places).groupBy("place")
            .agg(X.decimal_mean("pm10", 2).alias("pm10_mean"),
                 X.decimal_mean("pm25", 2).alias("pm25_mean"),
                 X.decimal_mean("o3", 2).alias("o3_mean"))
            .orderBy("place"))


def status_counts(fact: DataFrame) -> DataFrame:
    """OK/FAILED counts per source: four conditional sums in one pass,
    then the one-row result is unpivoted."""
    a = fact.agg(*[F.sum((F.col(f"{src}_status") == st).cast("long")).alias(f"{src}_{st}")
                   for src in ("weather", "air") for st in (X.STATUS_OK, X.STATUS_FAILED)])
    stack = ", ".join(f"'{src}', '{st}', {src}_{st}" for src in ("weather", "air")
                      for st in (X.STATUS_OK, X.STATUS_FAILED))
    return a.selectExpr(f"stack(4, {stack}) AS (source, status, n)")


def staging_counts(staged: DataFrame) -> DataFrame:
    """Row counts of the three staging frames, UNION ALL."""
    p = staged.agg(F.count_distinct("place").alias("n")).select(F.lit("places_staging").alias("staging_table"), "n")
    t = staged.agg(F.count_distinct("slot").alias("n")).select(F.lit("times_staging").alias("staging_table"), "n")
    f = staged.agg(F.count(F.lit(1)).alias("n")).select(F.lit("facts_staging").alias("staging_table"), "n")
    return p.unionByName(t).unionByName(f)


# ---- filters --------------------------------------------------------------

def batch_filter(fact: DataFrame, prefix: str) -> DataFrame:
    """Rows of batches whose id starts with ``prefix``."""
    return fact.filter(F.col("batch_id").startswith(prefix))


def batch_rows(fact: DataFrame, batch_id) -> DataFrame:
    """Rows of exactly one batch."""
    return fact.filter(F.col("batch_id") == (F.lit(batch_id) if isinstance(batch_id, str) else batch_id))


def changed_rows(fact: DataFrame) -> DataFrame:
    """C17: rows changed after their first insert."""
    return fact.filter(F.col("modified_at") != F.col("inserted_at"))


def join_loss(before: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows before a join on ``keys``, rows with a partner, rows lost,
    all in one plan; repeated partners count once, a null key has none."""
    hit = other.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return (before.select(*keys).join(hit, list(keys), "left")
            .agg(F.count(F.lit(1)).alias("rows_before"), F.count("_hit").alias("rows_after"))
            .withColumn("rows_lost", F.col("rows_before") - F.col("rows_after")))


def config_coverage(measures: DataFrame, configured: DataFrame) -> DataFrame:
    """Every configured place with its hours and those that each source
    delivered; a place that never delivered has none and isn't covered."""
    ok = lambda c_: F.sum((F.col(c_) == "OK").cast("long"))
    got = measures.groupBy("place").agg(F.count(F.lit(1)).alias("n_hours"), ok("weather_status").alias("n_weather"),
                                        ok("air_status").alias("n_air"))
    j = configured.join(got, "place", "left").na.fill(0, ["n_hours", "n_weather", "n_air"])
    return j.withColumn("covered", F.col("n_hours") > 0)


def metric_pair(fact: DataFrame, places: DataFrame, a: str = "humidity", b: str = "pm25") -> DataFrame:
    """Rows where both metrics are present."""
    f = fact.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return with_place(f, places).select("place", "hour_ts", F.col(a).cast("double").alias(a),
                                        F.col(b).cast("double").alias(b))


def day_slots(fact: DataFrame, places: DataFrame, day: int) -> DataFrame:
    """C20: slots of one calendar day by key range (prunes like a prefix)."""
    f = fact.filter(F.col("slot").between(day * 100, day * 100 + 23))
    return with_place(f, places).select("place", "slot", "aqi", *dbl("temperature"))


def place_date_filter(fact: DataFrame, places: DataFrame, names, start: str, end: str) -> DataFrame:
    """List of places and a date range on the slot date."""
    p = places.filter(F.col("place").isin(*names))
    f = fact.filter(F.to_date("hour_ts").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return with_place(f, p).select("place", "hour_ts", "aqi", *dbl("temperature"))


def peaks_by_place(fact: DataFrame, places: DataFrame, limit: int = X.ALERT_LIMIT) -> DataFrame:
    """Rows, peaks (AQI > limit) and peak share per place."""
    a = (with_place(fact, places).groupBy("place")
         .agg(F.count(F.lit(1)).alias("n_rows"), F.sum((F.col("aqi") > limit).cast("long")).alias("n_peaks")))
    return a.withColumn("pct_peaks", X.pct_1dp("n_peaks", "n_rows")).orderBy(F.desc("n_peaks"), "place")


# ---- predictions ----------------------------------------------------------

def predictions_listing(pred: DataFrame, places: DataFrame) -> DataFrame:
    """D14."""
    return (pred.join(places, "place_id")
            .select("place", "target_ts", *dbl("aqi_pred"), "alert", "predicted_at", "batch_id")
            .orderBy("target_ts", "place"))


def future_predictions(pred: DataFrame, places: DataFrame, as_of: str) -> DataFrame:
    """Predictions at or after ``as_of``."""
    p = pred.filter(F.col("target_ts") >= F.lit(as_of).cast("timestamp_ntz"))
    return (p.join(places, "place_id").select("place", "target_ts", *dbl("aqi_pred"), "alert")
            .orderBy("place", "target_ts"))


def alerts_only(pred: DataFrame, places: DataFrame) -> DataFrame:
    """Alert rows."""
    p = pred.filter(F.col("alert") == X.ALERT_LABEL)
    return (p.join(places, "place_id").select("place", "target_ts", *dbl("aqi_pred"), "predicted_at")
            .orderBy("target_ts", "place"))


def predicted_by_place(pred: DataFrame, places: DataFrame) -> DataFrame:
    """E14."""
    return (pred.join(places, "place_id").groupBy("place")
            .agg(X.decimal_mean("aqi_pred", 2).alias("aqi_pred_mean"), F.count(F.lit(1)).alias("n_predictions"))
            .orderBy(F.desc("aqi_pred_mean"), "place"))


def latest_prediction(pred: DataFrame, places: DataFrame) -> DataFrame:
    """E15."""
    return (pred.join(places, "place_id").groupBy("place")
            .agg(F.max("target_ts").alias("last_target_ts"), F.max("predicted_at").alias("last_run_ts"))
            .orderBy("place"))
