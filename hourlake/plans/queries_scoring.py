"""Query keys for feature rejects, stored predictions and alerts, and the
wider profile (SURVEY §2.11 K12-K14, §2.5 E19-E23, §2.2 B11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import clean
from hourlake.operators import features as FE
from hourlake.operators import load as LD
from hourlake.operators import profile as P
from hourlake.plans.catalog import FIRST_BATCH, FIRST_TS, LOAD_BATCH, LOAD_TS, NEW_PLACE, PLACE_VOCAB, StoredGold, new_warehouse, out, query
from hourlake.plans.oracle import avg_hu, oracle
from hourlake.plans.oracle_quality import FORECAST, VOCAB

# Places whose forecast no run of the fixture fetched.
UNSERVED = ("V04",)


def fetched_forecasts(g: StoredGold):
    """Forecast rows as runs fetched them: a run has its day's document, so its
    last hour finds nothing later in it; one place has none."""
    rows = g.forecast().filter(~F.col("place").isin(*UNSERVED)).select("place", "fc_ts", F.to_date("fc_ts").alias("_day"))
    runs = g.times.select("slot", F.to_date("hour_ts").alias("_day"))
    return rows.join(runs, "_day").select("place", "slot", "fc_ts")


def _rejects(spark, sf_dir):
    g = StoredGold(spark, sf_dir)
    runs = g.times.select("slot", F.col("hour_ts").alias("run_ts"))
    return runs, FE.feature_rejects(runs, PLACE_VOCAB, g.measures, fetched_forecasts(g))


@query("feature_rejects")
def q_feature_rejects(spark, sf_dir):
    """Places of every run without features, with the reason."""
    return _rejects(spark, sf_dir)[1].select("slot", "place", "reason")


@query("run_verdicts")
def q_run_verdicts(spark, sf_dir):
    """The verdict on every run's features."""
    runs, rejects = _rejects(spark, sf_dir)
    return FE.run_verdicts(runs, len(PLACE_VOCAB), rejects)


def _scored_twice(spark, sf_dir):
    """A warehouse with the predictions of two runs: all but a new place's, then
    the last day's again with 0.5 more."""
    g = StoredGold(spark, sf_dir)
    warehouse = new_warehouse(spark)
    warehouse.commit({"places": warehouse.write("places", g.places, "places")}, None)
    pred = g.predictions().join(g.places, "place_id").select("place", "target_ts", "aqi_pred", "alert")
    LD.store_predictions(warehouse, pred.filter(F.col("place") != NEW_PLACE), FIRST_BATCH, FIRST_TS)
    last_day = pred.agg(F.max(F.to_date("target_ts"))).scalar()
    again = pred.filter(F.to_date("target_ts") == last_day)
    again = again.withColumn("aqi_pred", (F.col("aqi_pred") + F.lit(0.5)).cast("decimal(6,2)")).withColumn("alert", X.alert_rule("aqi_pred"))
    LD.store_predictions(warehouse, again, LOAD_BATCH, LOAD_TS)
    return warehouse


@query("stored_predictions")
def q_stored_predictions(spark, sf_dir):
    """The prediction table after two scoring runs."""
    return out(_scored_twice(spark, sf_dir).read("predictions").drop(LD.DAY))


@query("alert_table")
def q_alert_table(spark, sf_dir):
    """The alert table after two scoring runs."""
    return out(_scored_twice(spark, sf_dir).read("alerts").select("place", "target_ts", "aqi_pred", "batch_id"))


# ---- wider profile -------------------------------------------------------------

FORECAST_METRICS = ("wind_direction", "cloud_cover", "precipitation")


@query("frequencies_month")
def q_frequencies_month(spark, sf_dir):
    """Rows by month."""
    return P.frequencies(StoredGold(spark, sf_dir).measures, {"month": F.month("hour_ts")})


@query("histogram_all")
def q_histogram_all(spark, sf_dir):
    """All metrics of the measures and of the forecast."""
    g = StoredGold(spark, sf_dir)
    return P.histogram(g.measures, X.ALL_METRICS).unionByName(P.histogram(g.forecast(), FORECAST_METRICS))


@query("box_summaries")
def q_box_summaries(spark, sf_dir):
    """AQI by weekend and month, cloud cover and precipitation by place."""
    g = StoredGold(spark, sf_dir)
    m = g.measures.withColumns({"is_weekend": X.weekend_flag("hour_ts"), "month": F.month("hour_ts")})
    parts = []
    for frame, key, col in ((m, "is_weekend", "aqi"), (m, "month", "aqi"), (g.forecast(), "place", "cloud_cover"), (g.forecast(), "place", "precipitation")):
        box = P.box_summary(frame, key, col)
        parts.append(box.select(F.lit(key).alias("grouping"), F.lit(col).alias("column"), F.col(key).cast("string").alias("value"),
                                *[c for c in box.columns if c != key]))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both


@query("wind_by_hour")
def q_wind_by_hour(spark, sf_dir):
    """Mean wind direction by hour."""
    f = StoredGold(spark, sf_dir).forecast()
    return f.groupBy(F.hour("fc_ts").alias("hour")).agg(
        X.decimal_mean(F.col("wind_direction").cast("decimal(10,0)"), 4).alias("wind_mean"), F.count("wind_direction").alias("n"))


@query("fill_precipitation")
def q_fill_precipitation(spark, sf_dir):
    """Hours without a forecast have no precipitation, which counts as 0."""
    g = StoredGold(spark, sf_dir)
    f = g.forecast().filter(~F.col("place").isin(*UNSERVED)).select("place", F.col("fc_ts").alias("hour_ts"), "precipitation")
    return clean.fill_default(g.measures.select("place", "slot", "hour_ts").join(f, ["place", "hour_ts"], "left"),
                              {"precipitation": 0.0}).select("place", "slot", "precipitation")


_PLACES = ", ".join(f"('{v}')" for v in VOCAB)
_UNSERVED = ", ".join(f"'{v}'" for v in UNSERVED)
REJECTS = FORECAST + f""", wanted AS (SELECT t.slot, t.hour_ts AS run_ts, v.place FROM times t CROSS JOIN (VALUES {_PLACES}) v(place))
, fetched AS (SELECT f.place, CAST(f.fc_ts AS DATE) AS day, max(f.fc_ts) AS last_ts FROM forecast f
  WHERE f.place NOT IN ({_UNSERVED}) GROUP BY 1, 2)
, reasons AS (SELECT w.slot, w.place, CASE
    WHEN NOT EXISTS (SELECT 1 FROM measures m WHERE m.place = w.place AND m.slot = w.slot) THEN 'cleaned row missing'
    WHEN f.place IS NULL THEN 'forecast unavailable' WHEN f.last_ts <= w.run_ts THEN 'no future slot in the forecast' END AS reason
  FROM wanted w LEFT JOIN fetched f ON f.place = w.place AND f.day = CAST(w.run_ts AS DATE))
"""
oracle("feature_rejects", REJECTS + "SELECT * FROM reasons WHERE reason IS NOT NULL")
oracle("run_verdicts", REJECTS + f"""SELECT slot, count(reason) AS n_rejected, CASE WHEN count(reason) = 0 THEN 'complete'
  WHEN count(reason) = {len(VOCAB)} THEN 'none' ELSE 'partial' END AS verdict FROM reasons GROUP BY slot""")
SCORED = f""", tgt AS (SELECT a.*, p.place FROM predictions a JOIN places p USING (place_id) WHERE p.place <> '{NEW_PLACE}')
, src AS (SELECT a.place_id, p.place, target_ts, CAST(aqi_pred + 0.5 AS DECIMAL(6,2)) AS aqi_pred,
    CASE WHEN CAST(aqi_pred + 0.5 AS DECIMAL(6,2)) > 100 THEN 'ALERTE' ELSE 'OK' END AS alert
    FROM predictions a JOIN places p USING (place_id) WHERE CAST(target_ts AS DATE) = (SELECT max(CAST(target_ts AS DATE)) FROM predictions))
"""
oracle("stored_predictions", SCORED + f"""SELECT coalesce(t.place_id, s.place_id) AS place_id, coalesce(t.target_ts, s.target_ts) AS target_ts,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.aqi_pred ELSE t.aqi_pred END AS DOUBLE) AS aqi_pred,
  CASE WHEN s.place_id IS NOT NULL THEN s.alert ELSE t.alert END AS alert,
  CASE WHEN s.place_id IS NOT NULL THEN TIMESTAMP '{LOAD_TS}' ELSE TIMESTAMP '{FIRST_TS}' END AS predicted_at,
  CASE WHEN s.place_id IS NOT NULL THEN '{LOAD_BATCH}' ELSE '{FIRST_BATCH}' END AS batch_id
FROM tgt t FULL OUTER JOIN src s ON t.place_id = s.place_id AND t.target_ts = s.target_ts""")
oracle("alert_table", SCORED + f"""SELECT place, target_ts, CAST(aqi_pred AS DOUBLE) AS aqi_pred, '{FIRST_BATCH}' AS batch_id FROM tgt WHERE alert = 'ALERTE'
  UNION ALL SELECT place, target_ts, CAST(aqi_pred AS DOUBLE), '{LOAD_BATCH}' FROM src WHERE alert = 'ALERTE'""")
oracle("frequencies_month", "SELECT 'month' AS dimension, CAST(month(hour_ts) AS VARCHAR) AS value, count(*) AS n FROM measures GROUP BY 2")


def _hist(col, table):
    x = f"CAST({col} AS DOUBLE)"
    return f"""SELECT '{col}' AS column, bin, round(lo + (bin - 1) * ((hi - lo) / 30), 6) AS bin_start,
  round(lo + bin * ((hi - lo) / 30), 6) AS bin_end, count(*) AS n FROM (
  SELECT CAST(least(floor(({x} - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) AS bin, lo, hi
  FROM {table}, (SELECT min({x}) AS lo, max({x}) AS hi FROM {table}) mm WHERE {col} IS NOT NULL) b GROUP BY bin, lo, hi"""


oracle("histogram_all", FORECAST + " UNION ALL ".join([_hist(m, "measures") for m in X.ALL_METRICS] + [_hist(m, "forecast") for m in FORECAST_METRICS]))


def _box(key, label, col, table):
    return f"""SELECT '{label}' AS grouping, '{col}' AS column, CAST(g AS VARCHAR) AS value, count(x) AS n, min(x) AS min,
  round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3, max(x) AS max,
  round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS lower_fence, round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS upper_fence,
  CAST(coalesce(sum(CASE WHEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_outliers
  FROM (SELECT {key} AS g, CAST({col} AS DOUBLE) AS x, quantile_cont(CAST({col} AS DOUBLE), 0.25) OVER (PARTITION BY {key}) AS q1,
    quantile_cont(CAST({col} AS DOUBLE), 0.5) OVER (PARTITION BY {key}) AS q2,
    quantile_cont(CAST({col} AS DOUBLE), 0.75) OVER (PARTITION BY {key}) AS q3 FROM {table}) t GROUP BY g"""


oracle("box_summaries", FORECAST + " UNION ALL ".join([
    _box("CASE WHEN isodow(hour_ts) >= 6 THEN 1 ELSE 0 END", "is_weekend", "aqi", "measures"), _box("month(hour_ts)", "month", "aqi", "measures"),
    _box("place", "place", "cloud_cover", "forecast"), _box("place", "place", "precipitation", "forecast")]))
oracle("wind_by_hour", FORECAST + f"""SELECT hour(fc_ts) AS hour, {avg_hu("CAST(wind_direction AS DECIMAL(10,0))", 0, 4)} AS wind_mean, count(*) AS n
  FROM forecast GROUP BY 1""")
oracle("fill_precipitation", FORECAST + f"""SELECT m.place, m.slot, coalesce(f.precipitation, 0) AS precipitation FROM measures m
  LEFT JOIN (SELECT * FROM forecast WHERE place NOT IN ({_UNSERVED})) f ON f.place = m.place AND f.fc_ts = m.hour_ts""")
