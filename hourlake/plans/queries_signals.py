"""Query keys for sensor and source signals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import clean
from hourlake.operators import signals as SG
from hourlake.operators import star as S
from hourlake.plans.catalog import Gold, out, query
from hourlake.plans.oracle import avg_hu, oracle, pct1
from hourlake.sources import testdata as TD

# ---- fixed query parameters ------------------------------------------------
DRIFT_SPLIT = "2024-01-16 00:00:00"


@query("missing_runs")
def q_missing_runs(spark, sf_dir):
    """A metric NULL for three consecutive hours or more."""
    return SG.missing_runs(Gold(spark, sf_dir).measures, X.ALL_METRICS)


@query("stuck_runs")
def q_stuck_runs(spark, sf_dir):
    """A metric with one value for two consecutive hours or more: the
    invented readings hold no run of the alert's five (a test has some)."""
    return SG.stuck_runs(Gold(spark, sf_dir).measures, X.ALL_METRICS, hours=2)


@query("batch_rejection")
def q_batch_rejection(spark, sf_dir):
    """Valid and refused rows of every batch."""
    valid, dead = clean.split_dead(Gold(spark, sf_dir).merged)
    batch = TD.run_batch_id().alias("batch_id")
    return SG.batch_rejection(valid.select(batch), dead.select(batch))


@query("source_agreement")
def q_source_agreement(spark, sf_dir):
    """First and last reading of the same hour, as two sources' values."""
    weather = TD.weather_readings(TD.table(spark, sf_dir, "events"))
    keys, order = ["place", "slot"], ("ts", "event_id")
    return SG.source_agreement(clean.keep_first(weather, keys, order), clean.keep_last(weather, keys, order), keys, "humidity", 10.0)


@query("place_drift")
def q_place_drift(spark, sf_dir):
    """AQI of each place before and from the middle of the month on."""
    return SG.drift(Gold(spark, sf_dir).measures, "aqi", F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))


@query("place_month_grid")
def q_place_month_grid(spark, sf_dir):
    """Mean temperature by place and month, a column for each month."""
    g = Gold(spark, sf_dir)
    m = g.fact.join(g.places, "place_id")
    means = [X.decimal_mean(F.when(F.month("hour_ts") == k, F.col("temperature")), 4).alias(f"m{k:02d}") for k in range(1, 13)]
    return m.groupBy("place").agg(*means)


@query("pollutant_trend")
def q_pollutant_trend(spark, sf_dir):
    """Daily means of the pollutants at each place against their limits."""
    g = Gold(spark, sf_dir)
    limits = g.thresholds().filter(F.col("level") == S.LIMIT_LEVEL)
    names = {"PM2.5": "pm25", "PM10": "pm10", "NO2": "no2", "O3": "o3"}
    means = g.fact.groupBy("place_id", F.date_format("hour_ts", "yyyy-MM-dd").alias("day")).agg(
        *[X.decimal_mean(F.col(c), 4).alias(c) for c in names.values()])
    cells = F.array(*[F.struct(F.lit(p).alias("pollutant"), F.col(c).alias("daily_mean"),
                               limits.filter(F.col("pollutant") == p).select("limit_value").scalar().cast("double").alias("limit_value"))
                      for p, c in names.items()])
    long = means.join(g.places, "place_id").select("place", "day", F.inline(cells)).filter(F.col("daily_mean").isNotNull())
    return long.withColumn("above", (F.col("daily_mean") > F.col("limit_value")).cast("int"))


@query("risk_ranking")
def q_risk_ranking(spark, sf_dir):
    """Places by predicted risk: the share of predicted hours in alarm, then
    the mean prediction.  The ranking runs over places."""
    g = Gold(spark, sf_dir)
    by = g.predictions().join(g.places, "place_id").groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("alert") == "ALERTE").cast("long")).alias("n_alerts"),
        X.decimal_mean(F.col("aqi_pred"), 4).alias("mean_pred"))
    by = by.withColumn("pct_alerts", X.pct_1dp(F.col("n_alerts"), F.col("n")))
    order = [F.desc("pct_alerts"), F.desc("mean_pred"), F.col("place")]
    return by.withColumn("risk_rank", F.row_number().over(Window.orderBy(*order)))


@query("period_bias")
def q_period_bias(spark, sf_dir):
    """Predicted against actual before and from a policy's first day on: the
    mean difference in each period, at each place."""
    g = Gold(spark, sf_dir)
    actual = g.fact.filter(F.col("aqi").isNotNull()).select("place_id", F.col("hour_ts").alias("target_ts"), "aqi")
    pairs = g.predictions().join(actual, ["place_id", "target_ts"]).join(g.places, "place_id")
    period = F.when(F.col("target_ts") >= F.lit(DRIFT_SPLIT).cast("timestamp_ntz"), F.lit("after")).otherwise(F.lit("before"))
    off = (F.col("aqi").cast("decimal(8,2)") - F.col("aqi_pred")).cast("decimal(9,2)")
    return out(pairs.groupBy("place", period.alias("period")).agg(F.count(F.lit(1)).alias("n"), X.decimal_mean(off, 4).alias("mean_difference")))


def _runs(state: str, more: str, hours: int) -> str:
    """Gaps and islands over numbered hours, in one window."""
    metrics = " UNION ALL ".join(f"SELECT place, '{m}' AS metric, h, CAST({m} AS DOUBLE) AS value FROM hours" for m in X.ALL_METRICS)
    keys = f"place, metric{more}"
    return f""", hours AS (SELECT *, date_diff('hour', TIMESTAMP '1970-01-01', hour_ts) AS h FROM measures)
, long AS ({metrics})
, islands AS (SELECT {keys}, h, h - row_number() OVER (PARTITION BY {keys} ORDER BY h) AS island FROM long WHERE value {state})
SELECT {keys}, TIMESTAMP '1970-01-01' + to_hours(CAST(min(h) AS INTEGER)) AS first_ts,
  TIMESTAMP '1970-01-01' + to_hours(CAST(max(h) AS INTEGER)) AS last_ts, count(*) AS hours
FROM islands GROUP BY {keys}, island HAVING count(*) >= {hours}"""


oracle("missing_runs", _runs("IS NULL", "", 3))
oracle("stuck_runs", _runs("IS NOT NULL", ", value", 2))
oracle("batch_rejection", """SELECT batch_id, CAST(sum(live) AS BIGINT) AS valid, CAST(sum(1 - live) AS BIGINT) AS rejected, sum(live) = 0 AS all_rejected
  FROM (SELECT CASE WHEN slot % 3 = 0 THEN 'manual__' ELSE 'scheduled__' END || CAST(slot AS VARCHAR(20)) AS batch_id,
    CASE WHEN coalesce(temperature, humidity, pressure, wind_speed, aqi, pm25, pm10, no2, o3) IS NULL THEN 0 ELSE 1 END AS live FROM merged) t
  GROUP BY batch_id""")
oracle("source_agreement", """, hourly AS (SELECT place, slot, CASE WHEN NOT dead THEN k END AS humidity,
    row_number() OVER (PARTITION BY place, slot ORDER BY ts, event_id) AS first_rn,
    row_number() OVER (PARTITION BY place, slot ORDER BY ts DESC, event_id DESC) AS last_rn
  FROM readings WHERE event_type IN ('view','click','error'))
SELECT place, count(*) AS pairs, round(avg(d), 6) AS mean_difference, max(d) AS max_difference,
  CAST(sum(CASE WHEN d > 10 THEN 1 ELSE 0 END) AS BIGINT) AS disagreeing FROM (
  SELECT a.place, CAST(abs(a.humidity - b.humidity) AS DOUBLE) AS d FROM hourly a JOIN hourly b ON a.place = b.place AND a.slot = b.slot
  WHERE a.first_rn = 1 AND b.last_rn = 1) t WHERE d IS NOT NULL GROUP BY place""")
oracle("place_drift", f""", x AS (SELECT place, CAST(aqi AS DOUBLE) AS x, hour_ts >= TIMESTAMP '{DRIFT_SPLIT}' AS late FROM measures WHERE aqi IS NOT NULL)
, e AS (SELECT min(x) AS lo, max(x) AS hi FROM x)
, b AS (SELECT place, late, x, least(floor((x - lo) / (hi - lo) * {SG.DRIFT_BINS}), {SG.DRIFT_BINS - 1}) AS bin FROM x, e)
, t AS (SELECT place, count(*) FILTER (NOT late) AS n0, count(*) FILTER (late) AS n1, avg(x) FILTER (NOT late) AS m0, avg(x) FILTER (late) AS m1
  FROM b GROUP BY place HAVING count(*) FILTER (NOT late) > 0 AND count(*) FILTER (late) > 0)
, c AS (SELECT place, bin, count(*) FILTER (NOT late) AS n0, count(*) FILTER (late) AS n1 FROM b GROUP BY place, bin)
SELECT t.place, t.n0 AS n_before, t.n1 AS n_after, round(t.m0, 6) AS mean_before, round(t.m1, 6) AS mean_after,
  round(t.m1 / t.m0, 6) AS mean_ratio, round(sum(abs(c.n0 / t.n0 - c.n1 / t.n1)) / 2, 6) AS distance
FROM t JOIN c ON c.place = t.place GROUP BY t.place, t.n0, t.n1, t.m0, t.m1""")
_MONTHS = ", ".join(f"{avg_hu(f'CASE WHEN month(f.hour_ts) = {k} THEN f.temperature END', 2, 4)} AS m{k:02d}" for k in range(1, 13))
oracle("place_month_grid", f"SELECT p.place, {_MONTHS} FROM fact f JOIN places p USING (place_id) GROUP BY p.place")
_TREND = " UNION ALL ".join(
    f"SELECT place_id, strftime(hour_ts, '%Y-%m-%d') AS day, '{p}' AS pollutant, {avg_hu(c, 2, 4)} AS daily_mean FROM fact WHERE {c} IS NOT NULL GROUP BY 1, 2"
    for p, c in (("PM2.5", "pm25"), ("PM10", "pm10"), ("NO2", "no2"), ("O3", "o3")))
oracle("pollutant_trend", f""", d AS ({_TREND})
SELECT p.place, d.day, d.pollutant, d.daily_mean, CAST(t.limit_value AS DOUBLE) AS limit_value,
  CASE WHEN d.daily_mean > t.limit_value THEN 1 ELSE 0 END AS above
FROM d JOIN places p USING (place_id) JOIN thresholds t ON t.pollutant = d.pollutant AND t.level = 'Limite OMS'""")
oracle("risk_ranking", f""", r AS (SELECT p.place, count(*) AS n, CAST(sum(CASE WHEN a.alert = 'ALERTE' THEN 1 ELSE 0 END) AS BIGINT) AS n_alerts,
    {avg_hu("a.aqi_pred", 2, 4)} AS mean_pred FROM predictions a JOIN places p USING (place_id) GROUP BY p.place)
, s AS (SELECT *, {pct1("n_alerts", "n")} AS pct_alerts FROM r)
SELECT *, CAST(row_number() OVER (ORDER BY pct_alerts DESC, mean_pred DESC, place) AS INTEGER) AS risk_rank FROM s""")
oracle("period_bias", f"""SELECT place, period, count(*) AS n, {avg_hu("CAST(off AS DECIMAL(9,2))", 2, 4)} AS mean_difference FROM (
  SELECT p.place, CASE WHEN a.target_ts >= TIMESTAMP '{DRIFT_SPLIT}' THEN 'after' ELSE 'before' END AS period,
    CAST(f.aqi AS DECIMAL(8,2)) - a.aqi_pred AS off
  FROM predictions a JOIN fact f ON a.place_id = f.place_id AND a.target_ts = f.hour_ts JOIN places p ON p.place_id = a.place_id
  WHERE f.aqi IS NOT NULL) x GROUP BY place, period""")
