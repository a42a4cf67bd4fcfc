"""DuckDB oracles for the feature, fold and evaluation keys."""

from __future__ import annotations

from hourlake.plans.oracle import HEAD, ORACLE, avg_hu, oracle
from hourlake.plans.oracle_quality import FORECAST, VOCAB

HIDX = "date_diff('hour', TIMESTAMP '1970-01-01', {ts})"
ONE_HOT = ", ".join(f"CAST(place = '{v}' AS INTEGER) AS place_{v}" for v in VOCAB)


def trig(expr, period):
    return (f"round(sin(({expr}) * (2 * pi() / {period})), 9)", f"round(cos(({expr}) * (2 * pi() / {period})), 9)")


def time_feats(ts):
    hs, hc = trig(f"hour({ts})", 24)
    ms, mc = trig(f"month({ts})", 12)
    return (f"{hs} AS hour_sin, {hc} AS hour_cos, {ms} AS month_sin, {mc} AS month_cos, "
            f"CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS is_weekend")


def fc_feats():
    ws, wc = trig("wind_direction", 360)
    return (f"{ws} AS wind_dir_sin, {wc} AS wind_dir_cos, CAST(cloud_cover AS DOUBLE) AS cloud_cover, "
            "CASE WHEN coalesce(precipitation, 0) > 0 THEN 1 ELSE 0 END AS precipitation_bin")


WEATHER_DBL = ("CAST(temperature AS DOUBLE) AS temperature, CAST(humidity AS DOUBLE) AS humidity, "
               "CAST(pressure AS DOUBLE) AS pressure, CAST(wind_speed AS DOUBLE) AS wind_speed")

oracle("rolling_6h_mean", f"""SELECT place, slot, aqi, avg(aqi) OVER (PARTITION BY place ORDER BY {HIDX.format(ts='hour_ts')}
  RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS aqi_mean_6h FROM measures""")
oracle("prev_6h_mean", f"""SELECT place, slot, aqi, avg(aqi) OVER (PARTITION BY place ORDER BY {HIDX.format(ts='hour_ts')}
  RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS aqi_mean_6h FROM measures""")
# Measures stand on both sides of this join: they are made once, without the views that it doesn't need.
MEASURES_ONCE = HEAD[:HEAD.index(", places AS")].replace(", measures AS (", ", measures AS MATERIALIZED (")
oracle("history_join", head=MEASURES_ONCE, tail=FORECAST + """SELECT m.place, m.hour_ts, m.aqi, m.temperature, f.wind_direction, f.cloud_cover,
  f.precipitation FROM measures m JOIN forecast f ON m.place = f.place AND m.hour_ts = f.fc_ts""")
FUT = """, fut AS (SELECT * FROM (SELECT r.*, f.fc_ts, f.wind_direction, f.cloud_cover, f.precipitation,
    row_number() OVER (PARTITION BY r.place, r.run_ts ORDER BY f.fc_ts) AS rn
  FROM runs r JOIN forecast f ON f.place = r.place AND f.fc_ts > r.run_ts) x WHERE rn <= 6)
"""
RUNS = f""", runs AS (SELECT place, slot AS run_slot, hour_ts AS run_ts, {WEATHER_DBL},
  avg(aqi) OVER (PARTITION BY place ORDER BY {HIDX.format(ts='hour_ts')} RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS aqi_mean_6h
  FROM measures)
"""
oracle("future_slots", FORECAST + RUNS + FUT + "SELECT place, run_ts, fc_ts AS target_ts FROM fut")
oracle("serving_features", FORECAST + RUNS + FUT + f"""SELECT place, run_slot, fc_ts AS target_ts,
  CAST(strftime(fc_ts, '%Y%m%d%H') AS BIGINT) AS slot, temperature, humidity, pressure, wind_speed,
  {time_feats('fc_ts')}, {fc_feats()}, aqi_mean_6h, {ONE_HOT} FROM fut""")
TRAIN = f""", train AS (SELECT place, slot, hour_ts, {WEATHER_DBL}, {time_feats('hour_ts')}, {fc_feats()}, aqi_mean_6h,
  {ONE_HOT}, CAST(aqi AS DOUBLE) AS target FROM (
  SELECT m.*, f.wind_direction, f.cloud_cover, f.precipitation,
    avg(m.aqi) OVER (PARTITION BY m.place ORDER BY {HIDX.format(ts='m.hour_ts')} RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS aqi_mean_6h
  FROM measures m JOIN forecast f ON m.place = f.place AND m.hour_ts = f.fc_ts) j WHERE aqi IS NOT NULL)
"""
FEATURES = ["temperature", "humidity", "pressure", "wind_speed", "hour_sin", "hour_cos", "month_sin", "month_cos",
            "is_weekend", "wind_dir_sin", "wind_dir_cos", "cloud_cover", "precipitation_bin", "aqi_mean_6h"] + \
    [f"place_{v}" for v in VOCAB]
oracle("training_features", FORECAST + TRAIN + "SELECT * FROM train")
oracle("feature_projection", FORECAST + TRAIN + "SELECT " + ", ".join(FEATURES) + ", target FROM train")
oracle("temporal_folds", FORECAST + TRAIN + """SELECT place, slot, fold,
  CASE WHEN idx < n - (3 - fold + 1) * (n // 4) THEN 'train' ELSE 'test' END AS role FROM (
  SELECT place, slot, row_number() OVER (ORDER BY hour_ts, place) - 1 AS idx, count(*) OVER () AS n FROM train) t
  CROSS JOIN (VALUES (1), (2), (3)) f(fold)
  WHERE idx < n - (3 - fold + 1) * (n // 4) + (n // 4)""")
VOCAB_VALUES = ", ".join(f"('{v}')" for v in VOCAB)
oracle("missing_places", f"""SELECT t.slot, v.place, 'cleaned row missing' AS reason FROM times t
  CROSS JOIN (VALUES {VOCAB_VALUES}) v(place)
  WHERE NOT EXISTS (SELECT 1 FROM measures m WHERE m.place = v.place AND m.slot = t.slot)""")
oracle("coverage_verdict", f"""SELECT slot, n_missing, CASE WHEN n_missing = 0 THEN 'complete'
  WHEN n_missing = {len(VOCAB)} THEN 'none' ELSE 'partial' END AS verdict FROM (
  SELECT t.slot, {len(VOCAB)} - coalesce(p.n_present, 0) AS n_missing FROM times t LEFT JOIN (
    SELECT slot, count(DISTINCT place) AS n_present FROM measures
    WHERE place IN ({', '.join(repr(v) for v in VOCAB)}) GROUP BY slot) p ON t.slot = p.slot) x""")
PAIRS = """, pairs AS (SELECT p.place, a.target_ts, CAST(f.aqi AS DOUBLE) AS actual, CAST(a.aqi_pred AS DOUBLE) AS predicted
  FROM predictions a JOIN fact f ON a.place_id = f.place_id AND a.target_ts = f.hour_ts JOIN places p ON p.place_id = a.place_id
  WHERE f.aqi IS NOT NULL)
"""
oracle("regression_metrics", PAIRS + """SELECT count(*) AS n, round(avg(abs(predicted - actual)), 9) AS mae,
  round(sqrt(avg((predicted - actual) * (predicted - actual))), 9) AS rmse,
  round(1 - avg((predicted - actual) * (predicted - actual)) / var_pop(actual), 9) AS r2 FROM pairs""")
oracle("alert_confusion", PAIRS + """SELECT sum(CASE WHEN actual > 100 AND predicted > 100 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN actual <= 100 AND predicted > 100 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN actual > 100 AND predicted <= 100 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN actual <= 100 AND predicted <= 100 THEN 1 ELSE 0 END) AS tn,
  CAST((2000000 * sum(CASE WHEN (actual > 100) = (predicted > 100) THEN 1 ELSE 0 END) + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000
  AS alert_accuracy FROM pairs""")
oracle("pred_vs_actual", PAIRS + "SELECT place, target_ts, actual, predicted FROM pairs")
oracle("tumbling_hour", f"""SELECT date_trunc('hour', ts) AS window_start, place, count(*) AS n,
  {avg_hu("CAST(value AS DECIMAL(12,2))", 2, 4)} AS value_mean FROM readings GROUP BY date_trunc('hour', ts), place""")
KEYED = f"""SELECT hour_ts AS window_start, count(*) AS n_places, count(value) AS n_values, {avg_hu("CAST(value AS DECIMAL(12,2))", 2, 4)} AS value_mean
  FROM (SELECT place, hour_ts, value, row_number() OVER (PARTITION BY place, slot ORDER BY ts DESC, event_id DESC) AS rn FROM readings) r
  WHERE rn = 1 GROUP BY hour_ts"""
oracle("keyed_hour", KEYED)
oracle("keyed_hour_stream", KEYED)
oracle("touched_ingest", """SELECT p.place, f.slot, CAST(f.temperature AS DOUBLE) AS temperature, CAST(f.humidity AS DOUBLE) AS humidity,
  CAST(f.pressure AS DOUBLE) AS pressure, CAST(f.wind_speed AS DOUBLE) AS wind_speed, CAST(f.aqi AS DOUBLE) AS aqi,
  CAST(f.pm25 AS DOUBLE) AS pm25, CAST(f.pm10 AS DOUBLE) AS pm10, CAST(f.no2 AS DOUBLE) AS no2, CAST(f.o3 AS DOUBLE) AS o3,
  f.weather_status, f.air_status FROM fact f JOIN places p USING (place_id)""")
oracle("tumbling_hour_stream", ORACLE["tumbling_hour"], head="")
