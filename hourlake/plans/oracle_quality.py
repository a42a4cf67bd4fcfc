"""DuckDB oracles for the quality, projection and profiling keys."""

from __future__ import annotations

from hourlake.plans.oracle import HEAD, ORACLE, avg_hu, oracle, pct1, raw

METRICS = ("temperature", "humidity", "pressure", "wind_speed", "aqi", "pm25", "pm10", "no2", "o3")
ALL_NULL = "coalesce(" + ", ".join(f"CAST({m} AS DOUBLE)" for m in METRICS) + ") IS NULL"
VOCAB = [f"V{i:02d}" for i in range(11)]
SECTORS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")

W_DEDUP = """(SELECT * FROM (SELECT place, slot, hour_ts, ts, event_id,
    CASE WHEN NOT dead THEN floor(value * 1.25e0) * 0.1e0 - 5e0 END AS temperature,
    CASE WHEN NOT dead THEN k END AS humidity,
    CASE WHEN NOT dead AND event_id % 7 <> 0 THEN 990 + event_id % 45 END AS pressure,
    CASE WHEN NOT dead THEN (k % 16) * 0.9e0 END AS wind_speed,
    row_number() OVER (PARTITION BY place, slot ORDER BY ts DESC, event_id DESC) AS rn
  FROM readings WHERE event_type IN ('view','click','error')) w0 WHERE rn = 1) wd"""
FORECAST = """, forecast AS (SELECT place, hour_ts AS fc_ts, CAST((slot * 37) % 360 AS INTEGER) AS wind_direction,
    CAST((slot * 11) % 101 AS INTEGER) AS cloud_cover, greatest((slot % 5) * 1e0 - 2e0, 0e0) AS precipitation
  FROM measures)
"""


def q(name, tail):
    oracle(name, tail)


def qf(name, tail):
    oracle(name, FORECAST + tail)


q("full_outer_merge", "SELECT place, slot, hour_ts, " + ", ".join(METRICS) + " FROM merged")
q("dead_rows", f"SELECT place, slot, hour_ts FROM merged WHERE {ALL_NULL}")
q("missing_keys", "SELECT place, slot, hour_ts FROM merged WHERE place IS NULL OR slot IS NULL")
q("rejects_union", f"""SELECT place, slot, 'dead_row' AS reject_reason FROM merged WHERE {ALL_NULL}
  UNION ALL SELECT place, slot, 'missing_key' FROM merged WHERE NOT ({ALL_NULL}) AND (place IS NULL OR slot IS NULL)""")
q("dedup_last", f"SELECT place, slot, ts, event_id, temperature, humidity, pressure, wind_speed FROM {W_DEDUP}")
q("dedup_first", """SELECT place, slot, temperature, aqi FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY slot) AS rn
  FROM measures) x WHERE rn = 1""")
raw("duplicate_count", """SELECT count(*) AS distinct_keys, sum(n) AS rows, sum(n - 1) AS duplicates
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) x""")
raw("check_pk", """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
raw("check_fk", """SELECT 'orders.o_custkey' AS fk, o_orderkey AS child_key, o_custkey AS missing_key FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
  UNION ALL SELECT 'lineitem.l_orderkey', l_orderkey, l_orderkey FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""")
q("check_range", """SELECT slot, 'humidity' AS failed_check FROM fact WHERE humidity IS NOT NULL AND humidity NOT BETWEEN 0 AND 100
  UNION ALL SELECT slot, 'month' FROM times WHERE month NOT BETWEEN 1 AND 12
  UNION ALL SELECT slot, 'hour' FROM times WHERE hour NOT BETWEEN 0 AND 23""")
q("drop_null_target", """SELECT count(*) AS rows_before, count(aqi) AS rows_after, count(*) - count(aqi) AS rows_dropped
  FROM measures""")
q("source_status", """SELECT place, slot,
  CASE WHEN coalesce(temperature, humidity, pressure, wind_speed) IS NULL THEN 'FAILED' ELSE 'OK' END AS weather_status,
  CASE WHEN coalesce(CAST(aqi AS DOUBLE), pm25, pm10, no2, o3) IS NULL THEN 'FAILED' ELSE 'OK' END AS air_status
  FROM merged""")
q("range_flag", """SELECT place, slot, temperature, (temperature IS NULL OR temperature BETWEEN -50 AND 60) AS is_temp_valid
  FROM measures""")
q("null_impossible", """SELECT place, slot, CASE WHEN humidity BETWEEN 0 AND 100 THEN humidity END AS humidity,
  CASE WHEN aqi >= 0 THEN aqi END AS aqi FROM measures""")
q("coerce_numeric", """SELECT event_id, raw_text, TRY_CAST(raw_text AS DOUBLE) AS value_num FROM (
  SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(k AS VARCHAR) END AS raw_text FROM readings) b""")
q("fill_default", "SELECT place, slot, 'ND' AS country FROM merged")
q("ensure_columns", f"""SELECT place, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS DOUBLE) AS latitude,
  CAST(NULL AS DOUBLE) AS longitude, slot, temperature, humidity, pressure, wind_speed, CAST(NULL AS BIGINT) AS aqi,
  CAST(NULL AS DOUBLE) AS pm25, CAST(NULL AS DOUBLE) AS pm10, CAST(NULL AS DOUBLE) AS no2, CAST(NULL AS DOUBLE) AS o3,
  hour_ts FROM {W_DEDUP}""")
raw("hour_bucket", """SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS slot, date_trunc('hour', ts) AS hour_ts
  FROM events""")
raw("utc_to_local", """SELECT event_id, ts, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS local_ts FROM events""")
q("slot_to_ts", "SELECT slot, strptime(CAST(slot AS VARCHAR), '%Y%m%d%H') AS slot_ts FROM times")
q("time_dim", "SELECT * FROM times")
q("partition_columns", """SELECT place, slot, strftime(hour_ts, '%Y') AS year, strftime(hour_ts, '%m') AS month,
  strftime(hour_ts, '%d') AS day, strftime(hour_ts, '%H') AS hour,
  'measures/year=' || strftime(hour_ts, '%Y') || '/month=' || strftime(hour_ts, '%m') || '/day=' || strftime(hour_ts, '%d')
  || '/hour=' || strftime(hour_ts, '%H') || '/' || place || '.json' AS path FROM measures""")
q("warehouse_types", """SELECT place, slot, CAST(CAST(round(temperature, 2) AS DECIMAL(5,2)) AS VARCHAR) AS temperature,
  CAST(CAST(humidity AS INTEGER) AS VARCHAR) AS humidity, CAST(CAST(pressure AS INTEGER) AS VARCHAR) AS pressure,
  CAST(CAST(round(wind_speed, 2) AS DECIMAL(5,2)) AS VARCHAR) AS wind_speed, CAST(CAST(aqi AS INTEGER) AS VARCHAR) AS aqi,
  CAST(CAST(round(pm25, 2) AS DECIMAL(6,2)) AS VARCHAR) AS pm25, CAST(CAST(round(pm10, 2) AS DECIMAL(6,2)) AS VARCHAR) AS pm10,
  CAST(CAST(round(no2, 2) AS DECIMAL(6,2)) AS VARCHAR) AS no2, CAST(CAST(round(o3, 2) AS DECIMAL(6,2)) AS VARCHAR) AS o3
  FROM measures""")
q("weekend_flag", "SELECT slot, CASE WHEN isodow(hour_ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM times")
q("cyclic_encode", """SELECT slot, round(sin(hour(hour_ts) * (2 * pi() / 24)), 9) AS hour_sin,
  round(cos(hour(hour_ts) * (2 * pi() / 24)), 9) AS hour_cos, round(sin(month(hour_ts) * (2 * pi() / 12)), 9) AS month_sin,
  round(cos(month(hour_ts) * (2 * pi() / 12)), 9) AS month_cos FROM times""")
qf("binarize", """SELECT place, fc_ts, precipitation, CASE WHEN coalesce(precipitation, 0) > 0 THEN 1 ELSE 0 END AS precipitation_bin
  FROM forecast""")
qf("sector_bins", """SELECT place, fc_ts, wind_direction, CASE WHEN wind_direction > 0 AND wind_direction <= 360
  THEN list_extract(['N','NE','E','SE','S','SW','W','NW'], CAST(ceil(wind_direction / 45.0) AS INTEGER)) END AS sector
  FROM forecast""")
q("one_hot", "SELECT place, slot, " + ", ".join(f"CAST(place = '{v}' AS INTEGER) AS place_{v}" for v in VOCAB) + " FROM measures")
q("one_hot_inverse", "SELECT place, slot, place AS place_back FROM measures")
q("alert_rule", "SELECT place_id, slot, aqi, CASE WHEN aqi > 100 THEN 'ALERTE' ELSE 'OK' END AS alert FROM fact")
q("json_flatten", "SELECT place, slot, CAST(NULL AS VARCHAR) AS country, " + ", ".join(METRICS) + " FROM merged")

# ---- profiling -------------------------------------------------------------

LI = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def describe_sql(col):
    x = f"CAST({col} AS DOUBLE)"
    d = f"CAST({col} AS DECIMAL(18,2))"
    return f"""SELECT '{col}' AS column, count({x}) AS count, {avg_hu(d, 2, 6)} AS mean,
  round(quantile_cont({x}, 0.5), 6) AS median, round(stddev_samp({x}), 6) AS std, min({x}) AS min,
  round(quantile_cont({x}, 0.25), 6) AS q1, round(quantile_cont({x}, 0.75), 6) AS q3, max({x}) AS max,
  CAST(sum({d}) AS DOUBLE) AS sum FROM lineitem"""


raw("describe_stats", " UNION ALL ".join(describe_sql(c) for c in LI))


def ratio6(part, total):
    return f"CAST((2000000 * ({part}) + ({total})) // (2 * ({total})) AS DOUBLE) / 1000000"


q("null_rates", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{m}' AS column, {ratio6(f'count(*) - count({m})', 'count(*)')} AS null_rate FROM measures" for m in METRICS)
  + ") x WHERE null_rate > 0")
NR_COLS = ("temperature", "pm25", "pm10", "o3")
q("null_rates_by_place", "SELECT place, " + ", ".join(
    f"{ratio6(f'count(*) - count({m})', 'count(*)')} AS {m}_null_rate" for m in NR_COLS) + " FROM measures GROUP BY place")
q("frequencies", """SELECT 'place' AS dimension, place AS value, count(*) AS n FROM measures GROUP BY place
  UNION ALL SELECT 'hour', CAST(hour(hour_ts) AS VARCHAR), count(*) FROM measures GROUP BY hour(hour_ts)
  UNION ALL SELECT 'is_weekend', CAST(CASE WHEN isodow(hour_ts) >= 6 THEN 1 ELSE 0 END AS VARCHAR), count(*)
  FROM measures GROUP BY 2""")


def hist_sql(col):
    x = f"CAST({col} AS DOUBLE)"
    return f"""SELECT '{col}' AS column, bin, round(lo + (bin - 1) * ((hi - lo) / 30), 6) AS bin_start,
  round(lo + bin * ((hi - lo) / 30), 6) AS bin_end, count(*) AS n FROM (
  SELECT CAST(least(floor(({x} - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) AS bin, lo, hi
  FROM measures, (SELECT min({x}) AS lo, max({x}) AS hi FROM measures) mm WHERE {col} IS NOT NULL) b
  GROUP BY bin, lo, hi"""


q("histogram", hist_sql("aqi") + " UNION ALL " + hist_sql("temperature"))
q("box_summary", """SELECT place, n, round(min, 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median,
  round(q3, 6) AS q3, round(max, 6) AS max, round(lf, 6) AS lower_fence, round(uf, 6) AS upper_fence, n_outliers FROM (
  SELECT s.*, (SELECT count(*) FROM measures m WHERE m.place = s.place AND (m.aqi < s.lf OR m.aqi > s.uf)) AS n_outliers
  FROM (SELECT place, n, min, q1, median, q3, max, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM (
    SELECT place, count(aqi) AS n, CAST(min(aqi) AS DOUBLE) AS min, quantile_cont(CAST(aqi AS DOUBLE), 0.25) AS q1,
      quantile_cont(CAST(aqi AS DOUBLE), 0.5) AS median, quantile_cont(CAST(aqi AS DOUBLE), 0.75) AS q3,
      CAST(max(aqi) AS DOUBLE) AS max FROM measures GROUP BY place) a) s) t""")
q("mean_by_hour", f"""SELECT hour(hour_ts) AS hour, {avg_hu('CAST(aqi AS DECIMAL(10,0))', 0, 4)} AS aqi_mean, count(aqi) AS n
  FROM measures GROUP BY hour(hour_ts)""")
q("mean_by_month", f"""SELECT month(hour_ts) AS month, {avg_hu('CAST(aqi AS DECIMAL(10,0))', 0, 4)} AS aqi_mean, count(aqi) AS n
  FROM measures GROUP BY month(hour_ts)""")
q("status_share", f"""SELECT place,
  {pct1("sum(CASE WHEN weather_status = 'OK' THEN 1 ELSE 0 END)", "count(*)")} AS weather_pct_OK,
  {pct1("sum(CASE WHEN weather_status = 'FAILED' THEN 1 ELSE 0 END)", "count(*)")} AS weather_pct_FAILED,
  {pct1("sum(CASE WHEN air_status = 'OK' THEN 1 ELSE 0 END)", "count(*)")} AS air_pct_OK,
  {pct1("sum(CASE WHEN air_status = 'FAILED' THEN 1 ELSE 0 END)", "count(*)")} AS air_pct_FAILED
  FROM measures GROUP BY place""")
SECTOR_EXPR = ("CASE WHEN wind_direction > 0 AND wind_direction <= 360 THEN list_extract(['N','NE','E','SE','S','SW','W','NW'], "
               "CAST(ceil(wind_direction / 45.0) AS INTEGER)) END")
qf("sector_share", "SELECT place, " + ", ".join(
    f"{pct1(f'sum(CASE WHEN sector = {chr(39)}{s}{chr(39)} THEN 1 ELSE 0 END)', 'count(*)')} AS pct_{s}" for s in SECTORS)
   + f" FROM (SELECT place, {SECTOR_EXPR} AS sector FROM forecast) f WHERE sector IS NOT NULL GROUP BY place")
PAIRS = [(a, b) for i, a in enumerate(METRICS) for b in METRICS[i + 1:]]
q("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) AS corr FROM measures"
    for a, b in PAIRS))


def iqr_sql(col):
    x = f"CAST({col} AS DOUBLE)"
    return f"""SELECT '{col}' AS column, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
  (SELECT count(*) FROM measures WHERE {x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM measures) qq"""


q("iqr_outliers", " UNION ALL ".join(iqr_sql(c) for c in ("aqi", "pm25", "pm10")))


def winsor_cte(col):
    x = f"CAST({col} AS DOUBLE)"
    return f"""
, f_{col} AS (SELECT place, slot, coalesce({x}, (SELECT median({x}) FROM measures)) AS v FROM measures)
, r_{col} AS (SELECT v, row_number() OVER (ORDER BY v) AS rn FROM f_{col})
, c_{col} AS (SELECT (SELECT v FROM r_{col} WHERE rn = (SELECT CAST(floor(0.01 * count(*)) AS BIGINT) + 1 FROM measures)) AS lo,
    (SELECT v FROM r_{col} WHERE rn = (SELECT count(*) - CAST(floor(0.01 * count(*)) AS BIGINT) FROM measures)) AS hi)"""


q("winsorize", "".join(winsor_cte(c) for c in ("aqi", "pm25", "pm10")) + """
SELECT a.place, a.slot, least(greatest(a.v, ca.lo), ca.hi) AS aqi_w, least(greatest(b.v, cb.lo), cb.hi) AS pm25_w,
  least(greatest(c.v, cc.lo), cc.hi) AS pm10_w
FROM f_aqi a JOIN f_pm25 b USING (place, slot) JOIN f_pm10 c USING (place, slot), c_aqi ca, c_pm25 cb, c_pm10 cc""")
qf("zip_arrays", "SELECT place, fc_ts, wind_direction, cloud_cover, precipitation FROM forecast")

q("config_coverage", """SELECT c.place, count(m.place) AS n_hours,
  CAST(coalesce(sum(CASE WHEN m.weather_status = 'OK' THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_weather,
  CAST(coalesce(sum(CASE WHEN m.air_status = 'OK' THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_air, count(m.place) > 0 AS covered
  FROM (SELECT 'V' || lpad(CAST(i AS VARCHAR), 2, '0') AS place FROM range(12) r(i)) c
  LEFT JOIN measures m ON m.place = c.place GROUP BY c.place""")
q("join_loss", """SELECT count(*) AS rows_before, count(p.place_id) AS rows_after,
  count(*) - count(p.place_id) AS rows_lost
  FROM fact f LEFT JOIN predictions p ON p.place_id = f.place_id AND p.target_ts = f.hour_ts""")
raw("changed_rows", f"""SELECT place_id, slot, inserted_at, modified_at, batch_id
  FROM ({ORACLE["upsert_fact"]}) u WHERE modified_at <> inserted_at""")
q("batch_rows", """SELECT place_id, slot, batch_id FROM fact
  WHERE batch_id = (SELECT arg_max(batch_id, (modified_at, batch_id)) FROM fact)""")
q("place_dim_stable", """, stored AS (SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS place_id, place
  FROM (SELECT DISTINCT place FROM measures WHERE place <> 'V00'))
  SELECT place_id, place FROM stored
  UNION ALL SELECT CAST((SELECT max(place_id) FROM stored) + 1 AS INTEGER), place
  FROM (SELECT DISTINCT place FROM measures WHERE place = 'V00')""")
