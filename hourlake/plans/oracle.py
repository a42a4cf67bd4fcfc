"""DuckDB oracle SQL for every query key.

Each oracle is the shared derived view of FIXTURES.md §3 (``measures``)
plus companion views, followed by the report's final SELECT.  The Spark side
never runs this text: it builds the same result with DataFrame operators.
"""

from __future__ import annotations

HEAD = """WITH readings AS (SELECT event_id, ts, event_type, value, event_type = 'error' AS dead,
  'V' || lpad(CAST(user_id % 11 AS VARCHAR), 2, '0') AS place, CAST(strftime(ts,'%Y%m%d%H') AS BIGINT) AS slot,
  date_trunc('hour', ts) AS hour_ts, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events)
, weather AS (SELECT * FROM (SELECT place, slot, hour_ts,
    CASE WHEN NOT dead THEN floor(value * 1.25e0) * 0.1e0 - 5e0 END AS temperature,
    CASE WHEN NOT dead THEN k END AS humidity,
    CASE WHEN NOT dead AND event_id % 7 <> 0 THEN 990 + event_id % 45 END AS pressure,
    CASE WHEN NOT dead THEN (k % 16) * 0.9e0 END AS wind_speed,
    row_number() OVER (PARTITION BY place, slot ORDER BY ts DESC, event_id DESC) AS rn
  FROM readings WHERE event_type IN ('view','click','error')) w0 WHERE rn = 1)
, air AS (SELECT * FROM (SELECT place, slot, hour_ts,
    CASE WHEN NOT dead THEN CAST(floor(value) AS INT) END AS aqi,
    CASE WHEN NOT dead AND place <> 'V03' THEN floor(value * 9e0) * 0.1e0 END AS pm25,
    CASE WHEN NOT dead AND event_id % 5 <> 0 THEN floor(value * 4e0) * 0.1e0 END AS pm10,
    CASE WHEN NOT dead THEN (k % 48) * 1e0 END AS no2,
    CASE WHEN NOT dead AND place <> 'V07' THEN floor(value * 6e0) * 0.1e0 END AS o3,
    row_number() OVER (PARTITION BY place, slot ORDER BY ts DESC, event_id DESC) AS rn
  FROM readings WHERE event_type IN ('purchase','signup','error')) a0 WHERE rn = 1)
, merged AS (SELECT coalesce(w.place, a.place) AS place, coalesce(w.slot, a.slot) AS slot,
    coalesce(w.hour_ts, a.hour_ts) AS hour_ts,
    temperature, humidity, pressure, wind_speed, aqi, pm25, pm10, no2, o3
  FROM weather w FULL OUTER JOIN air a ON w.place = a.place AND w.slot = a.slot)
, measures AS (SELECT *,
    CASE WHEN coalesce(temperature, humidity, pressure, wind_speed) IS NULL THEN 'FAILED' ELSE 'OK' END AS weather_status,
    CASE WHEN coalesce(CAST(aqi AS DOUBLE), pm25, pm10, no2, o3) IS NULL THEN 'FAILED' ELSE 'OK' END AS air_status,
    CASE WHEN slot % 3 = 0 THEN 'manual__' ELSE 'scheduled__' END || CAST(slot AS VARCHAR(20)) AS batch_id
  FROM merged WHERE coalesce(temperature, humidity, pressure, wind_speed, aqi, pm25, pm10, no2, o3) IS NOT NULL)
, places AS (SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS place_id, place
  FROM (SELECT DISTINCT place FROM measures))
, times AS (SELECT slot, min(hour_ts) AS hour_ts, year(min(hour_ts)) AS year, month(min(hour_ts)) AS month,
    day(min(hour_ts)) AS day, hour(min(hour_ts)) AS hour FROM measures GROUP BY slot)
, fact AS (SELECT p.place_id, m.slot, m.hour_ts,
    CAST(round(m.temperature, 2) AS DECIMAL(5,2)) AS temperature, CAST(m.humidity AS INTEGER) AS humidity,
    CAST(m.pressure AS INTEGER) AS pressure, CAST(round(m.wind_speed, 2) AS DECIMAL(5,2)) AS wind_speed,
    CAST(m.aqi AS INTEGER) AS aqi, CAST(round(m.pm25, 2) AS DECIMAL(6,2)) AS pm25,
    CAST(round(m.pm10, 2) AS DECIMAL(6,2)) AS pm10, CAST(round(m.no2, 2) AS DECIMAL(6,2)) AS no2,
    CAST(round(m.o3, 2) AS DECIMAL(6,2)) AS o3, m.weather_status, m.air_status, m.batch_id,
    m.hour_ts AS inserted_at, m.hour_ts AS modified_at
  FROM measures m JOIN places p ON m.place = p.place)
, predictions AS (SELECT place_id, hour_ts AS target_ts, CAST(round(m6, 2) AS DECIMAL(6,2)) AS aqi_pred,
    CASE WHEN CAST(round(m6, 2) AS DECIMAL(6,2)) > 100 THEN 'ALERTE' ELSE 'OK' END AS alert,
    hour_ts - INTERVAL 1 HOUR AS predicted_at, batch_id
  FROM (SELECT *, avg(aqi) OVER (PARTITION BY place_id ORDER BY date_diff('hour', TIMESTAMP '1970-01-01', hour_ts)
      RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS m6 FROM fact) p0 WHERE m6 IS NOT NULL)
, thresholds AS (SELECT * FROM (VALUES
    (1, 'PM2.5', 'Moyenne 24h', CAST(15.00 AS DECIMAL(6,2)), 'Limite OMS'),
    (2, 'PM2.5', 'Moyenne 24h', CAST(25.00 AS DECIMAL(6,2)), 'Danger'),
    (3, 'PM10', 'Moyenne 24h', CAST(45.00 AS DECIMAL(6,2)), 'Limite OMS'),
    (4, 'NO2', 'Moyenne 24h', CAST(25.00 AS DECIMAL(6,2)), 'Limite OMS'),
    (5, 'O3', 'Moyenne 8h', CAST(100.00 AS DECIMAL(6,2)), 'Limite OMS'))
    AS t(threshold_id, pollutant, period, limit_value, level))
"""

ORACLE: dict[str, str] = {}


def oracle(name: str, tail: str, head: str = HEAD) -> None:
    ORACLE[name] = head + tail


def raw(name: str, sql: str) -> None:
    ORACLE[name] = sql


# Integer form of round-half-up(100 * part / total, 1) used by the oracle so
# that both engines round the exact ratio once.
def pct1(part: str, total: str) -> str:
    return f"CAST((2000 * ({part}) + ({total})) // (2 * ({total})) AS DOUBLE) / 10"


oracle("availability_by_place", f"""
SELECT p.place, count(*) AS total_runs,
  sum(CASE WHEN f.weather_status = 'OK' AND f.air_status = 'OK' THEN 1 ELSE 0 END) AS complete_runs,
  {pct1("sum(CASE WHEN f.weather_status = 'OK' AND f.air_status = 'OK' THEN 1 ELSE 0 END)", "count(*)")} AS pct_available
FROM fact f JOIN places p ON f.place_id = p.place_id
GROUP BY p.place ORDER BY pct_available""")


def avg_hu(col: str, col_scale: int, out_scale: int) -> str:
    """Exact mean of a DECIMAL column rounded half-up (away from zero) to
    ``out_scale`` digits, via integer arithmetic, as DOUBLE."""
    num = f"(CAST(sum({col}) * {10 ** col_scale} AS HUGEINT) * {10 ** (out_scale - col_scale)})"
    n = f"count({col})"
    return f"CAST(sign({num}) * ((2 * abs({num}) + {n}) // (2 * {n})) AS DOUBLE) / {10 ** out_scale}"


def run_type(col: str = "batch_id") -> str:
    return f"CASE WHEN {col} LIKE 'scheduled%' THEN 'Schedulé' ELSE 'Manuel' END"


FACT_OUT = """place_id, slot, hour_ts, CAST(temperature AS DOUBLE) AS temperature, humidity, pressure,
  CAST(wind_speed AS DOUBLE) AS wind_speed, aqi, CAST(pm25 AS DOUBLE) AS pm25, CAST(pm10 AS DOUBLE) AS pm10,
  CAST(no2 AS DOUBLE) AS no2, CAST(o3 AS DOUBLE) AS o3, weather_status, air_status, batch_id, inserted_at, modified_at"""

oracle("scan_fact", f"SELECT {FACT_OUT} FROM fact")
oracle("kpi_counts", """SELECT count(*) AS n_measures, count(DISTINCT slot) AS n_slots,
  (SELECT count(*) FROM places) AS n_places FROM fact""")
oracle("runs_by_type", f"SELECT {run_type()} AS run_type, count(DISTINCT batch_id) AS n_runs FROM fact GROUP BY 1")
oracle("rows_by_type", f"SELECT {run_type()} AS run_type, count(*) AS n_rows FROM fact GROUP BY 1")
oracle("availability_global", f"""SELECT {pct1("sum(CASE WHEN weather_status = 'OK' AND air_status = 'OK' THEN 1 ELSE 0 END)", "count(*)")}
  AS pct_available FROM fact""")
oracle("time_range", """SELECT min(hour_ts) AS first_ts, max(hour_ts) AS last_ts,
  date_diff('day', CAST(min(hour_ts) AS DATE), CAST(max(hour_ts) AS DATE)) AS n_days,
  date_diff('hour', min(hour_ts), max(hour_ts)) AS n_hours FROM times""")
oracle("temp_by_place", f"""SELECT p.place, {avg_hu("f.temperature", 2, 2)} AS temp_avg,
  CAST(min(f.temperature) AS DOUBLE) AS temp_min, CAST(max(f.temperature) AS DOUBLE) AS temp_max
  FROM fact f JOIN places p USING (place_id) WHERE f.temperature IS NOT NULL GROUP BY p.place""")
oracle("aqi_by_place", f"""SELECT place, aqi_mean, pm25_mean,
  CASE WHEN aqi_mean <= 50 THEN 'Bon' WHEN aqi_mean <= 100 THEN 'Modéré'
       WHEN aqi_mean <= 150 THEN 'Mauvais pour groupes sensibles' ELSE 'Mauvais' END AS air_quality
  FROM (SELECT p.place, CAST(sum(f.aqi) // count(f.aqi) AS BIGINT) AS aqi_mean, {avg_hu("f.pm25", 2, 2)} AS pm25_mean
        FROM fact f JOIN places p USING (place_id) WHERE f.aqi IS NOT NULL GROUP BY p.place) a""")
oracle("places_per_slot", "SELECT slot, count(*) AS n_places FROM fact GROUP BY slot")
oracle("latest_rows", """SELECT f.slot, p.place, CAST(f.temperature AS DOUBLE) AS temperature, f.humidity, f.aqi,
  f.weather_status, f.air_status, f.inserted_at FROM fact f JOIN places p USING (place_id)
  ORDER BY f.slot DESC, p.place LIMIT 22""")
oracle("partial_outages", """SELECT p.place, t.hour_ts, f.weather_status, f.air_status
  FROM fact f JOIN places p USING (place_id) JOIN times t ON f.slot = t.slot
  WHERE f.weather_status = 'FAILED' OR f.air_status = 'FAILED'""")
oracle("threshold_status", """SELECT p.place, t.hour_ts, CAST(f.pm25 AS DOUBLE) AS pm25,
  CAST(s.limit_value AS DOUBLE) AS limit_value, s.level,
  CASE WHEN f.pm25 > s.limit_value THEN 'DEPASSEMENT' ELSE 'OK' END AS status
  FROM fact f JOIN places p USING (place_id) JOIN times t ON f.slot = t.slot CROSS JOIN thresholds s
  WHERE s.pollutant = 'PM2.5' AND s.level = 'Limite OMS' AND f.pm25 IS NOT NULL""")
oracle("exceedances_by_place", """SELECT p.place, count(*) AS n_exceedances
  FROM fact f JOIN places p USING (place_id) CROSS JOIN thresholds s
  WHERE s.pollutant = 'PM2.5' AND s.level = 'Limite OMS' AND f.pm25 > s.limit_value GROUP BY p.place""")

GAPS = """SELECT slot AS last_slot, next_slot, {missing} AS n_missing FROM (
  SELECT slot, hour_ts, lead(slot) OVER (ORDER BY slot) AS next_slot, lead(hour_ts) OVER (ORDER BY slot) AS next_ts
  FROM {src}) g WHERE next_slot IS NOT NULL AND {missing} > 0"""
KEY_MISSING = "next_slot - slot - 1"
HOUR_MISSING = "date_diff('hour', hour_ts, next_ts) - 1"
PEAK_TIMES = "(SELECT slot, min(hour_ts) AS hour_ts FROM measures WHERE aqi > 100 GROUP BY slot) pt"
oracle("slot_gaps_key", GAPS.format(missing=KEY_MISSING, src="times"))
oracle("slot_gaps_hours", GAPS.format(missing=HOUR_MISSING, src="times"))
oracle("peak_gaps_key", GAPS.format(missing=KEY_MISSING, src=PEAK_TIMES))
oracle("peak_gaps_hours", GAPS.format(missing=HOUR_MISSING, src=PEAK_TIMES))
oracle("gap_count", "SELECT count(*) AS n_gaps FROM (" + GAPS.format(missing=KEY_MISSING, src="times") + ") x")
oracle("last_batch", """SELECT arg_max(batch_id, (modified_at, batch_id)) AS batch_id, max(modified_at) AS modified_at
  FROM fact""")
oracle("last_run", """SELECT t.hour_ts, f.inserted_at, f.batch_id FROM fact f JOIN times t ON f.slot = t.slot
  ORDER BY f.inserted_at DESC, t.hour_ts DESC, f.batch_id DESC LIMIT 1""")
oracle("outages_by_source", """SELECT p.place,
  sum(CASE WHEN f.weather_status = 'FAILED' THEN 1 ELSE 0 END) AS weather_outages,
  sum(CASE WHEN f.air_status = 'FAILED' THEN 1 ELSE 0 END) AS air_outages
  FROM fact f JOIN places p USING (place_id) GROUP BY p.place""")
oracle("kpi_means", f"""SELECT count(*) AS n_measures, count(DISTINCT place_id) AS n_places,
  {avg_hu("CAST(aqi AS DECIMAL(10,0))", 0, 4)} AS aqi_mean, {avg_hu("temperature", 2, 4)} AS temp_mean,
  {avg_hu("CAST(humidity AS DECIMAL(10,0))", 0, 4)} AS humidity_mean, {avg_hu("pm10", 2, 4)} AS pm10_mean,
  {avg_hu("wind_speed", 2, 4)} AS wind_mean, sum(CASE WHEN aqi > 100 THEN 1 ELSE 0 END) AS n_alerts FROM fact""")
oracle("daily_means", f"""SELECT p.place, strftime(f.hour_ts, '%Y-%m-%d') AS day,
  {avg_hu("CAST(f.aqi AS DECIMAL(10,0))", 0, 2)} AS aqi_mean, {avg_hu("f.temperature", 2, 2)} AS temp_mean,
  {avg_hu("CAST(f.humidity AS DECIMAL(10,0))", 0, 2)} AS humidity_mean
  FROM fact f JOIN places p USING (place_id) GROUP BY p.place, strftime(f.hour_ts, '%Y-%m-%d')""")
oracle("pollutants_by_place", f"""SELECT p.place, {avg_hu("f.pm10", 2, 2)} AS pm10_mean,
  {avg_hu("f.pm25", 2, 2)} AS pm25_mean, {avg_hu("f.o3", 2, 2)} AS o3_mean
  FROM fact f JOIN places p USING (place_id) GROUP BY p.place""")
oracle("status_counts", """SELECT 'weather' AS source, weather_status AS status, count(*) AS n FROM fact GROUP BY 2
  UNION ALL SELECT 'air', air_status, count(*) FROM fact GROUP BY 2""")

STAGED = """, staged AS (
  SELECT * REPLACE (aqi + 1 AS aqi) FROM measures
  WHERE CAST(hour_ts AS DATE) = (SELECT max(CAST(hour_ts AS DATE)) FROM measures) AND place <> 'V10'
  UNION ALL SELECT * FROM measures WHERE place = 'V10')
, em AS (SELECT * FROM measures WHERE place <> 'V10')
, eplaces AS (SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS place_id, place FROM (SELECT DISTINCT place FROM em))
, newp AS (SELECT place, CAST((SELECT coalesce(max(place_id), 0) FROM eplaces) + row_number() OVER (ORDER BY place) AS INTEGER) AS place_id
  FROM (SELECT DISTINCT place FROM staged) s WHERE NOT EXISTS (SELECT 1 FROM eplaces e WHERE e.place = s.place))
, lplaces AS (SELECT place_id, place FROM eplaces UNION ALL SELECT place_id, place FROM newp)
"""


def staged_oracle(name: str, tail: str) -> None:
    oracle(name, STAGED + tail)


staged_oracle("staging_counts", """SELECT 'places_staging' AS staging_table, count(DISTINCT place) AS n FROM staged
  UNION ALL SELECT 'times_staging', count(DISTINCT slot) FROM staged
  UNION ALL SELECT 'facts_staging', count(*) FROM staged""")
oracle("batch_filter", f"SELECT {FACT_OUT} FROM fact WHERE batch_id LIKE 'manual%'")
oracle("metric_pair", """SELECT p.place, f.hour_ts, CAST(f.humidity AS DOUBLE) AS humidity, CAST(f.pm25 AS DOUBLE) AS pm25
  FROM fact f JOIN places p USING (place_id) WHERE f.humidity IS NOT NULL AND f.pm25 IS NOT NULL""")
oracle("day_slots", """SELECT p.place, f.slot, f.aqi, CAST(f.temperature AS DOUBLE) AS temperature
  FROM fact f JOIN places p USING (place_id) WHERE f.slot BETWEEN 2024011500 AND 2024011523""")
oracle("place_date_filter", """SELECT p.place, f.hour_ts, f.aqi, CAST(f.temperature AS DOUBLE) AS temperature
  FROM fact f JOIN places p USING (place_id) WHERE p.place IN ('V01', 'V02', 'V05')
  AND CAST(f.hour_ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""")
oracle("peaks_by_place", f"""SELECT place, n_rows, n_peaks, {pct1("n_peaks", "n_rows")} AS pct_peaks FROM (
  SELECT p.place, count(*) AS n_rows, sum(CASE WHEN f.aqi > 100 THEN 1 ELSE 0 END) AS n_peaks
  FROM fact f JOIN places p USING (place_id) GROUP BY p.place) a""")
oracle("predictions_listing", """SELECT p.place, a.target_ts, CAST(a.aqi_pred AS DOUBLE) AS aqi_pred, a.alert,
  a.predicted_at, a.batch_id FROM predictions a JOIN places p USING (place_id)""")
oracle("future_predictions", """SELECT p.place, a.target_ts, CAST(a.aqi_pred AS DOUBLE) AS aqi_pred, a.alert
  FROM predictions a JOIN places p USING (place_id) WHERE a.target_ts >= TIMESTAMP '2024-01-25 00:00:00'""")
oracle("alerts_only", """SELECT p.place, a.target_ts, CAST(a.aqi_pred AS DOUBLE) AS aqi_pred, a.predicted_at
  FROM predictions a JOIN places p USING (place_id) WHERE a.alert = 'ALERTE'""")
oracle("predicted_by_place", f"""SELECT p.place, {avg_hu("a.aqi_pred", 2, 2)} AS aqi_pred_mean, count(*) AS n_predictions
  FROM predictions a JOIN places p USING (place_id) GROUP BY p.place""")
oracle("latest_prediction", """SELECT p.place, max(a.target_ts) AS last_target_ts, max(a.predicted_at) AS last_run_ts
  FROM predictions a JOIN places p USING (place_id) GROUP BY p.place""")

staged_oracle("new_members", """SELECT 'place' AS member_type, place AS member_key, CAST(place_id AS BIGINT) AS member_id FROM newp
  UNION ALL SELECT 'time', CAST(slot AS VARCHAR), slot FROM (SELECT DISTINCT slot FROM staged) s
  WHERE slot NOT IN (SELECT DISTINCT slot FROM em)""")
staged_oracle("key_lookup", "SELECT s.place, l.place_id, s.slot FROM staged s JOIN lplaces l ON s.place = l.place")
staged_oracle("upsert_fact", """, efact AS (SELECT e.place_id, m.slot, m.hour_ts,
    CAST(round(m.temperature, 2) AS DECIMAL(5,2)) AS temperature, CAST(m.humidity AS INTEGER) AS humidity,
    CAST(m.pressure AS INTEGER) AS pressure, CAST(round(m.wind_speed, 2) AS DECIMAL(5,2)) AS wind_speed,
    CAST(m.aqi AS INTEGER) AS aqi, CAST(round(m.pm25, 2) AS DECIMAL(6,2)) AS pm25,
    CAST(round(m.pm10, 2) AS DECIMAL(6,2)) AS pm10, CAST(round(m.no2, 2) AS DECIMAL(6,2)) AS no2,
    CAST(round(m.o3, 2) AS DECIMAL(6,2)) AS o3, m.weather_status, m.air_status, m.batch_id,
    m.hour_ts AS inserted_at, m.hour_ts AS modified_at FROM em m JOIN eplaces e ON m.place = e.place)
, src AS (SELECT l.place_id, s.slot, s.hour_ts,
    CAST(round(s.temperature, 2) AS DECIMAL(5,2)) AS temperature, CAST(s.humidity AS INTEGER) AS humidity,
    CAST(s.pressure AS INTEGER) AS pressure, CAST(round(s.wind_speed, 2) AS DECIMAL(5,2)) AS wind_speed,
    CAST(s.aqi AS INTEGER) AS aqi, CAST(round(s.pm25, 2) AS DECIMAL(6,2)) AS pm25,
    CAST(round(s.pm10, 2) AS DECIMAL(6,2)) AS pm10, CAST(round(s.no2, 2) AS DECIMAL(6,2)) AS no2,
    CAST(round(s.o3, 2) AS DECIMAL(6,2)) AS o3, s.weather_status, s.air_status
    FROM staged s JOIN lplaces l ON s.place = l.place)
SELECT coalesce(t.place_id, s.place_id) AS place_id, coalesce(t.slot, s.slot) AS slot,
  CASE WHEN t.place_id IS NOT NULL THEN t.hour_ts ELSE s.hour_ts END AS hour_ts,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.temperature ELSE t.temperature END AS DOUBLE) AS temperature,
  CASE WHEN s.place_id IS NOT NULL THEN s.humidity ELSE t.humidity END AS humidity,
  CASE WHEN s.place_id IS NOT NULL THEN s.pressure ELSE t.pressure END AS pressure,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.wind_speed ELSE t.wind_speed END AS DOUBLE) AS wind_speed,
  CASE WHEN s.place_id IS NOT NULL THEN s.aqi ELSE t.aqi END AS aqi,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.pm25 ELSE t.pm25 END AS DOUBLE) AS pm25,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.pm10 ELSE t.pm10 END AS DOUBLE) AS pm10,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.no2 ELSE t.no2 END AS DOUBLE) AS no2,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.o3 ELSE t.o3 END AS DOUBLE) AS o3,
  CASE WHEN s.place_id IS NOT NULL THEN s.weather_status ELSE t.weather_status END AS weather_status,
  CASE WHEN s.place_id IS NOT NULL THEN s.air_status ELSE t.air_status END AS air_status,
  CASE WHEN s.place_id IS NOT NULL THEN 'manual__2024020100' ELSE t.batch_id END AS batch_id,
  CASE WHEN t.place_id IS NOT NULL THEN t.inserted_at ELSE TIMESTAMP '2024-02-01 00:00:00' END AS inserted_at,
  CASE WHEN s.place_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE t.modified_at END AS modified_at
FROM efact t FULL OUTER JOIN src s ON t.place_id = s.place_id AND t.slot = s.slot""")
oracle("upsert_predictions", """, tgt AS (SELECT * FROM predictions WHERE place_id NOT IN (SELECT place_id FROM places WHERE place = 'V10'))
, src AS (SELECT place_id, target_ts, CAST(aqi_pred + 0.5 AS DECIMAL(6,2)) AS aqi_pred,
    CASE WHEN CAST(aqi_pred + 0.5 AS DECIMAL(6,2)) > 100 THEN 'ALERTE' ELSE 'OK' END AS alert
    FROM predictions WHERE CAST(target_ts AS DATE) = (SELECT max(CAST(target_ts AS DATE)) FROM predictions))
SELECT coalesce(t.place_id, s.place_id) AS place_id, coalesce(t.target_ts, s.target_ts) AS target_ts,
  CAST(CASE WHEN s.place_id IS NOT NULL THEN s.aqi_pred ELSE t.aqi_pred END AS DOUBLE) AS aqi_pred,
  CASE WHEN s.place_id IS NOT NULL THEN s.alert ELSE t.alert END AS alert,
  CASE WHEN s.place_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE t.predicted_at END AS predicted_at,
  CASE WHEN s.place_id IS NOT NULL THEN 'manual__2024020100' ELSE t.batch_id END AS batch_id
FROM tgt t FULL OUTER JOIN src s ON t.place_id = s.place_id AND t.target_ts = s.target_ts""")
oracle("rollback_batch", f"""SELECT {FACT_OUT} FROM fact
  WHERE batch_id <> (SELECT arg_max(batch_id, (modified_at, batch_id)) FROM fact)""")
oracle("insert_defaults", """SELECT place, slot, 'OK' AS weather_status, 'OK' AS air_status, 'MANUAL_LOAD' AS batch_id
  FROM merged WHERE coalesce(temperature, humidity, pressure, wind_speed, aqi, pm25, pm10, no2, o3) IS NOT NULL""")
