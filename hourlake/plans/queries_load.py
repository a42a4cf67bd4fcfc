"""Query keys for the versioned load."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourlake.operators import clean
from hourlake.operators import load as LD
from hourlake.operators import versions as V
from hourlake.plans.catalog import FIRST_BATCH, FIRST_TS, LOAD_BATCH, LOAD_TS, StoredGold, new_warehouse, out, query
from hourlake.plans.oracle import FACT_OUT, STAGED, oracle

def two_loads(spark, sf_dir) -> V.Warehouse:
    """A warehouse after a first load and the staging batch of the reports."""
    g = StoredGold(spark, sf_dir)
    _, dead = clean.split_dead(g.merged)
    warehouse = new_warehouse(spark)
    LD.load_run(warehouse, g.existing_measures(), FIRST_BATCH, FIRST_TS, dead.select("place", "slot", F.lit("dead_row").alias("reason")))
    LD.load_run(warehouse, g.staged(), LOAD_BATCH, LOAD_TS)
    return warehouse


@query("staging_load")
def q_staging_load(spark, sf_dir):
    """Rows of the three staging tables as read back from them; what
    an earlier load left there is gone."""
    g = StoredGold(spark, sf_dir)
    warehouse = new_warehouse(spark)
    warehouse.stage("old", LD.staging_frames(g.measures))
    warehouse.reset_staging()
    staged = warehouse.stage("new", LD.staging_frames(g.staged()))
    counts = [staged[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("staging_table"), "n")
              for name in ("places", "times", "facts")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("ordered_load")
def q_ordered_load(spark, sf_dir):
    """The fact table as the warehouse's newest version has it."""
    return out(two_loads(spark, sf_dir).read("fact").drop(LD.DAY))


@query("ordered_load_dimensions")
def q_ordered_load_dimensions(spark, sf_dir):
    """Both dimensions of the newest version."""
    warehouse = two_loads(spark, sf_dir)
    places = warehouse.read("places").select(F.lit("place").alias("member_type"), F.col("place").alias("member_key"),
                                             F.col("place_id").cast("long").alias("member_id"))
    return places.unionByName(warehouse.read("times").select(
        F.lit("time").alias("member_type"), F.date_format("hour_ts", "yyyy-MM-dd HH:mm").alias("member_key"), F.col("slot").alias("member_id")))


@query("load_log")
def q_load_log(spark, sf_dir):
    """§2.14: a row a load, counted while it wrote."""
    return two_loads(spark, sf_dir).read("load_log")


@query("batch_withdrawn")
def q_batch_withdrawn(spark, sf_dir):
    """The newest version after the second batch was taken back, beside
    the number of rows of the version before, which is still readable."""
    warehouse = two_loads(spark, sf_dir)
    before = warehouse.versions()[-1]
    LD.delete_batch(warehouse, "fact", LOAD_BATCH)
    rows = lambda version: warehouse.read("fact", version).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    return rows(before).withColumn("state", F.lit("before")).unionByName(rows(None).withColumn("state", F.lit("after")))


LOADED = STAGED + f""", src AS (SELECT l.place_id, s.* EXCLUDE (batch_id) FROM staged s JOIN lplaces l ON s.place = l.place)
, old AS (SELECT e.place_id, m.* EXCLUDE (batch_id) FROM em m JOIN eplaces e ON m.place = e.place)
, loads AS (SELECT *, 2 AS load FROM src UNION ALL SELECT *, 1 FROM old)
, loaded AS (SELECT *, row_number() OVER (PARTITION BY place_id, slot ORDER BY load DESC) AS rn,
    min(load) OVER (PARTITION BY place_id, slot) AS first_load FROM loads)
, lfact AS (SELECT place_id, slot, hour_ts,
    CAST(round(temperature, 2) AS DECIMAL(5,2)) AS temperature, CAST(humidity AS INTEGER) AS humidity,
    CAST(pressure AS INTEGER) AS pressure, CAST(round(wind_speed, 2) AS DECIMAL(5,2)) AS wind_speed, CAST(aqi AS INTEGER) AS aqi,
    CAST(round(pm25, 2) AS DECIMAL(6,2)) AS pm25, CAST(round(pm10, 2) AS DECIMAL(6,2)) AS pm10,
    CAST(round(no2, 2) AS DECIMAL(6,2)) AS no2, CAST(round(o3, 2) AS DECIMAL(6,2)) AS o3, weather_status, air_status,
    CASE load WHEN 2 THEN '{LOAD_BATCH}' ELSE '{FIRST_BATCH}' END AS batch_id,
    CASE first_load WHEN 2 THEN TIMESTAMP '{LOAD_TS}' ELSE TIMESTAMP '{FIRST_TS}' END AS inserted_at,
    CASE load WHEN 2 THEN TIMESTAMP '{LOAD_TS}' ELSE TIMESTAMP '{FIRST_TS}' END AS modified_at, load, first_load
  FROM loaded WHERE rn = 1)
"""
oracle("staging_load", STAGED + """SELECT 'places' AS staging_table, count(DISTINCT place) AS n FROM staged
  UNION ALL SELECT 'times', count(DISTINCT slot) FROM staged UNION ALL SELECT 'facts', count(*) FROM staged""")
oracle("ordered_load", LOADED + f"SELECT {FACT_OUT} FROM lfact")
oracle("ordered_load_dimensions", STAGED + """SELECT 'place' AS member_type, place AS member_key, CAST(place_id AS BIGINT) AS member_id FROM lplaces
  UNION ALL SELECT 'time', strftime(hour_ts, '%Y-%m-%d %H:%M'), slot FROM (
    SELECT DISTINCT slot, hour_ts FROM em UNION SELECT DISTINCT slot, hour_ts FROM staged) t""")
oracle("load_log", LOADED + f"""SELECT '{FIRST_BATCH}' AS batch_id, TIMESTAMP '{FIRST_TS}' AS loaded_at, (SELECT count(*) FROM old) AS staged,
    (SELECT count(*) FROM old) AS inserted, CAST(0 AS BIGINT) AS updated,
    (SELECT count(*) FROM merged WHERE coalesce(temperature, humidity, pressure, wind_speed, aqi, pm25, pm10, no2, o3) IS NULL) AS rejected,
    (SELECT count(*) FROM eplaces) AS new_places, (SELECT count(DISTINCT slot) FROM em) AS new_times
  UNION ALL SELECT '{LOAD_BATCH}', TIMESTAMP '{LOAD_TS}', (SELECT count(*) FROM src), (SELECT count(*) FROM lfact WHERE first_load = 2),
    (SELECT count(*) FROM lfact WHERE load = 2 AND first_load = 1), 0, (SELECT count(*) FROM newp),
    (SELECT count(DISTINCT slot) FROM staged WHERE slot NOT IN (SELECT slot FROM em))""")
oracle("batch_withdrawn", LOADED + f"""SELECT batch_id, count(*) AS n, 'before' AS state FROM lfact GROUP BY batch_id
  UNION ALL SELECT batch_id, count(*), 'after' FROM lfact WHERE batch_id <> '{LOAD_BATCH}' GROUP BY batch_id""")
