"""Stand-in inputs built from the driver's tables.

The driver data has no weather or air feed, so ``events`` is reshaped into
raw *readings* with the schema the pipeline expects (place, slot, reading
time, reading id, metrics).  These functions only shape rows; cleaning,
keep-last, merging, statuses and every report run in the library's
operators on top of them, and would run the same on real feeds.

The reshaping rules are fixed by FIXTURES.md §3 so that the DuckDB oracle
builds the identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions import columns as X

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# ---- fixed values of the stand-in derivation (FIXTURES.md §3) ------------
N_PLACES = 11
WEATHER_EVENTS = ("view", "click", "error")
AIR_EVENTS = ("purchase", "signup", "error")
DEAD_EVENT = "error"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  The tables hold zone-less wall-clock times, and
    hour keys format them through the session zone, so the session is
    pinned to UTC (a no-op when it already is)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(events: DataFrame) -> DataFrame:
    """Common columns of a reading: place from the user, hour slot from the
    event time, a small integer payload ``k`` from the JSON props."""
    return events.select(
        "event_id", "ts", "event_type", "value",
        (F.col("event_type") == DEAD_EVENT).alias("dead"),
        F.concat(F.lit("V"), F.lpad((F.col("user_id") % N_PLACES).cast("string"), 2, "0")).alias("place"),
        X.slot_key("ts").alias("slot"),
        X.hour_floor("ts").alias("hour_ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def weather_readings(events: DataFrame) -> DataFrame:
    """Raw weather readings: several per place-hour are possible."""
    r = readings(events.filter(F.col("event_type").isin(*WEATHER_EVENTS)))
    live = ~F.col("dead")
    return r.select(
        "place", "slot", "hour_ts", "ts", "event_id",
        F.when(live, F.floor(F.col("value") * 1.25) * 0.1 - 5.0).alias("temperature"),
        F.when(live, F.col("k")).alias("humidity"),
        F.when(live & (F.col("event_id") % 7 != 0), 990 + F.col("event_id") % 45).alias("pressure"),
        F.when(live, (F.col("k") % 16) * 0.9).alias("wind_speed"),
    )


def air_readings(events: DataFrame) -> DataFrame:
    """Raw air readings: several per place-hour are possible."""
    r = readings(events.filter(F.col("event_type").isin(*AIR_EVENTS)))
    live = ~F.col("dead")
    return r.select(
        "place", "slot", "hour_ts", "ts", "event_id",
        F.when(live, F.floor("value").cast("int")).alias("aqi"),
        F.when(live & (F.col("place") != "V03"), F.floor(F.col("value") * 9.0) * 0.1).alias("pm25"),
        F.when(live & (F.col("event_id") % 5 != 0), F.floor(F.col("value") * 4.0) * 0.1).alias("pm10"),
        F.when(live, (F.col("k") % 48) * 1.0).alias("no2"),
        F.when(live & (F.col("place") != "V07"), F.floor(F.col("value") * 6.0) * 0.1).alias("o3"),
    )


def run_batch_id(slot_col="slot"):
    """Run id the orchestrator would attach to the hour's load."""
    s = F.col(slot_col)
    return F.concat(F.when(s % 3 == 0, F.lit("manual__")).otherwise(F.lit("scheduled__")), s.cast("string"))


def bad_text(events: DataFrame) -> DataFrame:
    """Text column with non-numbers, for the coercion operator."""
    r = readings(events)
    return r.select("event_id", "place", "slot",
                    F.when(F.col("event_id") % 17 == 0, F.lit("n/a"))
                    .otherwise(F.col("k").cast("string")).alias("raw_text"))


def forecast_rows(slots: DataFrame) -> DataFrame:
    """Forecast values per place-hour: a deterministic function of the slot."""
    s = F.col("slot")
    return slots.select(
        "place", "slot", "hour_ts",
        ((s * 37) % 360).cast("int").alias("wind_direction"),
        ((s * 11) % 101).cast("int").alias("cloud_cover"),
        F.greatest((s % 5) * 1.0 - 2.0, F.lit(0.0)).alias("precipitation"),
    )
