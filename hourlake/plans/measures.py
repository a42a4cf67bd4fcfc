"""The hourly measures plan: readings -> keep-last per source -> full outer
merge -> dead-row split -> statuses.  This is the cleaned zone every report,
feature and load runs on (FIXTURES.md §3 ``measures``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import clean, merge
from hourlake.sources import testdata as TD

MEASURE_COLUMNS = ("place", "slot", "hour_ts") + X.ALL_METRICS + (
    "weather_status", "air_status", "batch_id")


def merge_sources(weather: DataFrame, air: DataFrame) -> DataFrame:
    """Keep the last reading per (place, slot) in each source, then merge."""
    order = ("ts", "event_id")
    w = clean.keep_last(weather, ["place", "slot"], order).drop(*order)
    a = clean.keep_last(air, ["place", "slot"], order).drop(*order)
    return merge.full_outer_merge(w, a, ("place", "slot"), ("hour_ts",))


def clean_measures(merged: DataFrame, batch_id=None) -> DataFrame:
    """Drop dead rows (all nine metrics NULL), add statuses and the run id."""
    valid, _dead = clean.split_dead(merged)
    valid = clean.add_source_status(valid)
    valid = valid.withColumn("batch_id", batch_id if batch_id is not None else TD.run_batch_id())
    return valid.select(*MEASURE_COLUMNS)


def measures_from_events(events: DataFrame) -> DataFrame:
    merged = merge_sources(TD.weather_readings(events), TD.air_readings(events))
    return clean_measures(merged)


def merged_from_events(events: DataFrame) -> DataFrame:
    return merge_sources(TD.weather_readings(events), TD.air_readings(events))


def load_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures_from_events(TD.table(spark, sf_dir, "events"))
