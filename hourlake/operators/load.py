"""The hourly load as one run: staging, dimensions, facts, log, one switch
(SURVEY §2.9 I1-I8, A13; §2.14 run log).

``load_run`` stages the batch, adds new members to the dimensions, merges the
fact rows into the days they touch, writes a log row, and makes all of it
visible with the warehouse's one rename.  Whatever fails before leaves readers
on the old version.  Loading the same batch again gives the same tables.

``upsert_table`` and ``append_table`` do the same for one table (predictions,
alerts), ``delete_batch`` takes one load back.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import clean
from hourlake.operators import star as S
from hourlake.operators import upsert as U
from hourlake.operators.versions import Warehouse, distinct_values

UPDATE_COLS = X.ALL_METRICS + ("weather_status", "air_status")
DAY = "day"
LOG_SCHEMA = ("batch_id string, loaded_at timestamp_ntz, staged long, inserted long, updated long, rejected long, "
              "new_places long, new_times long")


def day_of(ts) -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd")


def load_name(batch_id: str) -> str:
    """A folder name of its own for a try at loading a batch."""
    return f"{re.sub('[^A-Za-z0-9_-]', '-', batch_id)}-{uuid.uuid4().hex[:12]}"


def staging_frames(measures: DataFrame) -> dict[str, DataFrame]:
    """The three staging tables of a cleaned batch: places (the first row
    of each, C4), times and facts."""
    places = clean.keep_first(measures.select("place", "slot"), ["place"], ("slot",)).select("place")
    return {"places": places, "times": S.time_dim(measures), "facts": measures}


def counted(rows: DataFrame, name: str, **counts) -> tuple[DataFrame, Observation]:
    """Rows that count themselves while they are written."""
    watch = Observation(name)
    return rows.observe(watch, *[c.alias(k) for k, c in counts.items()]), watch


def _target(warehouse: Warehouse, tables: dict, name: str, days=None) -> DataFrame | None:
    entry = tables.get(name)
    return None if entry is None else warehouse.rows(entry, days)


def _merge_days(warehouse: Warehouse, tables: dict, name: str, source: DataFrame, keys, update_cols, load_ts, batch_id,
                load: str, **kw):
    """Merge a source into the day partitions it touches, into new folders;
    gives the table's new entry and (inserted, updated)."""
    days = distinct_values(source, DAY)
    target = _target(warehouse, tables, name, days)
    if target is None:
        target = U.empty_target(source, **kw)
    merged = U.merge_upsert(target, source, keys, update_cols, load_ts, batch_id, insert_only_cols=(DAY,),
                            action_col="_action", **kw)
    watches = []

    def last(rows: DataFrame) -> DataFrame:
        was = lambda action: F.sum((F.col("_action") == action).cast("long"))
        rows, watch = counted(rows, f"{name}-{load}", inserted=was("inserted"), updated=was("updated"))
        watches.append(watch)
        return rows.drop("_action")

    entry = warehouse.write(name, merged, load, DAY, last)
    got = watches[0].get if days else {}
    entry = warehouse.merged_entry(tables.get(name), entry, days)
    return entry, (got.get("inserted") or 0, got.get("updated") or 0)


def load_run(warehouse: Warehouse, measures: DataFrame, batch_id: str, load_ts: str, rejects: DataFrame | None = None) -> int:
    """Load a cleaned batch (place, slot, hour_ts, metrics, statuses) and
    return the new version."""
    spark = warehouse.spark
    based_on, tables = warehouse.newest()
    load = load_name(batch_id)
    warehouse.reset_staging()
    staged = warehouse.stage(load, staging_frames(S.insert_defaults(measures)))

    # dimensions first: members keep their keys, new ones get further keys
    old_places, old_times = _target(warehouse, tables, "places"), _target(warehouse, tables, "times")
    if old_places is None:
        old_places = spark.createDataFrame([], "place_id int, place string")
    new_places = S.new_members(staged["places"], old_places, "place", "place_id").select("place_id", "place")
    new_times = staged["times"] if old_times is None else S.new_members(staged["times"], old_times, "slot")
    added = {}
    for name, rows in (("places", new_places), ("times", new_times)):
        rows, watch = counted(rows, f"{name}-{load}", n=F.count(F.lit(1)))
        tables[name] = warehouse.appended_entry(tables.get(name), warehouse.write(name, rows, load))
        added[name] = watch.get["n"]

    # facts last
    places = warehouse.rows(tables["places"])
    facts = S.warehouse_types(S.key_lookup(staged["facts"], places, "place", "place_id").drop("place"))
    facts = facts.drop("batch_id").withColumn(DAY, day_of("hour_ts"))
    tables["fact"], (inserted, updated) = _merge_days(
        warehouse, tables, "fact", facts, ["place_id", "slot"], UPDATE_COLS, load_ts, batch_id, load)

    refused = 0
    if rejects is not None:
        rejects, watch = counted(rejects.withColumn(DAY, day_of(F.lit(load_ts).cast("timestamp_ntz"))), f"rejects-{load}", n=F.count(F.lit(1)))
        tables["rejects"] = warehouse.appended_entry(tables.get("rejects"), warehouse.write("rejects", rejects, load, DAY))
        refused = watch.get["n"]
    row = spark.createDataFrame([(batch_id, load_ts, inserted + updated, inserted, updated, refused, added["places"], added["times"])],
                                LOG_SCHEMA.replace("timestamp_ntz", "string"))
    row = row.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz")).coalesce(1)
    tables["load_log"] = warehouse.appended_entry(tables.get("load_log"), warehouse.write("load_log", row, load))
    return warehouse.commit(tables, based_on)


def upsert_table(warehouse: Warehouse, name: str, source: DataFrame, keys, update_cols, load_ts, batch_id, **kw) -> tuple[int, int]:
    """Merge rows with a ``day`` column into one table; gives how many were
    inserted and updated."""
    based_on, tables = warehouse.newest()
    tables[name], done = _merge_days(warehouse, tables, name, source, keys, update_cols, load_ts, batch_id, load_name(batch_id), **kw)
    warehouse.commit(tables, based_on)
    return done


def append_table(warehouse: Warehouse, name: str, rows: DataFrame, batch_id: str, batch_col: str = "batch_id") -> int:
    """Append a batch's rows with a ``day`` column; rows that the batch has in
    those days are replaced, so that appending it again changes nothing."""
    based_on, tables = warehouse.newest()
    days = distinct_values(rows, DAY)
    held = _target(warehouse, tables, name, days)
    if held is not None:
        rows = U.rollback_batch(held, batch_id, batch_col).unionByName(rows)
    entry = warehouse.write(name, rows, load_name(batch_id), DAY)
    tables[name] = warehouse.merged_entry(tables.get(name), entry, days)
    return warehouse.commit(tables, based_on)


def delete_batch(warehouse: Warehouse, name: str, batch_id: str, batch_col: str = "batch_id") -> int:
    """A new version without one batch's rows; only days that hold some are
    rewritten, and a day left empty is left out."""
    based_on, tables = warehouse.newest()
    entry = tables[name]
    days = distinct_values(warehouse.rows(entry).filter(F.col(batch_col) == batch_id), DAY)
    kept = U.rollback_batch(warehouse.rows(entry, days), batch_id, batch_col)
    tables[name] = warehouse.merged_entry(entry, warehouse.write(name, kept, load_name(f"without-{batch_id}"), DAY), days)
    return warehouse.commit(tables, based_on)


# ---- predictions (K12, K13) ------------------------------------------------------

PREDICTION_COLS = ("aqi_pred", "alert")


def local_now(zone: str = "Europe/Paris", now=None) -> F.Column:
    """The load's wall clock at a place; ``now`` (a UTC text) for a load
    that is run again."""
    utc = F.lit(now).cast("timestamp_ntz") if now else F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    return X.utc_to_local(utc, zone)


def store_predictions(warehouse: Warehouse, scored: DataFrame, batch_id: str, predicted_at) -> tuple[int, int]:
    """Scored rows (place, target_ts, aqi_pred, alert) are merged into
    the prediction table by place key and target hour, and those in alarm
    appended to the alert table; gives rows inserted and updated.  Places that
    the warehouse doesn't know have no key and are left out, as in an inner
    join of the original."""
    places = warehouse.read("places")
    rows = S.key_lookup(scored.select("place", "target_ts", *PREDICTION_COLS), places, "place", "place_id")
    rows = rows.withColumn(DAY, day_of("target_ts"))
    done = upsert_table(warehouse, "predictions", rows.drop("place"), ["place_id", "target_ts"], PREDICTION_COLS, predicted_at, batch_id,
                        inserted_col=None, modified_col="predicted_at")
    alarms = rows.filter(F.col("alert") == X.ALERT_LABEL).select("place_id", "place", "target_ts", "aqi_pred", DAY)
    append_table(warehouse, "alerts", alarms.withColumn("batch_id", F.lit(batch_id)), batch_id)
    return done
