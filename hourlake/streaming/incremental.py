"""Incremental processing with Structured Streaming.

The reference runs hourly batches; here the same operators run as
micro-batches over newly landed files:

* L2 ``hourly_window``: event-time tumbling one-hour counts and means per
  place with a watermark, plus de-duplication of repeated readings.  The
  batch twin (``hourly_window_batch``) gives the same rows on a static
  frame.  ``last_readings`` keeps the last reading of every (place, hour) as
  streaming state.  Both write epochs to files (``run_to_epochs``).
* L1 ``ingest_touched``: ``availableNow`` file streams; every micro-batch
  rebuilds the hours it touched from both sources' landed payloads and upserts
  them (late files re-write their hour).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions import columns as X
from hourlake.operators import clean, merge
from hourlake.sources import raw, zones


def _hour_agg(df: DataFrame, ts: str, key: str, value: str) -> DataFrame:
    """Counts and means by hour, in the column's own type: an exact decimal
    mean of a decimal column, a rounded double mean of any other."""
    w = F.window(ts, "1 hour")
    exact = dict(df.dtypes)[value].startswith("decimal")
    mean = X.decimal_mean(F.col(value), 4) if exact else F.round(F.avg(value), 4)
    return (df.groupBy(w.alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"), mean.alias("value_mean"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), key, "n", "value_mean"))


def hourly_window_batch(df: DataFrame, ts: str = "ts", key: str = "place", value: str = "value") -> DataFrame:
    """L2 batch twin: one-hour tumbling windows by event time."""
    return _hour_agg(df, ts, key, value)


def hourly_window(stream: DataFrame, ts: str = "ts", key: str = "place", value: str = "value",
                  watermark: str = "2 hours", dedup_keys=None) -> DataFrame:
    """L2: the same aggregation on a stream.  The watermark bounds the state
    kept per open window; with ``dedup_keys`` repeated readings are dropped
    inside the watermark first."""
    if dict(stream.dtypes).get(ts) == "timestamp_ntz":
        # Watermarks need a zoned event time; the session zone (UTC) maps the
        # wall clock one to one, and the window start is turned back.
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    s = stream.withWatermark(ts, watermark)
    if dedup_keys:
        s = s.dropDuplicatesWithinWatermark(list(dedup_keys))
    return _hour_agg(s, ts, key, value)


def last_readings(stream: DataFrame, keys=("place",), order=("ts", "event_id"), ts: str = "ts",
                  watermark: str = "2 hours") -> DataFrame:
    """L2 keep-last as streaming state: of each key and hour the reading that
    is greatest by ``order``.  The state holds a row per key and open hour; the
    watermark closes hours, and readings of closed hours are dropped."""
    if dict(stream.dtypes).get(ts) == "timestamp_ntz":
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    best = F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), F.struct(*order)).alias("_last")
    s = stream.withWatermark(ts, watermark).groupBy(F.window(ts, "1 hour").alias("_w"), *keys).agg(best)
    start = F.col("_w.start").cast("timestamp_ntz").alias("window_start")
    return s.select(start, *keys, *[F.col("_last")[c].alias(c) for c in stream.columns if c not in keys])


def hourly_of(rows: DataFrame, value: str = "value") -> DataFrame:
    """Places that reported in an hour, and the exact mean of their values."""
    return rows.groupBy("window_start").agg(F.count(F.lit(1)).alias("n_places"), F.count(value).alias("n_values"),
                                            X.decimal_mean(F.col(value), 4).alias("value_mean"))


EPOCH = "epoch"


def run_to_epochs(df: DataFrame, folder: str, checkpoint: str, mode: str = "update") -> None:
    """Drive a streaming frame over everything available now.  Each epoch's
    rows go to a folder of its own, which a re-run of the epoch overwrites, so
    rows are there once whatever fails; nothing passes through the driver."""

    def each(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{EPOCH}={epoch:012d}")

    q = (df.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_epochs(spark: SparkSession, folder: str, schema: T.StructType, keys=None) -> DataFrame:
    """What the epochs say in the end: the newest row of every key (update
    mode), or without keys the newest epoch's rows (complete mode)."""
    full = T.StructType([*schema.fields, T.StructField(EPOCH, T.StringType())])
    rows = spark.read.schema(full).parquet(folder)
    if keys is None:
        return rows.filter(F.col(EPOCH) == rows.agg(F.max(EPOCH)).scalar()).drop(EPOCH)
    return clean.keep_last(rows, list(keys), (EPOCH,)).drop(EPOCH)


def touched_stream(spark: SparkSession, roots, max_files_per_trigger: int | None = None) -> DataFrame:
    """The hours of newly landed payloads, of any of the sources."""
    schema = T.StructType([T.StructField("place", T.StringType()), T.StructField("payload", T.StringType()), *raw.PARTITION_SCHEMA])
    out = None
    for root in roots:
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        hours = reader.parquet(root).select(*zones.PARTS)
        out = hours if out is None else out.unionByName(hours)
    return out


def read_hour_payloads(spark: SparkSession, root: str, schema: T.StructType, hours) -> DataFrame:
    """The landed documents of exactly these hours, with their slot."""
    stored = T.StructType([T.StructField("place", T.StringType()), T.StructField("payload", T.StringType())])
    rows = zones.read_hours(spark, root, stored, hours)
    slot = F.concat(*zones.PARTS).cast("long")
    return rows.select("place", slot.alias("slot"), F.from_json("payload", schema).alias("doc"))


def rebuild_hours(spark: SparkSession, weather_root: str, air_root: str, hours):
    """The cleaned rows and the rejects of some hours, from all that either
    source has landed for them."""
    w = read_hour_payloads(spark, weather_root, raw.WEATHER_SCHEMA, hours)
    w = w.filter(F.col("doc.cod").isNull() | (F.col("doc.cod") != raw.WEATHER_NOT_FOUND))
    a = read_hour_payloads(spark, air_root, raw.AIR_SCHEMA, hours).filter(F.col("doc.status") == raw.AIR_OK)
    merged = merge.full_outer_merge(raw.flatten_weather(w, "doc"), raw.flatten_air(a, "doc"), ("place", "slot"), ())
    return clean.apply_cleaning_rules(merged.withColumn("hour_ts", X.slot_to_ts("slot")), order_cols=("slot",))


def ingest_touched(spark: SparkSession, weather_root: str, air_root: str, checkpoint: str, sink,
                     max_files_per_trigger: int | None = None) -> None:
    """L1: ingest newly landed payloads by the hours they touch.

    A micro-batch writes its touched hours as a table, then both sources'
    landed payloads of exactly those hours are read again and rebuilt, and
    ``sink(cleaned, rejects, epoch)`` upserts them.  A late payload of one
    source so meets what the other landed long ago.  The checkpoint makes runs
    restartable; an epoch that runs again rebuilds the same hours.

    The hours of one micro-batch come to the driver, as folders to read:
    at most as many as it has files (``max_files_per_trigger`` bounds both)."""

    def each(batch: DataFrame, epoch: int) -> None:
        folder = f"{checkpoint}/touched/{EPOCH}={epoch:012d}"
        batch.distinct().write.mode("overwrite").parquet(folder)
        hours = [tuple(r) for r in spark.read.schema(T.StructType(raw.PARTITION_SCHEMA)).parquet(folder).collect()]
        if hours:
            cleaned, rejects = rebuild_hours(spark, weather_root, air_root, sorted(hours))
            sink(cleaned, rejects, epoch)

    stream = touched_stream(spark, (weather_root, air_root), max_files_per_trigger)
    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def incremental_load(spark: SparkSession, source_dir: str, schema: T.StructType, transform, sink,
                     checkpoint: str, max_files_per_trigger: int | None = None):
    """Process newly landed tabular files as micro-batches, each by itself;
    ``ingest_touched`` is for sources that must be rebuilt together.

    ``transform(batch_df) -> DataFrame`` builds the cleaned rows of the
    batch; ``sink(cleaned_df, epoch_id)`` upserts them (e.g. with
    ``upsert_partitioned`` on the touched days).  The checkpoint makes the
    run restartable: files already committed are not read again, and a
    batch re-run after a failure upserts the same rows again (idempotent).
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        cleaned = transform(batch_df)
        sink(cleaned, epoch_id)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
