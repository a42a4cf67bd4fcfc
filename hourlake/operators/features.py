"""Feature operators (SURVEY §2.2 B15-B19, B30; §2.6 F1-F3, F6; §2.4 D8,
D13; §2.11 K1, K2).

Per-place windows run after keep-last, so a place holds at most one row per
hour: a window partition is bounded by the hours covered (8,760 a year), not
by the volume of raw readings, even when one place is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.session import cut_lineage

# ---- fixed values: the 25-feature contract (order matters) ----------------
BASE_FEATURES = ("temperature", "humidity", "pressure", "wind_speed", "hour_sin", "hour_cos",
                 "month_sin", "month_cos", "is_weekend", "wind_dir_sin", "wind_dir_cos",
                 "cloud_cover", "precipitation_bin", "aqi_mean_6h")
ONE_HOT_PREFIX = "place_"
# Window length of the AQI mean, hours.
MEAN_HOURS = 6
# Number of future forecast hours scored per run.
FUTURE_HOURS = 6


def feature_names(vocabulary) -> list[str]:
    return list(BASE_FEATURES) + [ONE_HOT_PREFIX + v for v in vocabulary]


def hour_index(ts) -> F.Column:
    """Hours since 1970-01-01 of a zone-less timestamp (integer, no zone)."""
    t = X.c(ts)
    return (F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(t))


def prev_hours_mean(df: DataFrame, value: str, out: str, partition=("place",), ts: str = "hour_ts",
                    hours: int = MEAN_HOURS) -> DataFrame:
    """mean of ``value`` over the ``hours`` previous hours, current hour
    excluded; NULLs skipped; NULL when there is none."""
    w = (Window.partitionBy(*partition).orderBy(hour_index(ts))
         .rangeBetween(-hours, -1))
    return df.withColumn(out, F.avg(value).over(w))


def rolling_mean(df: DataFrame, value: str, out: str, partition=("place",), ts: str = "hour_ts",
                 hours: int = MEAN_HOURS) -> DataFrame:
    """trailing mean over (t - hours, t], current row included, at least
    one non-NULL value (else NULL)."""
    w = (Window.partitionBy(*partition).orderBy(hour_index(ts))
         .rangeBetween(-(hours - 1), 0))
    return df.withColumn(out, F.avg(value).over(w))


def future_slots(runs: DataFrame, forecast: DataFrame, n: int = FUTURE_HOURS, place: str = "place",
                 run_ts: str = "hour_ts", fc_ts: str = "fc_ts") -> DataFrame:
    """For every run row, the first ``n`` forecast rows of the same
    place strictly after the run time (fewer when the forecast ends).

    Exact and shuffle-friendly: forecast rows get an ordinal per place; one
    window over runs and forecast rows together counts the forecast rows at
    or before each run; the run then equi-joins on (place, ordinal) for the
    ``n`` next ordinals.  No range join and no per-place loop.
    """
    fw = Window.partitionBy(place).orderBy(fc_ts)
    fc = forecast.withColumn("_ord", F.row_number().over(fw))
    stream = (runs.withColumn("_t", F.col(run_ts)).withColumn("_is_run", F.lit(1))
              .unionByName(forecast.select(place, F.col(fc_ts).alias("_t")).withColumn("_is_run", F.lit(0)),
                           allowMissingColumns=True))
    sw = (Window.partitionBy(place).orderBy("_t", "_is_run")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = (stream.withColumn("_seen", F.sum(1 - F.col("_is_run")).over(sw))
               .filter("_is_run = 1").drop("_is_run", "_t"))
    expanded = counted.withColumn("_ord", F.explode(F.sequence(F.col("_seen") + 1, F.col("_seen") + n)))
    return expanded.join(fc, [place, "_ord"], "inner").drop("_seen", "_ord")


def one_hot(df: DataFrame, col: str, vocabulary, prefix: str = ONE_HOT_PREFIX) -> DataFrame:
    """One 0/1 column per vocabulary value (a fixed list, so no pass
    over the data is needed to find the columns)."""
    return df.withColumns({prefix + v: (F.col(col) == v).cast("int") for v in vocabulary})


def one_hot_inverse(df: DataFrame, vocabulary, out: str, prefix: str = ONE_HOT_PREFIX) -> DataFrame:
    """Back to the value of the first column set to 1."""
    return df.withColumn(out, F.coalesce(*[F.when(F.col(prefix + v) == 1, F.lit(v)) for v in vocabulary]))


def time_features(df: DataFrame, ts: str, out_prefix: str = "") -> DataFrame:
    """Hour and month cyclic encodings, weekend flag."""
    hs, hc = X.cyclic(F.hour(ts), 24)
    ms, mc = X.cyclic(F.month(ts), 12)
    return df.withColumns({f"{out_prefix}hour_sin": hs, f"{out_prefix}hour_cos": hc,
                           f"{out_prefix}month_sin": ms, f"{out_prefix}month_cos": mc,
                           f"{out_prefix}is_weekend": X.weekend_flag(ts)})


def forecast_features(df: DataFrame, wind: str = "wind_direction", cloud: str = "cloud_cover",
                      precip: str = "precipitation") -> DataFrame:
    """Wind direction encoding, cloud cover, precipitation flag."""
    ws, wc = X.cyclic(wind, 360)
    return df.withColumns({"wind_dir_sin": ws, "wind_dir_cos": wc,
                           "cloud_cover": F.col(cloud).cast("double"),
                           "precipitation_bin": X.binarize(precip)})


def history_join(history: DataFrame, archive: DataFrame, keys=("place", "hour_ts")) -> DataFrame:
    """Measures history joined to the forecast archive on (place, hour).
    Shuffled on both keys, so a hot place spreads over all its hours."""
    return history.join(archive, list(keys), "inner")


def serving_features(current: DataFrame, forecast: DataFrame, vocabulary, n: int = FUTURE_HOURS) -> DataFrame:
    """K1: for every run row (place, hour) of the cleaned measures, the 25
    features of each of the next ``n`` forecast hours.

    ``current``: place, slot, hour_ts, weather metrics, aqi (one row per
    place-hour).  ``forecast``: place, fc_ts, wind_direction, cloud_cover,
    precipitation.  The AQI mean is F2 (previous hours, current excluded),
    computed once per run row before the 1:n expansion.
    """
    cur = prev_hours_mean(current, "aqi", "aqi_mean_6h")
    cur = cur.select("place", F.col("slot").alias("run_slot"), F.col("hour_ts").alias("run_ts"),
                     *[F.col(m).cast("double").alias(m) for m in X.WEATHER_METRICS], "aqi_mean_6h")
    fut = future_slots(cur, forecast, n, run_ts="run_ts")
    fut = fut.withColumnRenamed("fc_ts", "target_ts").withColumn("slot", X.slot_key("target_ts"))
    fut = time_features(fut, "target_ts")
    fut = forecast_features(fut)
    fut = one_hot(fut, "place", vocabulary)
    return fut.select("place", "run_slot", "target_ts", "slot", *feature_names(vocabulary))


def training_features(measures: DataFrame, archive: DataFrame, vocabulary, include_current: bool = False) -> DataFrame:
    """K2: history joined to the archive, encoded, target = AQI.

    ``include_current=False`` uses F2 (the serving definition, no target
    leakage); ``True`` uses F1 as the original training notebook did.
    Rows without a target are dropped (C8).
    """
    j = history_join(measures, archive.withColumnRenamed("fc_ts", "hour_ts"))
    j = (rolling_mean(j, "aqi", "aqi_mean_6h") if include_current
         else prev_hours_mean(j, "aqi", "aqi_mean_6h"))
    j = j.filter(F.col("aqi").isNotNull())
    j = time_features(j, "hour_ts")
    j = forecast_features(j)
    j = one_hot(j, "place", vocabulary)
    j = j.withColumns({m: F.col(m).cast("double") for m in X.WEATHER_METRICS})
    return j.select("place", "slot", "hour_ts", *feature_names(vocabulary),
                    F.col("aqi").cast("double").alias("target"))


def global_row_index(df: DataFrame, order_cols, out: str = "row_idx", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order_cols``
    without a single-partition window.

    Range partitioning puts ordered key ranges into ordered partitions; a
    row number within each partition plus the count of all earlier
    partitions (a table with one row per partition, broadcast) gives the
    global position.  ``order_cols`` must be unique.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds are sampled from the input; when the input comes out of a
    # shuffle its row order (and so the sample) can differ between two
    # evaluations.  The partitioned rows are checkpointed once so that the
    # partition sizes and the per-partition numbering see the same layout.
    ranged = cut_lineage(df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()))
    ranged = ranged.withColumn("_local", F.row_number().over(
        Window.partitionBy("_pid").orderBy(*order_cols)) - 1)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_offset") + F.col("_local")).drop("_pid", "_local", "_offset"))


def temporal_folds(df: DataFrame, order_cols=("hour_ts", "place"), n_splits: int = 3) -> DataFrame:
    """expanding-window folds.  With n rows and t = n div (n_splits+1),
    fold i (1-based) trains on rows [0, n - (n_splits-i+1) t) and tests on
    the next t rows.  Returns one row per (row, fold) membership with
    ``fold`` and ``role`` ('train'/'test')."""
    idx = global_row_index(df, list(order_cols))
    n = idx.agg(F.coalesce(F.max("row_idx") + 1, F.lit(0))).scalar()
    t = F.floor(n / (n_splits + 1))
    x = idx.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    train_end = n - (n_splits - F.col("fold") + 1) * t
    role = (F.when(F.col("row_idx") < train_end, F.lit("train"))
            .when(F.col("row_idx") < train_end + t, F.lit("test")))
    return x.withColumn("role", role).filter(F.col("role").isNotNull())


# ---- rejects of the feature build (K14) ----------------------------------------

# ---- fixed values: why a place of a run gets no features
NO_CLEANED_ROW, NO_FORECAST, NO_FUTURE_SLOT = "cleaned row missing", "forecast unavailable", "no future slot in the forecast"


def feature_rejects(runs: DataFrame, places, measures: DataFrame, forecasts: DataFrame) -> DataFrame:
    """The places of each run (``slot, run_ts``) that get no features, with
    the first of three reasons that holds and what explains it: no cleaned row
    of that hour, no forecast fetched by the run, or none of its times later
    than the run.

    ``forecasts`` has a row for each time of a forecast: ``slot`` of the run that
    fetched it, ``place, fc_ts``.  Runs expand to the configured ``places`` by a
    generator; forecasts are summed up to a row a run and place before they
    are joined."""
    wanted = runs.select("slot", "run_ts", F.explode(F.array(*[F.lit(p) for p in places])).alias("place"))
    held = measures.select("place", "slot", F.lit(True).alias("_row"))
    last = forecasts.groupBy("place", "slot").agg(F.max("fc_ts").alias("_last"), F.count(F.lit(1)).alias("_times"))
    checked = wanted.join(held, ["place", "slot"], "left").join(last, ["place", "slot"], "left")
    reason = (F.when(F.col("_row").isNull(), F.lit(NO_CLEANED_ROW)).when(F.col("_times").isNull(), F.lit(NO_FORECAST))
              .when(~(F.col("_last") > F.col("run_ts")), F.lit(NO_FUTURE_SLOT)))
    context = F.when(reason == NO_FUTURE_SLOT, F.create_map(
        F.lit("run_ts"), F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss"), F.lit("last_forecast_ts"), F.date_format("_last", "yyyy-MM-dd HH:mm:ss"),
        F.lit("forecast_times"), F.col("_times").cast("string")))
    empty = F.create_map().cast("map<string,string>")
    return checked.withColumn("reason", reason).filter("reason IS NOT NULL").select(
        "slot", "run_ts", "place", "reason", F.coalesce(context, empty).alias("context"))


def run_verdicts(runs: DataFrame, n_places: int, rejects: DataFrame) -> DataFrame:
    """Per run, rejected places and the verdict on its features: complete,
    partial, or none."""
    counts = rejects.groupBy("slot").agg(F.count(F.lit(1)).alias("_n"))
    out = runs.select("slot").join(counts, "slot", "left").withColumn("n_rejected", F.coalesce("_n", F.lit(0)))
    verdict = (F.when(F.col("n_rejected") == 0, F.lit("complete")).when(F.col("n_rejected") >= n_places, F.lit("none"))
               .otherwise(F.lit("partial")))
    return out.select("slot", "n_rejected", verdict.alias("verdict"))
