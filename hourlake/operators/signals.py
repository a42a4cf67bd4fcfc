"""Signals of failing sensors and sources: metrics missing or
stuck for hours on end, batches refused whole, sources that disagree, places
whose values drift.

Runs of hours are gaps and islands in two steps.  Within a place, metric and
day, neighbouring hours in the same state make a run; these windows hold 24
rows at most, however long the history, and a hot place spreads over its days.
Then runs that end with a day and go on with the next are put together: that
step sees runs, not hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.operators.features import hour_index

# ---- fixed values: the alerts' lengths in hours ----------------------------
MISSING_HOURS = 3
STUCK_HOURS = 5
# Bins of the drift comparison.
DRIFT_BINS = 20


def _metric_rows(df: DataFrame, metrics, place: str, ts: str) -> DataFrame:
    """``place, hour, metric, value``: hours as numbers, a row a metric."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(F.col(place).alias("place"), hour_index(ts).alias("hour"), F.inline(values))


def hour_runs(rows: DataFrame, keys, at_least: int) -> DataFrame:
    """``*keys, first_hour, last_hour, hours``: maximal runs of consecutive
    hours that agree in ``keys``, of ``at_least`` hours.  ``rows`` has each hour
    of a key once."""
    day = F.floor(F.col("hour") / 24)
    within = Window.partitionBy(*keys, "_day").orderBy("hour")
    # consecutive hours less their row number are one number
    runs = rows.withColumn("_day", day).withColumn("_island", F.col("hour") - F.row_number().over(within))
    runs = runs.groupBy(*keys, "_day", "_island").agg(F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))
    across = Window.partitionBy(*keys).orderBy("first_hour")
    breaks = (F.lag("last_hour").over(across) + 1 == F.col("first_hour"))
    runs = runs.withColumn("_new", F.when(breaks, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(across))
    runs = runs.groupBy(*keys, "_run").agg(F.min("first_hour").alias("first_hour"), F.max("last_hour").alias("last_hour"))
    runs = runs.withColumn("hours", F.col("last_hour") - F.col("first_hour") + 1)
    return runs.filter(F.col("hours") >= at_least).drop("_run")


def _with_times(runs: DataFrame, *columns) -> DataFrame:
    at = lambda c: (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col(c).cast("int")))
    return runs.select(*columns, at("first_hour").alias("first_ts"), at("last_hour").alias("last_ts"), "hours")


def missing_runs(df: DataFrame, metrics, hours: int = MISSING_HOURS, place: str = "place", ts: str = "hour_ts") -> DataFrame:
    """Metrics that are NULL for ``hours`` consecutive hours or more at a place.
    An hour without a row says nothing: it ends a run."""
    rows = _metric_rows(df, metrics, place, ts).filter(F.col("value").isNull())
    return _with_times(hour_runs(rows.drop("value"), ["place", "metric"], hours), "place", "metric")


def stuck_runs(df: DataFrame, metrics, hours: int = STUCK_HOURS, place: str = "place", ts: str = "hour_ts") -> DataFrame:
    """Metrics with one value for ``hours`` consecutive hours or more."""
    rows = _metric_rows(df, metrics, place, ts).filter(F.col("value").isNotNull())
    return _with_times(hour_runs(rows, ["place", "metric", "value"], hours), "place", "metric", "value")


def batch_rejection(merged: DataFrame, dead: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Valid and refused rows of each batch, and whether it was refused whole."""
    tagged = merged.select(batch, F.lit(0).alias("_d")).unionAll(dead.select(batch, F.lit(1).alias("_d")))
    counts = tagged.groupBy(batch).agg(F.sum(1 - F.col("_d")).alias("valid"), F.sum("_d").alias("rejected"))
    return counts.withColumn("all_rejected", F.col("valid") == 0)


def source_agreement(left: DataFrame, right: DataFrame, keys, metric: str, tolerance: float) -> DataFrame:
    """Two sources' values of one metric side by side: by the first key, pairs,
    the mean and the greatest absolute difference, and pairs that differ by
    more than ``tolerance``."""
    pairs = left.select(*keys, F.col(metric).cast("double").alias("_l")).join(
        right.select(*keys, F.col(metric).cast("double").alias("_r")), list(keys))
    off = F.abs(F.col("_l") - F.col("_r"))
    return pairs.filter(off.isNotNull()).groupBy(keys[0]).agg(
        F.count(F.lit(1)).alias("pairs"), F.round(F.avg(off), 6).alias("mean_difference"), F.max(off).alias("max_difference"),
        F.sum((off > tolerance).cast("long")).alias("disagreeing"))


def drift(df: DataFrame, metric: str, split, bins: int = DRIFT_BINS, place: str = "place", ts: str = "hour_ts") -> DataFrame:
    """How a place's values changed at ``split``: number and mean of the values
    before and from then on, their ratio, and the distance of the two
    distributions: half the sum of the differences of bin shares (0 the same,
    1 nothing in common).  All places share the bins, equal widths between the
    least and the greatest value of all; the greatest falls into the last.
    Places without values in both windows have no row."""
    x = F.col(metric).cast("double")
    rows = df.filter(x.isNotNull()).select(F.col(place).alias("place"), x.alias("x"), (F.col(ts) >= split).alias("late"))
    ends = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    place_of = F.when(hi > lo, F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(0)
    late, early = F.col("late").cast("long"), (~F.col("late")).cast("long")
    cells = rows.groupBy("place", place_of.cast("int").alias("bin")).agg(
        F.sum(early).alias("n0"), F.sum(late).alias("n1"),
        F.sum(F.when(~F.col("late"), F.col("x"))).alias("s0"), F.sum(F.when(F.col("late"), F.col("x"))).alias("s1"))
    # a place has as many cells as there are bins
    whole = Window.partitionBy("place")
    cells = cells.withColumns({"t0": F.sum("n0").over(whole), "t1": F.sum("n1").over(whole)}).filter("t0 > 0 AND t1 > 0")
    off = F.abs(F.col("n0") / F.col("t0") - F.col("n1") / F.col("t1"))
    out = cells.groupBy("place").agg(F.max("t0").alias("n_before"), F.max("t1").alias("n_after"), F.sum("s0").alias("s0"),
                                     F.sum("s1").alias("s1"), F.sum(off).alias("distance"))
    before, after = F.col("s0") / F.col("n_before"), F.col("s1") / F.col("n_after")
    return out.select("place", "n_before", "n_after", F.round(before, 6).alias("mean_before"), F.round(after, 6).alias("mean_after"),
                      F.round(F.when(before != 0, after / before), 6).alias("mean_ratio"), F.round(F.col("distance") / 2, 6).alias("distance"))
