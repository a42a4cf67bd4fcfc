"""Exact quantiles and order statistics without a column in one task
(SURVEY §2.5 E16, E21; §2.10 J1, J4, J5).

All columns and all groups are handled in one pass: rows become (group,
column, value), equal values are counted (partial counts per task), and the
counts are range partitioned by (group, column, value).  A running sum inside
each range plus the sums of the ranges before it gives every value its ranks;
the value at a rank is the one whose ranks hold it.  No task holds a column:
a hot group's values spread over ranges, and a value however frequent is one
row.  Results are rows, a group and column each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.session import cut_lineage


def joined(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL, as a group may be: the left side's
    columns and the right side's others."""
    other = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"_key_{k}"))
        on = equal if on is None else on & equal
    return left.join(other, on, how).drop(*[f"_key_{k}" for k in keys])


def value_counts(df: DataFrame, cols, by=()) -> DataFrame:
    """``*by, column, value, n``: how often each value (as a double; NULLs
    left out) occurs in each column and group.  NaN is a missing value."""
    by = list(by)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(*by, F.inline(pairs))
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def running_counts(counts: DataFrame, by=()) -> DataFrame:
    """Counts with ``below``, the number of smaller values in the column and
    group.  The range partitioned counts are checkpointed, so that sums of
    ranges and running sums see one layout, whatever is recomputed."""
    keys = [*by, "column"]
    ranged = cut_lineage(counts.repartitionByRange(*keys, "value").withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part", *keys).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    # a group's ranges: as many rows as it touches partitions
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part", *keys).agg(F.sum("n").alias("_n"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return joined(local, parts, ["_part", *keys]).select(*keys, "value", "n", (F.col("_local") + F.col("_before")).alias("below"))


def at_rank(rank) -> F.Column:
    """Aggregate over running counts: the value at a 0-based rank."""
    return F.max(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("n")), F.col("value")))


def _position(p: float, total) -> F.Column:
    """Where quantile p lies among ``total`` values, between two ranks."""
    return F.lit(float(p)) * (total - 1)


def with_totals(running: DataFrame, by=()) -> DataFrame:
    """Running counts with ``total``, the number of values of the group.  The
    totals have a row a group and column."""
    keys = [*by, "column"]
    return joined(running, running.groupBy(*keys).agg(F.sum("n").alias("total")), keys)


def quantile_columns(probabilities: dict) -> tuple[list, list]:
    """Aggregates over running counts with totals, and the interpolated
    quantiles made of them: ``{name: p}``, linear between ranks."""
    total = F.col("total")
    aggs, outs = [F.max("total").alias("_total")], []
    for name, p in probabilities.items():
        at = _position(p, total)
        aggs += [at_rank(F.floor(at)).alias(f"_{name}_low"), at_rank(F.ceil(at)).alias(f"_{name}_high")]
        low, high, place = F.col(f"_{name}_low"), F.col(f"_{name}_high"), _position(p, F.col("_total"))
        outs.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return aggs, outs


def quantiles(df: DataFrame, cols, probabilities: dict, by=()) -> DataFrame:
    """``*by, column, total`` and a column for each of ``{name: p}``; columns and
    groups without a value have no row."""
    keys = [*by, "column"]
    running = with_totals(running_counts(value_counts(df, cols, by), by), by)
    aggs, outs = quantile_columns(probabilities)
    return running.groupBy(*keys).agg(*aggs).select(*keys, F.col("_total").alias("total"), *outs)


def fences(running: DataFrame, by=(), factor: float = 1.5) -> DataFrame:
    """Per group and column of running counts: ``total, min, q1, median, q3,
    max``, the fences ``factor`` quartile ranges outside the quartiles, and the
    number of values beyond them."""
    keys = [*by, "column"]
    rows = cut_lineage(with_totals(running, by))
    aggs, outs = quantile_columns({"q1": 0.25, "median": 0.5, "q3": 0.75})
    stats = rows.groupBy(*keys).agg(*aggs, F.min("value").alias("min"), F.max("value").alias("max")).select(
        *keys, F.col("_total").alias("total"), "min", "max", *outs)
    iqr = F.col("q3") - F.col("q1")
    stats = stats.withColumns({"lower": F.col("q1") - factor * iqr, "upper": F.col("q3") + factor * iqr})
    beyond = joined(rows, stats.select(*keys, "lower", "upper"), keys)
    beyond = beyond.filter((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
    beyond = beyond.groupBy(*keys).agg(F.sum("n").alias("_beyond"))
    return joined(stats, beyond, keys, "left").withColumn("n_outliers", F.coalesce("_beyond", F.lit(0))).drop("_beyond")


def winsor_cuts(df: DataFrame, cols, limit: float) -> DataFrame:
    """``column, median, low, high``: the median of the values, and the values
    at ranks k and n - k - 1 (k = limit x n, cut off) once NULLs are filled
    with the median; n counts all rows.

    The filled column's order is that of its values with the fills put in at
    the median, so ranks below them are the values' own, ranks inside are the
    median, and ranks above are shifted by the number of fills."""
    rows = cut_lineage(with_totals(running_counts(value_counts(df, cols))))
    nulls = [(F.col(c).cast("double").isNull() | F.isnan(F.col(c).cast("double"))).cast("long") for c in cols]
    sizes = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.coalesce(F.sum(x), F.lit(0)).alias(f"_{i}") for i, x in enumerate(nulls)])
    fills = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("fills")) for i, c in enumerate(cols)])
    sizes = sizes.select("_rows", F.inline(fills))
    aggs, outs = quantile_columns({"median": 0.5})
    medians = rows.groupBy("column").agg(*aggs).select("column", *outs).join(sizes, "column")
    rows = rows.join(medians, "column")
    smaller = rows.groupBy("column").agg(F.sum(F.when(F.col("value") < F.col("median"), F.col("n")).otherwise(0)).alias("_smaller"))
    rows = rows.join(smaller, "column")
    k = F.floor(F.lit(limit) * F.col("_rows"))
    cuts = []
    for name, rank in (("low", k), ("high", F.col("_rows") - k - 1)):
        own = F.when(rank < F.col("_smaller"), rank).when(rank >= F.col("_smaller") + F.col("fills"), rank - F.col("fills"))
        cuts.append(F.coalesce(at_rank(own), F.max("median")).alias(name))
    return rows.groupBy("column").agg(F.max("median").alias("median"), *cuts)

