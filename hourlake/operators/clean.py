"""Cleaning and quality operators.

All operators are ``DataFrame -> DataFrame`` and take column names as
parameters, so they run unchanged on real payloads, ``events`` or
``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions import columns as X

# ---- fixed values: the cleaned-zone column contract ----------------------
CLEANED_SCHEMA = T.StructType([
    T.StructField("place", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("slot", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.LongType()),
    T.StructField("pressure", T.LongType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("aqi", T.LongType()),
    T.StructField("pm25", T.DoubleType()),
    T.StructField("pm10", T.DoubleType()),
    T.StructField("no2", T.DoubleType()),
    T.StructField("o3", T.DoubleType()),
])


def ensure_columns(df: DataFrame, schema: T.StructType = CLEANED_SCHEMA,
                   keep_extra: bool = True) -> DataFrame:
    """Add every expected column that is absent as a typed NULL."""
    present = set(df.columns)
    cols = [F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [F.col(n) for n in df.columns if n not in {f.name for f in schema.fields}] if keep_extra else []
    return df.select(*cols, *extra)


def coerce_numeric(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    """Text, non-numbers and NaN -> NULL; numbers keep their value."""
    return df.withColumns({x: X.to_number(x, dtype) for x in cols})


def fill_default(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace NULL with a per-column default."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})


def add_source_status(df: DataFrame, weather=X.WEATHER_METRICS, air=X.AIR_METRICS,
                      weather_col="weather_status", air_col="air_status") -> DataFrame:
    """B12."""
    return df.withColumns({weather_col: X.source_status(weather), air_col: X.source_status(air)})


def flag_range(df: DataFrame, col: str = "temperature", out: str = "is_temp_valid",
               lo=X.TEMP_VALID_MIN, hi=X.TEMP_VALID_MAX) -> DataFrame:
    """B13."""
    return df.withColumn(out, X.range_flag(col, lo, hi))


def null_impossible(df: DataFrame, bounds: dict) -> DataFrame:
    """``bounds`` maps column -> (lo, hi); values outside become NULL."""
    return df.withColumns({k: X.null_outside(k, lo, hi) for k, (lo, hi) in bounds.items()})


def split_dead(df: DataFrame, metrics=X.ALL_METRICS):
    """(valid, dead) where dead rows have every metric NULL.

    One flag expression, two filters over the same plan; neither side is
    collected.
    """
    dead = X.all_null(metrics)
    return df.filter(~dead), df.filter(dead)


def split_missing_keys(df: DataFrame, keys=("place", "slot")):
    """(keyed, keyless)."""
    missing = None
    for k in keys:
        m = F.col(k).isNull()
        missing = m if missing is None else (missing | m)
    return df.filter(~missing), df.filter(missing)


def keep_last(df: DataFrame, keys, order_cols) -> DataFrame:
    """One row per key, the greatest by ``order_cols`` (descending,
    NULLs last).

    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a hot key is cut to one row per map task before it is
    exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc_nulls_last() for o in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, keys, order_cols) -> DataFrame:
    """C4: one row per key, the smallest by ``order_cols``."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_last() for o in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """Rows minus distinct keys, in one aggregation pass per side.

    Counted as sum(count - 1) over key groups: partial aggregation per map
    task, so a hot key never reaches one task whole.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.count(F.lit(1)).alias("distinct_keys"),
                       F.sum("_n").alias("rows"),
                       F.sum(F.col("_n") - 1).alias("duplicates"))


def drop_null_target(df: DataFrame, target: str):
    """(kept, dropped-count frame)."""
    kept = df.filter(F.col(target).isNotNull())
    dropped = df.agg(F.count(F.lit(1)).alias("rows_before"),
                     F.count(F.col(target)).alias("rows_after"))
    return kept, dropped.withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def apply_cleaning_rules(df: DataFrame, keys=("place", "slot"), order_cols=("ts", "event_id"),
                         metrics=X.ALL_METRICS):
    """C1-C3 with B8-B13: returns (valid, rejects).

    ensure columns -> coerce metrics -> default country -> statuses -> range
    flag -> dead rows rejected -> keyless rows rejected -> keep last per key.
    Rejects keep a ``reject_reason`` column.
    """
    df = ensure_columns(df)
    df = df.withColumns({f.name: X.to_number(f.name).cast(f.dataType)
                         for f in CLEANED_SCHEMA.fields if f.name in metrics})
    df = fill_default(df, {"country": X.DEFAULT_COUNTRY})
    df = add_source_status(df)
    df = flag_range(df)
    valid, dead = split_dead(df, metrics)
    valid, keyless = split_missing_keys(valid, keys)
    rejects = dead.withColumn("reject_reason", F.lit("dead_row")).unionByName(
        keyless.withColumn("reject_reason", F.lit("missing_key")))
    # without an order of their own, rows of a key are ordered by all they hold
    present_order = [o for o in order_cols if o in df.columns] or [c for c in valid.columns if c not in keys]
    return keep_last(valid, keys, present_order), rejects


# ---- contracts and gates (C6, C7, C21) ---------------------------------------

class ContractError(ValueError):
    pass


def missing_columns(df: DataFrame, required) -> list[str]:
    """Names of required columns absent from the frame (schema only, no job)."""
    present = set(df.columns)
    return [c_ for c_ in required if c_ not in present]


def require_columns(df: DataFrame, required) -> DataFrame:
    """Hard contract before a load: fail fast when a column is missing."""
    miss = missing_columns(df, required)
    if miss:
        raise ContractError(f"missing columns: {miss}")
    return df


def contract_rejects(df: DataFrame, required, run_label: str):
    """Soft contract: (frame or None, reject row frame or None).  A
    frame missing features is not scored; a reject row names what is
    missing."""
    miss = missing_columns(df, required)
    if not miss:
        return df, None
    spark = df.sparkSession
    rej = spark.createDataFrame([(run_label, "features missing", ",".join(miss))],
                                "run string, reason string, context string")
    return None, rej


def has_rows(df: DataFrame) -> bool:
    """Empty-input gate (stops at the first row found)."""
    return not df.isEmpty()
