"""Star schema: dimensions, surrogate keys, reference seeds, typing and
integrity checks (SURVEY §1.6-1.11, A15, B7, B27, C9-C11, D6, D7, I2, I3, I8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions import columns as X

# ---- fixed values: reference seed rows -----------------------------------
# Thresholds: pollutant, period, limit, unit, level, description.
THRESHOLD_ROWS = [
    ("PM2.5", "Moyenne 24h", 15.00, "µg/m³", "Limite OMS",
     "Au-delà, risque accru de maladies cardiovasculaires et respiratoires."),
    ("PM2.5", "Moyenne 24h", 25.00, "µg/m³", "Danger", "Seuil critique, impact sanitaire immédiat."),
    ("PM10", "Moyenne 24h", 45.00, "µg/m³", "Limite OMS", "Irritation des voies respiratoires."),
    ("NO2", "Moyenne 24h", 25.00, "µg/m³", "Limite OMS", "Toxique. Principalement lié au trafic routier."),
    ("O3", "Moyenne 8h", 100.00, "µg/m³", "Limite OMS", "Ozone troposphérique, déclenche des crises d'asthme."),
]
COUNTRY_ROWS = [("FR", "France")]
# Level label of the legal limit row.
LIMIT_LEVEL = "Limite OMS"
# Insert defaults of the fact and prediction tables.
FACT_DEFAULTS = {"weather_status": "OK", "air_status": "OK", "batch_id": "MANUAL_LOAD"}
# Audit times set on insert, and columns that a prediction must have.
FACT_AUDIT, PREDICTION_AUDIT = ("inserted_at", "modified_at"), ("predicted_at",)
PREDICTION_REQUIRED = ("place_id", "target_ts", "aqi_pred", "alert", "batch_id")
# Warehouse column types of the fact table.
FACT_TYPES = {
    "temperature": "decimal(5,2)", "humidity": "int", "pressure": "int", "wind_speed": "decimal(5,2)",
    "aqi": "int", "pm25": "decimal(6,2)", "pm10": "decimal(6,2)", "no2": "decimal(6,2)", "o3": "decimal(6,2)",
}
# CHECK constraints.
RANGE_CHECKS = {"humidity": (0, 100), "month": (1, 12), "hour": (0, 23)}

THRESHOLD_SCHEMA = T.StructType([
    T.StructField("threshold_id", T.IntegerType(), False),
    T.StructField("pollutant", T.StringType(), False),
    T.StructField("period", T.StringType(), False),
    T.StructField("limit_value", T.DecimalType(6, 2), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("level", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
])


def thresholds(spark: SparkSession) -> DataFrame:
    """The five-row seed (ids in insertion order).  Broadcast-safe: its
    size is fixed."""
    from decimal import Decimal
    rows = [(i + 1, p, per, Decimal(f"{lim:.2f}"), u, lvl, d)
            for i, (p, per, lim, u, lvl, d) in enumerate(THRESHOLD_ROWS)]
    return spark.createDataFrame(rows, THRESHOLD_SCHEMA)


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_ROWS, "country string, country_name string")


def place_dim(measures: DataFrame, place_col: str = "place", existing: DataFrame | None = None) -> DataFrame:
    """Place dimension: distinct places with an identity-like key in name
    order.  With ``existing``, the stored dimension, its places keep their
    keys and only new places get further ones.  The ranking window runs over
    the distinct-place set only, whose size is the number of places, not the
    number of rows."""
    d = measures.select(F.col(place_col).alias("place")).distinct()
    if existing is not None:
        grown = new_members(d, existing, "place", "place_id")
        return existing.select("place_id", "place").unionByName(grown.select("place_id", "place"))
    return d.select(F.row_number().over(Window.orderBy("place")).cast("int").alias("place_id"), "place")


def time_dim(measures: DataFrame) -> DataFrame:
    """One row per slot with the slot time and its calendar parts."""
    t = measures.groupBy("slot").agg(F.min("hour_ts").alias("hour_ts"))
    return t.select("slot", "hour_ts",
                    F.year("hour_ts").alias("year"), F.month("hour_ts").alias("month"),
                    F.dayofmonth("hour_ts").alias("day"), F.hour("hour_ts").alias("hour"))


def fact(measures: DataFrame, places: DataFrame) -> DataFrame:
    """Fact rows keyed by (place_id, slot).  The place dimension is joined
    without a hint: AQE measures it at runtime and broadcasts it when it is
    under the adaptive threshold, else keeps the sort-merge join."""
    return measures.join(places, "place").drop("place")


def warehouse_types(df: DataFrame, types: dict = FACT_TYPES) -> DataFrame:
    """Cast to the warehouse column types.  Doubles go through
    ``round`` at the target scale first so the cast is exact half-up."""
    out = {}
    for k, t in types.items():
        if k not in df.columns:
            continue
        if t.startswith("decimal"):
            scale = int(t.split(",")[1].rstrip(")"))
            out[k] = F.round(F.col(k).cast("double"), scale).cast(t)
        else:
            out[k] = F.col(k).cast(t)
    return df.withColumns(out)


def insert_defaults(df: DataFrame, defaults: dict = FACT_DEFAULTS) -> DataFrame:
    """I8: column defaults applied before an insert."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items() if k in df.columns})


def audit_defaults(df: DataFrame, now, columns=FACT_AUDIT) -> DataFrame:
    """I8: audit times that a row doesn't bring are the time of the insert,
    local wall clock; absent columns are added."""
    own = {k: F.coalesce(F.col(k), now) if k in df.columns else now for k in columns}
    return df.withColumns({k: v.cast("timestamp_ntz") for k, v in own.items()})


def prediction_defaults(df: DataFrame, now) -> DataFrame:
    """I8 on the prediction table: the time of the prediction defaults to now;
    every other column must be there, and a NULL in one fails the row's task."""
    checked = df
    for name in PREDICTION_REQUIRED:
        message = F.lit(f"prediction without {name}")
        checked = checked.filter(F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.lit(True)))
    return audit_defaults(checked, now, PREDICTION_AUDIT)


def new_members(staged: DataFrame, existing: DataFrame, key: str, id_col: str | None = None,
                order_col: str | None = None) -> DataFrame:
    """Rows of ``staged`` whose key is absent from ``existing``
    (anti join).  With ``id_col``, new members get ``max(existing id) +
    row_number`` in ``order_col`` order, as an identity column would; the
    ranking runs over the new members only."""
    fresh = staged.join(existing.select(key), key, "left_anti")
    if id_col is None:
        return fresh
    base = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    rn = F.row_number().over(Window.orderBy(order_col or key))
    return fresh.withColumn(id_col, (base + rn).cast("int"))


def key_lookup(df: DataFrame, dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Natural -> surrogate key."""
    return df.join(dim.select(natural, surrogate), natural, "inner")


def check_pk(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once (empty when the key holds)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def check_fk(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent; as in SQL, a NULL key refers
    to nothing and breaks nothing."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def check_range(df: DataFrame, checks: dict) -> DataFrame:
    """C11: rows breaking any CHECK range, with the failing column named."""
    parts = []
    for col_name, (lo, hi) in checks.items():
        if col_name in df.columns:
            bad = df.filter(F.col(col_name).isNotNull() & ~F.col(col_name).between(lo, hi))
            parts.append(bad.withColumn("failed_check", F.lit(col_name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
