"""Hourly zones: cleaned rows, rejects, features and model-input rejects, a
folder an hour (SURVEY §1.5, A4-A9).

``year=YYYY/month=MM/day=DD/hour=HH`` hold zero-padded strings.  Writing an hour
replaces it: a run names its hours, and one that it has no rows for is emptied,
so a re-run without rejects takes back the rejects of the run before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.sources.raw import PARTITION_SCHEMA

PARTS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
# ---- fixed values: names of the zones --------------------------------------
CLEANED, REJECTS, FEATURES, MODEL_REJECTS = "mesures", "rejects", "features-ml", "rejet-ml"


def hour_columns(ts) -> dict[str, F.Column]:
    """A4: the partition columns of a run time."""
    return {name: F.date_format(ts, pattern) for name, pattern in PARTS.items()}


def hour_of(slot) -> tuple[str, str, str, str]:
    """The partition values of a slot (YYYYMMDDHH)."""
    text = str(slot)
    return text[:4], text[4:6], text[6:8], text[8:10]


def _folder(hour) -> str:
    return "/".join(f"{name}={value}" for name, value in zip(PARTS, hour))


def write_hours(rows: DataFrame, root: str, ts: str = "hour_ts", hours=None, fmt: str = "parquet") -> None:
    """Write rows into their hours, each replaced.  ``hours``, (year,
    month, day, hour) strings, are emptied where they get no rows."""
    spark = rows.sparkSession
    out = rows.withColumns(hour_columns(ts))
    (out.repartition(*PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTS).format(fmt).save(root))
    if hours:
        written = {tuple(r) for r in out.select(*PARTS).distinct().collect()}  # hours of one run
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for hour in set(map(tuple, hours)) - written:
            fs.delete(path(f"{root}/{_folder(hour)}"), True)


def read_hours(spark: SparkSession, root: str, schema: T.StructType, hours=None, fmt: str = "parquet") -> DataFrame:
    """Rows of a zone, of the given hours only: their folders alone are
    listed and read.  Hours without a folder have no rows."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = T.StructType([*[f for f in schema.fields if f.name not in PARTS], *PARTITION_SCHEMA])
    folders = [root] if hours is None else [f"{root}/{_folder(h)}" for h in hours]
    folders = [f for f in folders if fs.exists(path(f))]
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).format(fmt).load(folders)


MODEL_REJECT_SCHEMA = T.StructType([T.StructField("place", T.StringType()), T.StructField("reason", T.StringType()),
                                    T.StructField("context", T.MapType(T.StringType(), T.StringType()))])


def write_model_rejects(rejects: DataFrame, root: str, ts: str = "hour_ts", hours=None) -> None:
    """One JSON document a place and reason, with what explains it."""
    write_hours(rejects.select("place", "reason", "context", ts), root, ts, hours, fmt="json")


def read_model_rejects(spark: SparkSession, root: str, hours=None) -> DataFrame:
    return read_hours(spark, root, MODEL_REJECT_SCHEMA, hours, fmt="json")
