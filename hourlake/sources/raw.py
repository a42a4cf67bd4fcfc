"""Raw-zone sources and sinks.

Payloads are nested JSON documents, one per place-hour, landed whole under
``{source}/year=YYYY/month=MM/day=DD/hour=HH/{place}.json``.  The place is
taken from the file name, never from the payload.  Every reader uses an
explicit schema; partition values stay zero-padded strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: payload schemas -----------------------------------------
WEATHER_SCHEMA = T.StructType([
    T.StructField("coord", T.StructType([T.StructField("lat", T.DoubleType()),
                                         T.StructField("lon", T.DoubleType())])),
    T.StructField("sys", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("main", T.StructType([T.StructField("temp", T.DoubleType()),
                                        T.StructField("humidity", T.LongType()),
                                        T.StructField("pressure", T.LongType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("main", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("icon", T.StringType())]))),
    T.StructField("dt", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("cod", T.StringType()),
])
POLLUTANTS = ("pm25", "pm10", "no2", "o3")
AIR_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("aqi", T.StringType()),
        T.StructField("iaqi", T.MapType(T.StringType(), T.StructType([T.StructField("v", T.StringType())]))),
        T.StructField("time", T.StructType([T.StructField("s", T.StringType())])),
    ])),
])
FORECAST_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("wind_direction_10m", T.ArrayType(T.LongType())),
        T.StructField("cloud_cover", T.ArrayType(T.LongType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
    ])),
])
PARTITION_SCHEMA = [T.StructField(n, T.StringType()) for n in ("year", "month", "day", "hour")]
CONFIG_SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("country", T.StringType()),
                              T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())])
AIR_OK = "ok"
WEATHER_NOT_FOUND = "404"


def _in_hours(df: DataFrame, hours) -> DataFrame:
    """Rows of the given (year, month, day, hour) partitions; all without any."""
    if not hours:
        return df
    cond = F.lit(False)
    for y, mo, d, h in hours:
        cond = cond | ((F.col("year") == y) & (F.col("month") == mo) & (F.col("day") == d) & (F.col("hour") == h))
    return df.filter(cond)


def read_landed(spark: SparkSession, root: str, schema: T.StructType, hours=None) -> DataFrame:
    """A1 on what ``land_raw`` wrote: the payloads parsed with the explicit
    schema, beside the place and the partition columns; a payload that isn't
    JSON gives NULL fields."""
    stored = T.StructType([T.StructField("place", T.StringType()), T.StructField("payload", T.StringType()),
                           *PARTITION_SCHEMA])
    df = _in_hours(spark.read.schema(stored).parquet(root), hours)
    doc = F.from_json("payload", schema)
    return df.select(doc.alias("_doc"), *[f.name for f in PARTITION_SCHEMA], "place").select(
        "_doc.*", *[f.name for f in PARTITION_SCHEMA], "place")


def read_raw_json(spark: SparkSession, root: str, schema: T.StructType, hours=None) -> DataFrame:
    """A1: read landed documents with an explicit schema; partition columns
    are declared as strings so ``month=03`` stays ``03``; ``hours`` is a list
    of (year, month, day, hour) strings to prune to.  The place comes from
    the file name."""
    full = T.StructType(list(schema.fields) + PARTITION_SCHEMA)
    df = _in_hours(spark.read.schema(full).option("multiLine", True).json(root), hours)
    return df.withColumn("place", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1))


def accept_air(df: DataFrame) -> DataFrame:
    """A3: keep air documents whose envelope says ok."""
    return df.filter(F.col("status") == AIR_OK)


def accept_weather(df: DataFrame) -> DataFrame:
    """A3: drop not-found weather documents."""
    return df.filter(F.col("cod").isNull() | (F.col("cod") != WEATHER_NOT_FOUND))


def land_raw(docs: DataFrame, root: str, ts_col: str = "run_ts", payload_col: str = "payload") -> None:
    """A2: keep each payload whole as text, one partition folder per hour;
    re-landing an hour replaces only that hour (dynamic overwrite)."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    out = docs.select("place", payload_col, *[F.date_format(ts_col, f).alias(k) for k, f in parts.items()])
    (out.repartition("year", "month", "day", "hour").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).format("parquet").save(root))


def flatten_weather(df: DataFrame, doc_col: str | None = None) -> DataFrame:
    """B1: nested weather document -> flat columns; a missing path is NULL."""
    def g(path):
        parts = path.split(".")
        x = F.col(doc_col).getField(parts[0]) if doc_col else F.col(parts[0])
        for p in parts[1:]:
            x = x.getField(p)
        return x
    return df.select("place", "slot",
                     g("sys.country").alias("country"), g("coord.lat").alias("latitude"),
                     g("coord.lon").alias("longitude"), g("main.temp").alias("temperature"),
                     g("main.humidity").alias("humidity"), g("main.pressure").alias("pressure"),
                     g("wind.speed").alias("wind_speed"))


def flatten_air(df: DataFrame, doc_col: str | None = None) -> DataFrame:
    """B2: air document -> AQI and pollutant indices.  ``iaqi`` is read as
    a map so a pollutant key that is absent (or a new one) never breaks the
    read; values are text, converted with try_cast (bad text -> NULL)."""
    d = F.col(doc_col).getField("data") if doc_col else F.col("data")
    iaqi = d.getField("iaqi")
    return df.select("place", "slot", d.getField("aqi").try_cast("int").alias("aqi"),
                     *[iaqi.getItem(p).getField("v").try_cast("double").alias(p) for p in POLLUTANTS])


def weather_payloads(readings: DataFrame) -> DataFrame:
    """Nested weather documents for the stand-in readings, as JSON text with
    NULL fields omitted."""
    doc = F.struct(
        F.struct(F.col("temperature").alias("temp"), F.col("humidity").cast("long").alias("humidity"),
                 F.col("pressure").cast("long").alias("pressure")).alias("main"),
        F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
        F.col("place").alias("name"))
    return readings.select("place", "slot", F.to_json(doc).alias("payload"))


def weather_documents(readings: DataFrame) -> DataFrame:
    """The stand-in weather documents parsed back with the explicit schema."""
    return weather_payloads(readings).select("place", "slot", F.from_json("payload", WEATHER_SCHEMA).alias("doc"))


def air_payloads(readings: DataFrame) -> DataFrame:
    """Nested air documents for the stand-in readings, as JSON text: pollutants
    that are missing have no key in ``iaqi``."""
    iaqi = F.map_filter(
        F.create_map(*[x for p in POLLUTANTS for x in (F.lit(p), F.struct(F.col(p).cast("string").alias("v")))]),
        lambda k, v: v.getField("v").isNotNull())
    doc = F.struct(F.lit(AIR_OK).alias("status"),
                   F.struct(F.col("aqi").cast("string").alias("aqi"), iaqi.alias("iaqi")).alias("data"))
    return readings.select("place", "slot", F.to_json(doc).alias("payload"))


def air_documents(readings: DataFrame) -> DataFrame:
    """The stand-in air documents parsed back with the explicit schema."""
    return air_payloads(readings).select("place", "slot", F.from_json("payload", AIR_SCHEMA).alias("doc"))


def zip_forecast(df: DataFrame, doc_col: str = "doc", run_col: str | None = None) -> DataFrame:
    """Parallel hourly arrays -> one row per (place, time); times are
    naive local ``yyyy-MM-dd'T'HH:mm``; a repeated time keeps the newest run
    (``run_col`` of the document, where there is one), then the last array
    position."""
    run = F.col(run_col) if run_col else F.lit(0)
    h = F.col(doc_col).getField("hourly")
    z = df.select("place", run.alias("_run"), F.posexplode(F.arrays_zip(
        h.getField("time").alias("time"), h.getField("wind_direction_10m").alias("wind_direction"),
        h.getField("cloud_cover").alias("cloud_cover"),
        h.getField("precipitation").alias("precipitation"))).alias("pos", "r"))
    z = z.select("place", "_run", "pos", F.to_timestamp_ntz(F.col("r.time"), F.lit("yyyy-MM-dd'T'HH:mm")).alias("fc_ts"),
                 F.col("r.wind_direction").cast("int").alias("wind_direction"),
                 F.col("r.cloud_cover").cast("int").alias("cloud_cover"),
                 F.col("r.precipitation").alias("precipitation"))
    best = z.groupBy("place", "fc_ts").agg(F.max_by(F.struct("wind_direction", "cloud_cover", "precipitation"),
                                                    F.struct("_run", "pos")).alias("v"))
    return best.select("place", "fc_ts", "v.*")


def forecast_documents(rows: DataFrame, place: str = "place", ts: str = "fc_ts") -> DataFrame:
    """Stand-in forecast documents: the hourly rows of one place and day
    packed into parallel arrays (at most 24 entries per document), as JSON
    text parsed back with the explicit schema."""
    day = F.date_format(ts, "yyyy-MM-dd")
    packed = rows.groupBy(place, day.alias("_day")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), "wind_direction", "cloud_cover",
                                             "precipitation"))).alias("h"))
    hourly = F.struct(F.transform("h", lambda x: F.date_format(x["t"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                      F.transform("h", lambda x: x["wind_direction"]).alias("wind_direction_10m"),
                      F.transform("h", lambda x: x["cloud_cover"]).alias("cloud_cover"),
                      F.transform("h", lambda x: x["precipitation"]).alias("precipitation"))
    txt = packed.select(place, F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))
    return txt.select(place, F.from_json("payload", FORECAST_SCHEMA).alias("doc"))


def read_config(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Place configuration (array of objects or an object with a
    ``cities`` array).  With a schema (``CONFIG_SCHEMA``) no job has to infer
    one, and absent fields are NULL."""
    reader = spark.read.option("multiLine", True)
    if schema is None:
        raw = reader.json(path)
        return raw.select(F.inline("cities")) if "cities" in raw.columns else raw
    raw = reader.schema(T.StructType([*schema.fields, T.StructField("cities", T.ArrayType(schema))])).json(path)
    return raw.select(F.inline(F.coalesce("cities", F.array(F.struct(*[f.name for f in schema.fields])))))


def read_history_csv(spark: SparkSession, path: str, schema: T.StructType, ts_col: str,
                     ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """A10: CSV with header and an explicit schema, timestamp parsed."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn(ts_col, F.to_timestamp_ntz(F.col(ts_col).cast("string"), F.lit(ts_format)))


def read_archive_csvs(spark: SparkSession, path: str, columns, time_col: str = "time",
                      time_format: str = "yyyy-MM-dd'T'HH:mm") -> DataFrame:
    """Many per-place CSVs with a preamble, read in one pass: every
    line is read as text columns, lines whose first field is not a time are
    dropped (the preamble and the header), the place comes from the file
    name."""
    schema = T.StructType([T.StructField(c_, T.StringType()) for c_ in columns])
    df = spark.read.schema(schema).option("header", False).csv(path)
    t = F.try_to_timestamp(F.col(time_col), F.lit(time_format)).cast("timestamp_ntz")
    return (df.withColumn("_t", t).filter(F.col("_t").isNotNull())
            .withColumn(time_col, F.col("_t")).drop("_t")
            .withColumn("place", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)))


def write_csv(df: DataFrame, path: str) -> None:
    """A12."""
    df.write.mode("overwrite").option("header", True).csv(path)
