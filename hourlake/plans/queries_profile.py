"""Query keys for profiling and statistics (SURVEY §2.5 E16-E24, E26;
§2.10 J1-J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import profile as P
from hourlake.plans.catalog import Gold, query
from hourlake.sources import testdata as TD

LINEITEM_METRICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("describe_stats")
def q_describe_stats(spark, sf_dir):
    """E16 on lineitem's four measures (prices at cent precision: the mean
    and sum are exact decimal aggregates)."""
    li = TD.table(spark, sf_dir, "lineitem")
    return P.describe(li, LINEITEM_METRICS, decimal_scale=2)


@query("null_rates")
def q_null_rates(spark, sf_dir):
    return P.null_rates(Gold(spark, sf_dir).measures, X.ALL_METRICS)


@query("null_rates_by_place")
def q_null_rates_by_place(spark, sf_dir):
    return P.null_rates_by(Gold(spark, sf_dir).measures, "place", ("temperature", "pm25", "pm10", "o3"))


@query("frequencies")
def q_frequencies(spark, sf_dir):
    m = Gold(spark, sf_dir).measures
    return P.frequencies(m, {"place": F.col("place"), "hour": F.hour("hour_ts"),
                             "is_weekend": X.weekend_flag("hour_ts")})


@query("histogram")
def q_histogram(spark, sf_dir):
    return P.histogram(Gold(spark, sf_dir).measures, ("aqi", "temperature"))


@query("box_summary")
def q_box_summary(spark, sf_dir):
    return P.box_summary(Gold(spark, sf_dir).measures, "place", "aqi")


def _mean_by(m, name, expr):
    return (m.groupBy(expr.alias(name))
            .agg(X.decimal_mean(F.col("aqi").cast("decimal(10,0)"), 4).alias("aqi_mean"),
                 F.count("aqi").alias("n")).orderBy(name))


@query("mean_by_hour")
def q_mean_by_hour(spark, sf_dir):
    return _mean_by(Gold(spark, sf_dir).measures, "hour", F.hour("hour_ts"))


@query("mean_by_month")
def q_mean_by_month(spark, sf_dir):
    return _mean_by(Gold(spark, sf_dir).measures, "month", F.month("hour_ts"))


@query("status_share")
def q_status_share(spark, sf_dir):
    m = Gold(spark, sf_dir).measures
    vals = (X.STATUS_OK, X.STATUS_FAILED)
    return P.shares_pivot(m, "place", ("weather_status", "air_status"), vals, prefix=("weather_pct_", "air_pct_"))


@query("sector_share")
def q_sector_share(spark, sf_dir):
    f = Gold(spark, sf_dir).forecast().withColumn("sector", X.wind_sector("wind_direction"))
    return P.shares_pivot(f, "place", "sector", X.WIND_SECTORS)


@query("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    return P.corr_matrix(Gold(spark, sf_dir).measures, X.ALL_METRICS)


@query("iqr_outliers")
def q_iqr_outliers(spark, sf_dir):
    return P.iqr_outliers(Gold(spark, sf_dir).measures, ("aqi", "pm25", "pm10"))


@query("winsorize")
def q_winsorize(spark, sf_dir):
    m = Gold(spark, sf_dir).measures
    return P.winsorize(m, ("aqi", "pm25", "pm10")).select("place", "slot", "aqi_w", "pm25_w", "pm10_w")


@query("bootstrap_ci")
def q_bootstrap_ci(spark, sf_dir):
    """J2 (rows-only): 95 % CI of the mean AQI, all rows and rows <= 100."""
    m = Gold(spark, sf_dir).measures.withColumn("_id", F.xxhash64("place", "slot"))
    a = P.bootstrap_mean_ci(m, "aqi", row_id="_id").select(F.lit("all").alias("subset"), "*")
    b = P.bootstrap_mean_ci(m.filter(F.col("aqi") <= X.ALERT_LIMIT), "aqi", row_id="_id").select(
        F.lit("aqi<=100").alias("subset"), "*")
    return a.unionByName(b)


@query("permutation_test")
def q_permutation_test(spark, sf_dir):
    """J3 (rows-only): mean AQI of weekend vs weekday hours."""
    m = Gold(spark, sf_dir).measures.withColumns({"_id": F.xxhash64("place", "slot"),
                                                  "_we": X.weekend_flag("hour_ts")})
    return P.permutation_test(m, "aqi", "_we", 1, 0, row_id="_id")
