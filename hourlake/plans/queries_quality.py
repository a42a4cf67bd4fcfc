"""Query keys for sources, projections, cleaning and quality gates
(SURVEY §2.1 A4, §2.2 B1-B27, §2.3 C1-C11, §2.4 D1, §2.8 H1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import clean as C
from hourlake.operators import features as FE
from hourlake.operators import reports as R
from hourlake.operators import star as S
from hourlake.plans import measures as M
from hourlake.plans.catalog import PLACE_VOCAB, QUERIES, Gold, query
from hourlake.sources import testdata as TD

@query("full_outer_merge")
def q_full_outer_merge(spark, sf_dir):
    """D1 after keep-last on both sources."""
    return Gold(spark, sf_dir).merged.select("place", "slot", "hour_ts", *X.ALL_METRICS)


@query("dead_rows")
def q_dead_rows(spark, sf_dir):
    _, dead = C.split_dead(Gold(spark, sf_dir).merged)
    return dead.select("place", "slot", "hour_ts")


@query("missing_keys")
def q_missing_keys(spark, sf_dir):
    _, keyless = C.split_missing_keys(Gold(spark, sf_dir).merged, ("place", "slot"))
    return keyless.select("place", "slot", "hour_ts")


@query("rejects_union")
def q_rejects_union(spark, sf_dir):
    """H1 via the cleaning rules: dead rows and keyless rows, with reason."""
    _, rejects = C.apply_cleaning_rules(Gold(spark, sf_dir).merged, order_cols=())
    return rejects.select("place", "slot", "reject_reason")


@query("dedup_last")
def q_dedup_last(spark, sf_dir):
    """C3 on raw weather readings: last reading by (time, id) per place-hour."""
    w = TD.weather_readings(TD.table(spark, sf_dir, "events"))
    return C.keep_last(w, ["place", "slot"], ["ts", "event_id"]).select(
        "place", "slot", "ts", "event_id", "temperature", "humidity", "pressure", "wind_speed")


@query("dedup_first")
def q_dedup_first(spark, sf_dir):
    """C4: first measure per place by slot (place staging keeps the first)."""
    m = Gold(spark, sf_dir).measures
    return C.keep_first(m, ["place"], ["slot"]).select("place", "slot", "temperature", "aqi")


@query("duplicate_count")
def q_duplicate_count(spark, sf_dir):
    """C5 on lineitem's (l_orderkey, l_linenumber), which is not unique."""
    return C.duplicate_count(TD.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_pk")
def q_check_pk(spark, sf_dir):
    """Key values of lineitem's (l_orderkey, l_linenumber) seen twice+."""
    return S.check_pk(TD.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_fk")
def q_check_fk(spark, sf_dir):
    """Orders whose customer is missing, lineitems whose order is missing."""
    orders = TD.table(spark, sf_dir, "orders")
    cust = TD.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    li = TD.table(spark, sf_dir, "lineitem")
    a = S.check_fk(orders, cust, "o_custkey").select(
        F.lit("orders.o_custkey").alias("fk"), F.col("o_orderkey").alias("child_key"),
        F.col("o_custkey").alias("missing_key"))
    b = S.check_fk(li, orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey").select(
        F.lit("lineitem.l_orderkey").alias("fk"), F.col("l_orderkey").alias("child_key"),
        F.col("l_orderkey").alias("missing_key"))
    return a.unionByName(b)


@query("check_range")
def q_check_range(spark, sf_dir):
    """C11: CHECK ranges on the fact (humidity) and the time dimension."""
    g = Gold(spark, sf_dir)
    f = S.check_range(g.fact.select("place_id", "slot", "humidity"), S.RANGE_CHECKS)
    t = S.check_range(g.times.select("slot", "month", "hour"), S.RANGE_CHECKS)
    return (f.select("slot", "failed_check")
            .unionByName(t.select("slot", "failed_check")))


@query("drop_null_target")
def q_drop_null_target(spark, sf_dir):
    _, counts = C.drop_null_target(Gold(spark, sf_dir).measures, "aqi")
    return counts


@query("source_status")
def q_source_status(spark, sf_dir):
    return C.add_source_status(Gold(spark, sf_dir).merged).select("place", "slot", "weather_status", "air_status")


@query("range_flag")
def q_range_flag(spark, sf_dir):
    return C.flag_range(Gold(spark, sf_dir).measures).select("place", "slot", "temperature", "is_temp_valid")


@query("null_impossible")
def q_null_impossible(spark, sf_dir):
    m = C.null_impossible(Gold(spark, sf_dir).measures, {"humidity": (0, 100), "aqi": (0, None)})
    return m.select("place", "slot", "humidity", "aqi")


@query("coerce_numeric")
def q_coerce_numeric(spark, sf_dir):
    t = TD.bad_text(TD.table(spark, sf_dir, "events"))
    return C.coerce_numeric(t.withColumn("value_num", F.col("raw_text")), ["value_num"]).select(
        "event_id", "raw_text", "value_num")


@query("fill_default")
def q_fill_default(spark, sf_dir):
    """The merged frame has no country: the column is added, then
    defaulted."""
    m = C.ensure_columns(Gold(spark, sf_dir).merged)
    return C.fill_default(m, {"country": X.DEFAULT_COUNTRY}).select("place", "slot", "country")


@query("ensure_columns")
def q_ensure_columns(spark, sf_dir):
    """Weather-only rows (air source down) padded to the cleaned
    contract."""
    w = TD.weather_readings(TD.table(spark, sf_dir, "events"))
    w = C.keep_last(w, ["place", "slot"], ["ts", "event_id"]).drop("ts", "event_id")
    return C.ensure_columns(w)


@query("hour_bucket")
def q_hour_bucket(spark, sf_dir):
    e = TD.table(spark, sf_dir, "events")
    return e.select("event_id", X.slot_key("ts").alias("slot"), X.hour_floor("ts").alias("hour_ts"))


@query("utc_to_local")
def q_utc_to_local(spark, sf_dir):
    e = TD.table(spark, sf_dir, "events")
    return e.select("event_id", "ts", X.utc_to_local("ts").alias("local_ts"))


@query("slot_to_ts")
def q_slot_to_ts(spark, sf_dir):
    return Gold(spark, sf_dir).times.select("slot", X.slot_to_ts("slot").alias("slot_ts"))


@query("time_dim")
def q_time_dim(spark, sf_dir):
    return Gold(spark, sf_dir).times


@query("partition_columns")
def q_partition_columns(spark, sf_dir):
    """A4: zero-padded hour partition values and the raw-zone path."""
    m = Gold(spark, sf_dir).measures
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    m = m.select("place", "slot", *[F.date_format("hour_ts", f).alias(k) for k, f in parts.items()])
    path = F.concat(F.lit("measures/year="), "year", F.lit("/month="), "month", F.lit("/day="), "day",
                    F.lit("/hour="), "hour", F.lit("/"), "place", F.lit(".json"))
    return m.withColumn("path", path)


@query("warehouse_types")
def q_warehouse_types(spark, sf_dir):
    """The typed fact, decimals shown as their text."""
    t = S.warehouse_types(Gold(spark, sf_dir).measures)
    return t.select("place", "slot", *[F.col(k).cast("string").alias(k) for k in S.FACT_TYPES])


@query("weekend_flag")
def q_weekend_flag(spark, sf_dir):
    return Gold(spark, sf_dir).times.select("slot", X.weekend_flag("hour_ts").alias("is_weekend"))


@query("cyclic_encode")
def q_cyclic_encode(spark, sf_dir):
    t = FE.time_features(Gold(spark, sf_dir).times, "hour_ts")
    return t.select("slot", *[F.round(c_, 9).alias(c_) for c_ in ("hour_sin", "hour_cos", "month_sin", "month_cos")])


@query("binarize")
def q_binarize(spark, sf_dir):
    f = Gold(spark, sf_dir).forecast()
    return f.select("place", "fc_ts", "precipitation", X.binarize("precipitation").alias("precipitation_bin"))


@query("sector_bins")
def q_sector_bins(spark, sf_dir):
    f = Gold(spark, sf_dir).forecast()
    return f.select("place", "fc_ts", "wind_direction", X.wind_sector("wind_direction").alias("sector"))


@query("one_hot")
def q_one_hot(spark, sf_dir):
    m = Gold(spark, sf_dir).measures.select("place", "slot")
    return FE.one_hot(m, "place", PLACE_VOCAB)


@query("one_hot_inverse")
def q_one_hot_inverse(spark, sf_dir):
    m = FE.one_hot(Gold(spark, sf_dir).measures.select("place", "slot"), "place", PLACE_VOCAB)
    return FE.one_hot_inverse(m, PLACE_VOCAB, "place_back").select("place", "slot", "place_back")


@query("alert_rule")
def q_alert_rule(spark, sf_dir):
    f = Gold(spark, sf_dir).fact
    return f.select("place_id", "slot", "aqi", X.alert_rule("aqi").alias("alert"))


@query("json_flatten")
def q_json_flatten(spark, sf_dir):
    """B1/B2: nested weather/air documents (built per place-hour from the
    readings, as the sources deliver them) flattened back to columns by
    path; a missing pollutant key reads as NULL."""
    from hourlake.sources import raw as RAW
    g = Gold(spark, sf_dir)
    w = C.keep_last(TD.weather_readings(g.events), ["place", "slot"], ["ts", "event_id"])
    a = C.keep_last(TD.air_readings(g.events), ["place", "slot"], ["ts", "event_id"])
    wdoc = RAW.weather_documents(w)
    adoc = RAW.air_documents(a)
    fw = RAW.flatten_weather(wdoc, "doc")
    fa = RAW.flatten_air(adoc, "doc")
    return M.merge.full_outer_merge(fw, fa, ("place", "slot"), ()).select(
        "place", "slot", "country", *X.ALL_METRICS)


@query("zip_arrays")
def q_zip_arrays(spark, sf_dir):
    """Forecast documents with parallel hourly arrays (one per place and
    day, as the source delivers them) zipped back to one row per hour."""
    from hourlake.sources import raw as RAW
    fc = Gold(spark, sf_dir).forecast()
    docs = RAW.forecast_documents(fc)
    return RAW.zip_forecast(docs)


# ---- load checks ---------------------------------------------------------

CONFIGURED_PLACES = PLACE_VOCAB + ("V11",)  # the configuration names a place that never delivers


@query("config_coverage")
def q_config_coverage(spark, sf_dir):
    """Configured places against what was delivered."""
    configured = spark.createDataFrame([(p,) for p in CONFIGURED_PLACES], "place string")
    return R.config_coverage(Gold(spark, sf_dir).measures, configured)


@query("join_loss")
def q_join_loss(spark, sf_dir):
    """Fact rows that the join to their predictions drops."""
    g = Gold(spark, sf_dir)
    return R.join_loss(g.fact, g.predictions().withColumnRenamed("target_ts", "hour_ts"), ("place_id", "hour_ts"))


@query("changed_rows")
def q_changed_rows(spark, sf_dir):
    """C17 on the fact after the MERGE of the staging batch."""
    return R.changed_rows(QUERIES["upsert_fact"](spark, sf_dir)).select(
        "place_id", "slot", "inserted_at", "modified_at", "batch_id")


@query("batch_rows")
def q_batch_rows(spark, sf_dir):
    """The rows of the latest batch."""
    f = Gold(spark, sf_dir).fact
    return R.batch_rows(f, R.last_batch(f).select("batch_id").scalar()).select("place_id", "slot", "batch_id")


@query("place_dim_stable")
def q_place_dim_stable(spark, sf_dir):
    """The stored dimension lacks the place that comes first by name; the
    grown one keeps every stored key."""
    m = Gold(spark, sf_dir).measures
    return S.place_dim(m, existing=S.place_dim(m.filter(F.col("place") != PLACE_VOCAB[0])))
