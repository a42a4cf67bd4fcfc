"""Plan checks: pushdown and pruning reach the scan, no cartesian or
nested-loop joins in the registered reports, AQE broadcasts the measured
dimensions."""

import __spark_entry__ as E
from tests.conftest import SF001


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_filter_and_columns_pushed_to_scan(spark):
    df = E.queries()["dedup_last"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_type" in plan
    # only the six event columns are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan


def test_lineitem_key_check_reads_two_columns(spark):
    plan = E.queries()["check_pk"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_no_cartesian_or_nested_loop(spark):
    qs = E.queries()
    for k in ("threshold_status", "exceedances_by_place", "kpi_counts", "missing_places", "histogram",
              "new_members", "availability_by_place"):
        plan = qs[k](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, k


def test_dimension_join_broadcast_after_aqe(spark):
    plan = _final_plan(E.queries()["availability_by_place"](spark, SF001))
    assert "isFinalPlan=true" in plan
    assert "BroadcastHashJoin" in plan
    assert "ReusedExchange" in plan


def test_scale_conf_sizes_partitions():
    from hourlake.session import scale_conf
    c = scale_conf(100 * (1 << 40))
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600
    assert int(scale_conf(1 << 30)["spark.sql.shuffle.partitions"]) == 4
