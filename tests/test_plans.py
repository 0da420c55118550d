"""Physical-plan properties the operators are designed for (read off explain())."""

import contextlib
import io

from pyspark.sql import functions as F

from tierwell import specs
from tierwell.operators import gate, history
from tierwell.plans import facts, reports
from tierwell.sources.store import scratch_dir

from conftest import SF_TINY


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _stored(spark, df, name):
    path = f"{scratch_dir(spark, name)}/t"
    df.write.parquet(path)
    return spark.read.parquet(path), path


def test_request_fact_lookups_are_broadcast(wh):
    src = facts.request_fact_source(wh.ods_request, wh.dims)
    p = plan_of(src)
    assert p.count("BroadcastHashJoin") >= len(facts.REQUEST_LOOKUPS)
    assert "SortMergeJoin" not in p
    # the fact side is never shuffled for the lookups
    assert "Exchange hashpartitioning" not in p.split("BroadcastHashJoin")[0]


def test_daily_metrics_scan_fact_once_with_pushed_range(spark, wh):
    fact, path = _stored(spark, wh.fct_request, "fact")
    m = reports.daily_metrics(fact, wh.dims["spr_client"], wh.dims["spr_act"], "1995-01-01",
                              "2001-08-15")
    p = plan_of(m)
    assert p.count(path.split("/")[-2]) == 1          # one scan of the stored fact
    scan = p[p.index("Scan parquet"):]
    assert "GreaterThanOrEqual(added_dt" in scan and "LessThan(added_dt" in scan
    read_schema = scan[scan.index("ReadSchema"):].split("\n")[0]
    assert "reporting_amount" not in read_schema      # column pruning


def test_pivot_does_not_scan_the_fact_again(spark, wh):
    # the executed plan: metrics are stored, both sides of the totals join read them
    pivot = wh.pivot
    pivot.collect()
    executed = pivot._jdf.queryExecution().executedPlan().toString()
    assert "request_number" not in executed and "added_dt" not in executed


def test_history_moves_wide_rows_once(wh):
    stamped = history.stamp(gate.valid_rows(wh.stg_case, specs.CASE.required), specs.CASE,
                            "2002-01-01 00:00:00")
    df = history.merge_history(history.empty_ods(wh.spark, specs.CASE), stamped, specs.CASE)
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString()
    final = executed.split("== Initial Plan ==")[0]
    # an exchange that carries the versions is the one over the version hashes, reused by the others
    wide = [x for x in final.split("\n") if "Exchange hashpartitioning(_h1" in x and "Reused" not in x]
    assert "ReusedExchange" in final and wide


def test_gate_pushes_not_null_filters_to_scan(spark, wh):
    stg, _ = _stored(spark, wh.stg_case, "stg")
    valid = gate.valid_rows(stg, specs.CASE.required).select("global_case_number")
    p = plan_of(valid)
    assert "IsNotNull(case_date_added)" in p and "IsNotNull(responsible_agent)" in p


def test_history_aggregates_partially_before_shuffle(wh):
    stamped = history.stamp(gate.valid_rows(wh.stg_case, specs.CASE.required), specs.CASE,
                            "2002-01-01 00:00:00")
    p = plan_of(history.merge_history(history.empty_ods(wh.spark, specs.CASE), stamped,
                                      specs.CASE))
    assert "partial_max" in p              # map-side combine for dedupe and the flag
    assert "Window" not in p               # no whole-key window task


def test_hot_key_history_is_exact(spark):
    # one key holds a third of all rows, with many duplicated versions
    n = 30000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"),
                                                                      F.col("id").cast("string")))
        .alias("global_case_number"),
        (F.col("id") % 7).cast("string").alias("case_status"),
        F.to_timestamp_ntz(F.lit("2001-01-01 00:00:00")).alias("ts"))
    spec = specs.EntitySpec(name="hot", schema=rows.schema, required=("global_case_number",),
                            dedupe=("global_case_number", "case_status", "ts"),
                            key="global_case_number", change_ts="ts")
    ods = history.load_history(history.empty_ods(spark, spec), rows, spec, "2002-01-01 00:00:00")
    hot = ods.filter(F.col("global_case_number") == "HOT")
    assert hot.count() == 7                                   # 7 distinct versions
    assert hot.filter("is_active = 1").first()["case_status"] == "6"
    assert ods.groupBy("global_case_number").agg(F.sum("is_active").alias("a")) \
        .filter("a <> 1").count() == 0


def test_report_plan_join_is_not_a_cross_product(wh):
    p = plan_of(wh.pivot)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_semi_join_input_is_deduplicated_first(wh):
    p = plan_of(facts.case_fact_source(wh.ods_case, wh.fct_request, wh.dims))
    assert "LeftSemi" in p
    semi = p[p.index("LeftSemi"):]
    assert "HashAggregate" in semi
    assert SF_TINY


def test_reports_do_not_store_the_fact(spark):
    from tierwell.plans.warehouse import Warehouse
    from conftest import rows
    one, two = Warehouse(spark, SF_TINY), Warehouse(spark, SF_TINY)
    two.fct_request                                     # noqa: B018  stored first
    assert rows(one.metrics) == rows(two.metrics)
    assert "fct_request" not in one.__dict__
    assert one.fct_case.exceptAll(two.fct_case).count() == 0 and "fct_request" not in one.__dict__


def test_bucketed_rows_are_dealt_to_small_tasks(spark, monkeypatch):
    # a task sorts its rows by bucket, and they are wider than what was shuffled
    from pyspark.sql import DataFrameWriter
    from tierwell import session
    before, seen, save = spark.conf.get(session._TASK_BYTES), [], DataFrameWriter.saveAsTable

    def watched(self, *args, **kw):
        seen.append(spark.conf.get(session._TASK_BYTES))
        return save(self, *args, **kw)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", watched)
    table = session.bucketed_table(spark.range(1000).repartition(3), ["id"])
    assert seen == ["16m"] and spark.conf.get(session._TASK_BYTES) == before
    assert table.count() == 1000 and "Exchange" not in plan_of(table.groupBy("id").count())


def test_lookups_that_are_not_read_are_left_out(wh):
    src = facts.request_fact_source(wh.ods_request, wh.dims)
    lookups = lambda df: plan_of(df).count("BroadcastHashJoin LeftOuter")
    # one join is that of the colliding keys
    assert lookups(src) == len(facts.REQUEST_LOOKUPS) + 1
    assert lookups(src.select("request_number")) == 1 and lookups(src.select("request_number", "spr_act_id")) == 2


def test_second_load_does_not_store_the_facts(spark, monkeypatch):
    from tierwell.plans import warehouse
    stored, keep = [], warehouse.materialize

    def seen(df):
        stored.append(df.columns)
        return keep(df)
    monkeypatch.setattr(warehouse, "materialize", seen)
    w = warehouse.Warehouse(spark, SF_TINY)
    assert w.fct_request_second.count() > 0 and w.pivot_state_second.pivot.count() > 0
    assert "fct_request" not in w.__dict__ and not any("request_details" in c and "spr_act_id" in c for c in stored)
