"""Upserts (M2, M3), surrogate ids (M7), enumerations, quirk K5."""

from pyspark.sql import Window, functions as F

from tierwell.operators import merge
from tierwell.plans import dims as D
from tierwell.session import materialize

from conftest import rows

DIM = "id bigint, code string, name string, note string"
SRC = "code string, name string, note string"


def test_insert_new_duplicate_source_key_inserts_once(spark):
    dst = spark.createDataFrame([(1, "A", "a", "x")], DIM)
    src = spark.createDataFrame([("B", "b1", "n"), ("B", "b2", "n"), ("A", "zz", "n")], SRC)
    out = merge.insert_new(dst, src, ["code"])
    assert rows(out) == [(1, "A", "a", "x"), (2, "B", "b2", "n")]


def test_upsert_matched_unmatched_untouched(spark):
    dst = spark.createDataFrame([(1, "A", "a", "keep"), (2, "C", "c", "keep")], DIM)
    src = spark.createDataFrame([("A", "a2", "new"), ("B", "b", "new")], SRC)
    out = merge.upsert(dst, src, ["code"], ["name"])  # note is insert-only
    assert rows(out) == [(1, "A", "a2", "keep"), (2, "C", "c", "keep"), (3, "B", "b", "new")]


def test_upsert_null_update_value_is_written(spark):
    dst = spark.createDataFrame([(1, "A", "a", "x")], DIM)
    src = spark.createDataFrame([("A", None, "y")], SRC)
    out = merge.upsert(dst, src, ["code"], ["name", "note"])
    assert rows(out) == [(1, "A", None, "y")]


def test_new_ids_continue_after_max_in_key_order(spark):
    dst = spark.createDataFrame([(7, "M", "m", None)], DIM)
    src = spark.createDataFrame([("Z", "z", None), ("A", "a", None)], SRC)
    out = merge.insert_new(dst, src, ["code"])
    assert rows(out, "id", "code") == [(7, "M"), (8, "A"), (9, "Z")]


def test_distributed_ids_equal_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    a = merge.assign_ids(df.repartition(7), ["k"], start=100)
    b = df.withColumn("id", F.row_number().over(Window.orderBy("k")) + 100)
    assert rows(a, "k", "id") == rows(b, "k", "id")
    assert rows(a, "id")[0] == (101,) and rows(a, "id")[-1] == (5100,)


def test_enum_dims_joint_equals_one_by_one(wh):
    vals = wh.values
    joint = D.enum_dims(vals)
    for name in ["spr_status", "spr_popular_provider", "spr_request_type"]:
        one = D.enum_dim(name, vals)
        assert rows(D.split_enum(joint, name)) == rows(one)


def test_enum_dims_second_load_keeps_ids(spark, wh):
    first = materialize(D.enum_dims(wh.values))
    again = D.enum_dims(wh.values, first)
    assert rows(again, "dim", "id", "value") == rows(first, "dim", "id", "value")
    part = first.filter(~((F.col("dim") == "spr_act") & (F.col("value") == "No")))
    grown = D.split_enum(D.enum_dims(wh.values, part), "spr_act")
    old = D.split_enum(part, "spr_act")
    new = grown.join(old, "id", "left_anti")
    assert rows(new, "act_type") == [("No",)] and new.first()["id"] == max(r[0] for r in rows(old, "id")) + 1


def test_agent_upsert_new_account_gets_next_id(spark, wh):
    case_only = D.ColumnValues({"case": wh.ods_case}, columns={"case": D.AGENT_COLUMNS["case"]})
    first = materialize(D.agent_dim(_only(case_only, "case")))
    n_first = first.count()
    full = D.agent_dim(wh.values, first)
    new = full.join(first.select("username"), "username", "left_anti")
    assert rows(new, "username") == [("it.support",)]  # known only from addresses
    assert new.first()["id"] == n_first + 1
    assert rows(full.join(first, ["id", "username", "fullname"]), "id") == rows(first, "id")


class _only(D.ColumnValues):
    """Values of one table only (other role tables empty)."""

    def __init__(self, base, entity):
        self._base, self._entity = base, entity

    def of(self, entity, *cols):
        t = self._base.of(self._entity, *D.AGENT_COLUMNS[self._entity])
        return t if entity == self._entity else t.limit(0)

    @property
    def spark(self):
        return self._base.spark


def test_customer_insert_only_column_kept(spark, wh):
    from tierwell import specs
    from tierwell.operators import history
    from tierwell.sources import fixtures as fx
    first = materialize(wh.dims["spr_customer"])
    ods2 = history.load_history(wh.ods_address, fx.stg_address(spark, wh.sf_dir, 2),
                                specs.ADDRESS, "2002-01-02 00:00:00")
    agents = D.agent_dim(D.ColumnValues({**wh.ods, "address": ods2}))
    second = D.customer_dim(ods2, wh.dims["spr_client"], wh.dims["spr_customer_type"], agents,
                            first)
    j = first.alias("a").join(second.alias("b"), "id")
    changed = j.filter(F.col("b.last_name").endswith("-2"))
    assert changed.count() > 0
    # added_by_id is insert-only: unchanged although the profile's added_by changed
    assert changed.filter(F.col("a.added_by_id") != F.col("b.added_by_id")).count() == 0
    assert second.count() == first.count()


def test_upsert_same_result_with_broadcast_or_shuffled_source(spark):
    dst = spark.range(0, 2000).select(F.col("id"), F.col("id").cast("string").alias("code"),
                                      F.lit("old").alias("name"), F.lit("n").alias("note"))
    src = spark.range(1990, 2010).select(F.col("id").cast("string").alias("code"),
                                         F.lit("new").alias("name"), F.lit("m").alias("note"))
    a = rows(merge.upsert(dst, src, ["code"], ["name"]))
    c = rows(merge.insert_new(dst, src, ["code"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert a == rows(merge.upsert(dst, src, ["code"], ["name"]))
        assert c == rows(merge.insert_new(dst, src, ["code"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(r[2] == "new" for r in a) == 20 and len(a) == len(c) == 2010


def test_upsert_evaluates_its_source_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x
    dst = materialize(spark.createDataFrame([(1, "A", "a", "x")], DIM))
    src = spark.createDataFrame([("A", "a2", "n"), ("B", "b", "n")], SRC)
    src = src.withColumn("name", F.udf(count, "string")("name"))
    assert merge.upsert(dst, src, ["code"], ["name"]).count() == 2
    assert seen.value == 2


def test_newest_of_colliding_keys(spark):
    df = spark.createDataFrame([("x1", 1, None), ("x2", 1, "b"), ("y1", 3, "c"), ("z1", 2, "q"), ("z2", 9, "a"), ("z3", 9, "b")],
                               "name string, at int, tie string")
    out = merge.newest_of_colliding(df, {"k": F.substring("name", 1, 1)}, ["at", "tie", "name"])
    assert rows(out, "name") == [("x2",), ("y1",), ("z3",)]


def test_no_single_partition_step_in_dimensions(wh):
    import contextlib
    import io
    for name in ["spr_client", "spr_agent", "spr_city", "spr_status", "spr_customer"]:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            wh.dims[name].explain(mode="formatted")
        assert "SinglePartition" not in buf.getvalue()


def test_parallel_dimension_build_equals_lazy(spark):
    from tierwell.plans.warehouse import Warehouse
    from conftest import SF_TINY
    a = Warehouse(spark, SF_TINY).build_dims()
    b = Warehouse(spark, SF_TINY).dims
    for name in ["spr_client", "spr_agent", "spr_customer", "spr_phone", "spr_email",
                 "spr_currency", "spr_country", "spr_city", "spr_act", "spr_status"]:
        assert rows(a[name]) == rows(b[name]), name


def _kept_plans(monkeypatch, module):
    """Plans of what ``module`` stores from here on."""
    plans, keep = [], module.materialize

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)
    monkeypatch.setattr(module, "materialize", seen)
    return plans


def test_rows_without_a_colliding_key_are_dropped_before_they_move(spark, monkeypatch):
    df = materialize(spark.range(1000).select(F.concat(F.lit("n"), F.col("id")).alias("name"),
                                              (F.col("id") % 997).alias("k"), F.lit(1).alias("at")))
    plans = _kept_plans(monkeypatch, merge)
    out = merge.newest_of_colliding(df, {"_key": F.col("k")}, ["at", "name"])
    assert out.count() == 997 and {"n997", "n998", "n999"} <= {r.name for r in out.collect()} and out.where("name = 'n1'").count() == 0
    assert "_bits" in plans[-1]        # a Bloom filter of the colliding keys


def test_client_reads_whole_rows_for_its_newest_only(spark, wh, monkeypatch):
    want = rows(wh.dims["spr_client"])
    plans, numbered = _kept_plans(monkeypatch, D), _kept_plans(monkeypatch, merge)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(D.client_dim(wh.ods_case))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == want and len(plans) == 1 and "_bits" in numbered[-1]


def test_upsert_that_replaces_whole_rows_stores_keys_only(spark, monkeypatch):
    dst = spark.createDataFrame([("A", "a", "x"), ("A", "a0", "x"), ("C", "c", "x"), (None, "n", "x")], SRC)
    src = spark.createDataFrame([("A", "a2", None), ("B", "b", "y"), (None, "m", "y")], SRC)
    stored, keep = [], merge.materialize
    monkeypatch.setattr(merge, "materialize", lambda df: stored.append(df.columns) or keep(df))
    out = merge.upsert(dst, src, ["code"], ["name", "note"], id_col=None, src_unique=True)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("A", "a2", None)] * 2 + [("C", "c", "x"), (None, "n", "x"), ("B", "b", "y"), (None, "m", "y")], key=str)
    assert stored == [["_o_code", "_hit", "_n"]]
