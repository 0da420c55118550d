"""Gate (P3/P4) and history load (M1: W1, W2, M4; quirks K1, K2, K4)."""

import datetime as dt

from pyspark.sql import functions as F

from tierwell import specs
from tierwell.operators import gate, history
from tierwell.sources import fixtures as fx

from conftest import SF_TINY, rows

T1, T2, T3 = (dt.datetime(2002, 1, d) for d in (1, 2, 3))


def test_gate_split_is_exact_complement(spark):
    stg = fx.stg_case(spark, SF_TINY)
    valid, rejected = gate.split_valid(stg, specs.CASE.required)
    assert valid.count() + rejected.count() == stg.count()
    assert valid.join(rejected, specs.CASE.columns, "inner").count() == 0
    assert rejected.filter(gate.is_complete(specs.CASE.required)).count() == 0


def test_row_with_two_nulls_is_one_reject(spark):
    stg = spark.createDataFrame([(None, None, "x")], "a string, b string, c string")
    valid, rejected = gate.split_valid(stg, ["a", "b"])
    assert valid.count() == 0 and rejected.count() == 1


def _mini_spec():
    schema = "k string, v string, extra bigint, ts timestamp_ntz"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    return specs.EntitySpec(name="mini", schema=st, required=("k",), dedupe=("k", "v", "ts"),
                            key="k", change_ts="ts")


def _load(spark, spec, batches):
    ods = history.empty_ods(spark, spec)
    for i, data in enumerate(batches, start=1):
        stg = spark.createDataFrame(data, spec.schema)
        ods = history.load_history(ods, stg, spec, f"2002-01-0{i} 00:00:00")
    return ods


def test_redelivery_moves_effective_from_and_aba(spark):
    spec = _mini_spec()
    a = ("k1", "A", 1, dt.datetime(2001, 1, 1))
    b = ("k1", "B", 1, dt.datetime(2001, 1, 2))
    ods = _load(spark, spec, [[a], [b], [a]])
    got = rows(ods, "v", "effective_from", "is_active")
    # A -> B -> A: A is current again with the newest stamp, B stays as history
    assert got == [("A", T3, 1), ("B", T2, 0)]


def test_versions_differing_outside_dedupe_collapse_newest_wins(spark):
    spec = _mini_spec()
    x1 = ("k1", "A", 10, dt.datetime(2001, 1, 1))
    x2 = ("k1", "A", 11, dt.datetime(2001, 1, 1))
    ods = _load(spark, spec, [[x1], [x2]])
    assert rows(ods, "extra", "effective_from", "is_active") == [(11, T2, 1)]


def test_ties_in_one_batch_are_broken_deterministically(spark):
    spec = _mini_spec()
    older = ("k1", "A", 1, dt.datetime(2001, 1, 1))
    newer = ("k1", "B", 1, dt.datetime(2001, 1, 5))
    ods = _load(spark, spec, [[older, newer]])
    # same effective_from: the later change timestamp wins
    assert rows(ods, "v", "is_active") == [("A", 0), ("B", 1)]


def test_exactly_one_active_row_per_key(wh):
    for ods, key in [(wh.ods_case, "global_case_number"),
                     (wh.ods_request, "global_request_number"),
                     (wh.ods_address, "client_address_id")]:
        bad = ods.groupBy(key).agg(F.sum("is_active").alias("n")).filter("n <> 1").count()
        assert bad == 0


def test_sequential_case_loads_equal_one_pass(wh):
    seq = wh.ods_case_batches(3).select(*specs.CASE.ods_columns)
    one = wh.ods_case.select(*specs.CASE.ods_columns)
    assert seq.exceptAll(one).count() == 0 and one.exceptAll(seq).count() == 0


def test_case_batches_quirks(wh):
    ods = wh.ods_case
    k = F.substring("global_case_number", 7, 20).cast("long")
    # k % 10 == 0: A -> B -> A, two versions, A (batch 3) current
    reopened = ods.filter((k % 10 == 0) & (F.col("case_status") == "Reopened"))
    assert reopened.count() > 0
    assert reopened.filter("is_active = 1").count() == 0
    # unchanged re-deliveries keep one version stamped by the last batch
    plain = ods.filter((k % 10 != 0) & (k % 20 != 15))
    assert plain.filter(F.col("effective_from") != F.lit(T3)).count() == 0


def test_touched_only_load_equals_full_load(spark):
    stg = fx.stg_request(spark, SF_TINY)
    spec = specs.REQUEST
    from tierwell.plans.warehouse import batch_clock
    valid = gate.valid_rows(stg, spec.required)
    first = history.merge_history(history.empty_ods(spark, spec),
                                  history.stamp(valid.filter("batch < 3"), spec, batch_clock()),
                                  spec)
    third = stg.filter("batch = 3").drop("batch")
    full = history.load_history(first, third, spec, "2002-01-03 00:00:00")
    inc = history.load_history(first, third, spec, "2002-01-03 00:00:00", touched_only=True)
    assert full.exceptAll(inc).count() == 0 and inc.exceptAll(full).count() == 0


def test_wide_rows_are_neither_shuffled_nor_sorted(spark):
    # the columns that decide nothing stay in their buckets; equal rows, ties and redelivery as before
    data = [(f"k{i % 40}", f"v{i % 7}", i % 3, dt.datetime(2001, 1, 1 + i % 2)) for i in range(400)] * 2
    spec = _mini_spec()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ods = _load(spark, spec, [data])
        got = rows(ods.select("k", "v", "extra", "ts", "is_active"))
        plan = ods._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    versions = {}
    for k, v, extra, ts in data:
        versions[k, v, ts] = max(extra, versions.get((k, v, ts), extra))
    best = {}
    for (k, v, ts), extra in versions.items():
        best[k] = max(best.get(k, (ts, v, extra)), (ts, v, extra))
    assert got == sorted((k, v, extra, ts, int(best[k] == (ts, v, extra))) for (k, v, ts), extra in versions.items())
    # the last join, on the buckets, has no exchange or sort above the wide scan
    top = plan.split("== Initial Plan ==")[0].split("ShuffledHashJoin")[1]
    assert "Exchange" not in top[:top.index("FileScan")] and "Sort " not in top[:top.index("FileScan")]


def test_touched_only_load_moves_no_row_of_the_history(spark):
    # no broadcast by size; a key that passes the filter by chance and one without a key stay as they were
    spec = _mini_spec()
    day = lambda n: dt.datetime(2001, 1, n)
    first = [(f"k{i % 50}", f"v{i % 3}", i, day(1 + i % 4)) for i in range(300)]
    second = [(f"k{i}", "v9", i, day(9)) for i in range(0, 10)] + [("new", "v", 1, day(2))]
    old, words = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), history.TOUCHED_WORDS
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ods = history.materialize(_load(spark, spec, [first]))
        unkeyed = history.materialize(ods.limit(1).withColumn("k", F.lit(None).cast("string")))
        ods = history.materialize(ods.unionByName(unkeyed))
        stg = spark.createDataFrame(second, spec.schema)
        full = rows(history.load_history(ods.where("k is not null"), stg, spec, "2002-01-02 00:00:00"))
        for n in (words, 1):
            history.TOUCHED_WORDS = n
            part = history.load_history(ods, stg, spec, "2002-01-02 00:00:00", touched_only=True)
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert rows(part.where("k is not null")) == full
            assert part.where("k is null").drop("k").collect() == unkeyed.drop("k").collect()
            # the untouched branch: the history is scanned and given out; its keys meet the filter alone
            top = plan.split("== Initial Plan ==")[0].split("ShuffledHashJoin")[0]
            assert "LeftAnti" not in plan and "LeftSemi" not in plan and "hashpartitioning" not in top
    finally:
        history.TOUCHED_WORDS = words
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_snapshot_is_read_from_its_buckets(spark):
    # rows and flags are stored side by side: a read joins them in place, nothing moves or is decided again
    data = [(f"k{i % 40}", f"v{i % 7}", i % 3, dt.datetime(2001, 1, 1 + i % 2)) for i in range(400)]
    spec = _mini_spec()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ods = _load(spark, spec, [data])
        first, again = rows(ods), rows(ods.filter("is_active = 1"))
        plan = ods._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan and "Aggregate" not in plan and plan.count("FileScan") == 2
    assert [r for r in first if r[-1] == 1] == again and len(again) == 40


def test_keys_whose_versions_tie_and_null_keys(spark):
    # ties on (effective_from, change timestamp), one of them decided by a column outside the key, and a null key
    spec = _mini_spec()
    spec = specs.EntitySpec(**{**spec.__dict__, "required": ("v",)})
    at = dt.datetime(2001, 1, 1)
    ods = _load(spark, spec, [[("a", "x", 1, at), ("a", "y", 1, at), ("b", "x", 2, at), (None, "p", 1, at), (None, "q", 1, at),
                               ("c", "z", 1, None), ("c", "w", 5, at)]])
    assert sorted((str(r.k), r.v) for r in ods.collect() if r.is_active) == [
        ("None", "q"), ("a", "y"), ("b", "x"), ("c", "w")]
    assert ods.count() == 7


def test_stored_load_equals_lazy_load_on_ties(spark, monkeypatch):
    import random
    rnd = random.Random(5)
    days = [None, dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)]
    mini, ties = _mini_spec(), [("k", "v", "ts"), ("k", "v", "extra", "ts"), ("k", "v"), ("v", "ts")]
    data = [(f"k{rnd.randrange(40)}", rnd.choice("ABC"), rnd.randrange(3), rnd.choice(days)) for _ in range(400)]
    stg = spark.createDataFrame(data, mini.schema)
    for dedupe in ties:
        spec = specs.EntitySpec(name="ties", schema=mini.schema, required=("k",), dedupe=dedupe, key="k", change_ts="ts")
        # some rows have no clock
        at = F.when(F.col("extra") > 0, F.to_timestamp_ntz(F.concat(F.lit("2002-01-0"), F.col("extra"))))
        stamped = history.stamp(stg, spec, at)
        none = history.empty_ods(spark, spec)
        cols = ["k", "v", "extra", "ts", "effective_from", "is_active"]
        got = sorted(map(tuple, history.merge_stored(none, stamped, spec).select(*cols).collect()), key=str)
        want = sorted(map(tuple, history.merge_history(none, stamped, spec).select(*cols).collect()), key=str)
        assert got == want, dedupe


def test_load_without_ties_does_not_look_for_them(spark, monkeypatch):
    spec = _mini_spec()
    monkeypatch.setattr(history, "maybe_in", lambda *a: 1 / 0)
    a, b = ("k1", "A", 1, dt.datetime(2001, 1, 1)), ("k1", "B", 1, dt.datetime(2001, 1, 2))
    assert rows(_load(spark, spec, [[a, b], [b]]), "v", "effective_from", "is_active") == [("A", T1, 0), ("B", T2, 1)]
