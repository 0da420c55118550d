"""Semi join behind a Bloom filter: same rows, fewer of them shuffled."""

import pytest
from pyspark.sql import functions as F

from tierwell.operators.bloom import bloom_filter, bloom_semi_join, maybe_in
from tierwell.session import materialize

from conftest import rows


@pytest.mark.parametrize("words", [1, 64, 1 << 12])
def test_equals_the_exact_join(spark, words):
    big = spark.range(20000).select(F.when(F.col("id") % 11 > 0, F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
                                    F.col("id").alias("_w0"))
    keys = materialize(spark.range(0, 400, 2).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
                       .unionByName(spark.createDataFrame([(None,), ("absent",), ("k2",)], "k string")))
    got = bloom_semi_join(big, keys, "k", words)
    assert got.columns == big.columns
    assert rows(got) == rows(big.join(keys, "k", "left_semi").select(*big.columns))
    assert bloom_semi_join(big, keys.where("false"), "k", words).collect() == []
    assert bloom_filter(keys, F.col("k"), words).count() <= words


def test_rows_before_the_shuffle_fall_with_selectivity(spark):
    big = spark.range(50000).select(F.col("id").cast("string").alias("k"))
    passed = {}
    for n in (50, 5000, 50000):
        keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
        passed[n] = maybe_in(big, F.col("k"), bloom_filter(keys, F.col("k"))).count()
        assert n <= passed[n] <= n + 500
    assert passed[50] < 100


def test_case_fact_filters_before_its_shuffle(spark, wh):
    from tierwell.plans import facts
    few = wh.fct_request.where(F.col("request_number").substr(4, 7) < "0000100")
    got = facts.case_fact_source(wh.ods_case, few, wh.dims)
    want = wh.ods_case.where("is_active = 1").join(
        few.select(F.substring_index("request_number", ".", 1).alias("c")).distinct(),
        F.expr("substr(global_case_number, 4)") == F.col("c"), "left_semi")
    assert 0 < got.count() == want.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_bits" in plan and plan.count("BroadcastNestedLoopJoin") == 0
