"""Star lookup: one pass over the codes of all large dimensions."""

import re

import pytest
from pyspark.sql import functions as F

from tierwell.operators.lookup import broadcast_limit, dim_pairs, lookup, planned_bytes, star_lookup
from tierwell.session import materialize

from conftest import rows


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def star(spark):
    # a third of all rows has one code, some codes are unknown or null
    fact = spark.range(3000).select(
        F.col("id").cast("string").alias("key"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("a"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), (F.col("id") % 90).cast("string"))).alias("b"),
        (F.col("id") % 11).alias("n"), F.lit("kept").alias("_v"))
    codes = spark.range(60).select(F.col("id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("code"))
    codes = codes.unionByName(spark.createDataFrame([(99, "hot"), (100, None)], "id long, code string"))
    numbers = spark.range(9).select((F.col("id") * 10).alias("id"), F.col("id").alias("num"))
    return (materialize(fact), {"codes": materialize(dim_pairs(codes, "code")), "nums": materialize(dim_pairs(numbers, "num"))},
            [("a", "codes", "a_id"), ("b", "codes", "b_id"), ("n", "nums", "n_id")])


def test_equals_single_lookups(spark, no_broadcast):
    fact, pairs, roles = star(spark)
    want = fact
    for column, name, out in roles:
        want = lookup(want, pairs[name], column, out)
    key = lambda r: tuple(str(x) for x in r)
    got = star_lookup(fact, "key", roles, pairs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    # codes, ids and fact are shuffled once each; the fourth shuffle is that of the dimensions
    assert "Broadcast" not in plan and len(re.findall(r"Exchange", plan)) == 4


def test_sizes_choose_the_way(spark):
    fact, pairs, roles = star(spark)
    assert 0 < planned_bytes(pairs["codes"]) < broadcast_limit(spark)
    plan = star_lookup(fact, "key", roles, pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "Exchange hash" not in plan


def test_request_fact_without_broadcasts(spark, wh, no_broadcast):
    from compare import digest, duck, norm
    import oracle_sql
    from conftest import SF_TINY
    from tierwell.plans import facts
    got = facts.build_request_fact(wh.ods_request, wh.dims).select(*facts.REQUEST_FACT_COLUMNS)
    rel = duck(SF_TINY).sql(oracle_sql.queries()["fact_request"])
    assert digest(got.columns, [tuple(map(norm, r)) for r in got.collect()])[0] == \
        digest(rel.columns, [tuple(map(norm, r)) for r in rel.fetchall()])[0]
    assert rows(got, "request_number")
