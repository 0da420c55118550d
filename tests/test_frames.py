"""GROUPS frames against DuckDB's own."""

import random

import duckdb
import pandas as pd
import pytest

from tierwell.operators.frames import groups_frame

ROWS = None


def table(spark):
    rnd = random.Random(11)
    out = []
    for i in range(700):
        p = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None, "c"])
        o = rnd.choice([None, *range(60)]) if p == "hot" else rnd.randint(0, 9)
        out.append((i, p, o, rnd.choice([None, rnd.randint(-9, 9)])))
    return out, spark.createDataFrame(out, "k long, p string, o long, x long").repartition(5)


def sql(bounds):
    return f"""
        select k, sum(x) over w as s, count(x) over w as n, min(x) over w as lo, max(x) over w as hi,
               (min({{'o': coalesce(o, -1), 'k': k, 'x': coalesce(x, 1000)}}) over w).x as f,
               (max({{'o': coalesce(o, -1), 'k': k, 'x': coalesce(x, 1000)}}) over w).x as l
        from t window w as (partition by p order by o nulls first groups between {bounds})"""


@pytest.mark.parametrize("preceding,following,block", [
    (1, 0, 7), (2, 3, 5), (0, 0, 4), (None, 0, 6), (None, 2, 5), (3, None, 5), (None, None, 9), (1, 1, 100000)])
def test_equals_duckdb(spark, preceding, following, block):
    data, df = table(spark)
    outs = {"s": ("sum", "x"), "n": ("count", "x"), "lo": ("min", "x"), "hi": ("max", "x"),
            "f": ("first", "x", ["k"]), "l": ("last", "x", ["k"])}
    got = groups_frame(df, "p", "o", outs, preceding, following, block)
    assert got.columns == ["k", "p", "o", "x", *outs]
    t = pd.DataFrame(data, columns=["k", "p", "o", "x"]).astype({"o": "Int64", "x": "Int64"})  # noqa: F841
    word = lambda n, side: f"unbounded {side}" if n is None else f"{n} {side}"
    want = duckdb.sql(sql(f"{word(preceding, 'preceding')} and {word(following, 'following')}")).fetchall()
    found = {r.k: (r.s, r.n, r.lo, r.hi, *[1000 if v is None else v for v in (r.f, r.l)]) for r in got.collect()}
    assert found == {r[0]: tuple(None if v is None else int(v) for v in r[1:]) for r in want}


def test_empty_and_hot_partition_over_blocks(spark):
    _, df = table(spark)
    assert groups_frame(df.where("false"), "p", "o", {"s": ("sum", "x")}, 1, 0).collect() == []
    got = groups_frame(df, "p", "o", {"s": ("sum", "x")}, 1, 0, block=5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "_block" in plan and "SinglePartition" not in plan
