"""The pivot kept up from a change feed equals the one built anew."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tierwell.plans import incremental, reports
from tierwell.session import materialize

FACT = "request_number string, added_dt timestamp_ntz, spr_act_id long, spr_rso_id long, other string"


def facts(rnd, keys):
    out = []
    for k in keys:
        client = ["AAA", "BBB", "CCC", "HOT"][min(3, k % 6)]
        day = dt.datetime(2022, rnd.randint(1, 9), rnd.randint(1, 28), rnd.randint(0, 23))
        out.append((f"{client}{k:04}.1", day, rnd.choice([None, 1, 2, 3, 9]), rnd.choice([None, None, 5]), str(rnd.random())))
    return out


def key(r):
    return tuple(str(x) for x in r)


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_applied_feed_equals_a_rebuild(spark):
    rnd = random.Random(2)
    acts = spark.createDataFrame([(1, "No"), (2, "Yes"), (3, "Free Dragon Pass")], "id long, act_type string")
    clients = lambda flags: spark.createDataFrame(
        [(i, c, f) for i, (c, f) in enumerate(flags.items())], "id long, client string, is_util int")
    plan = spark.createDataFrame([("AAA", 10, dt.date(2022, 1, 1), dt.date(2022, 6, 1)),
                                  ("AAA", 20, dt.date(2022, 3, 1), dt.date(2023, 1, 1)),
                                  ("HOT", 0, dt.date(2022, 1, 1), dt.date(2023, 1, 1))],
                                 "client string, target bigint, effective_from date, effective_to date")
    first = facts(rnd, range(240))
    # a month that goes, one that comes, edits, new rows, and edits that do not matter
    second = [r for r in first if not (r[0].startswith("BBB") and r[1].month == 4)]
    second = [(r[0], r[1], r[2], 5 if r[3] is None else None, r[4]) if i % 17 == 0 else (*r[:4], "new") if i % 5 == 0 else r
              for i, r in enumerate(second)] + facts(rnd, range(300, 330))
    old, new = (materialize(spark.createDataFrame(x, FACT)) for x in (first, second))
    before = {"AAA": 1, "BBB": 0, "CCC": 0, "HOT": 1}
    state = incremental.build(old, clients(before), acts, plan, "2022-01-01", "2022-06-10")
    same(state.pivot, reports.daily_pivot(reports.daily_metrics(old, clients(before), acts, "2022-01-01", "2022-06-10"), plan))
    feed = materialize(incremental.row_changes(old, new, "request_number", incremental.FEED))
    assert 0 < feed.count() < 200
    for flags, as_of in ((before, "2022-06-10"), ({**before, "CCC": 1}, "2022-08-20")):
        got = incremental.apply(state, feed, clients(flags), acts, plan, as_of)
        want = reports.daily_metrics(new, clients(flags), acts, "2022-01-01", as_of)
        same(got.pivot, reports.daily_pivot(want, plan))
        same(got.totals, reports.with_previous(reports.month_totals(reports.with_target(want, plan))))
    # a load that changes nothing
    none = incremental.apply(state, feed.where("false"), clients(before), acts, plan)
    same(none.pivot, state.pivot)


def test_feed_has_old_and_new_rows(spark):
    cols = "request_number string, a long, b string"
    old = spark.createDataFrame([("x", 1, "p"), ("y", None, "p"), ("z", 3, "p")], cols)
    new = spark.createDataFrame([("x", 1, "q"), ("y", 2, "p"), ("w", None, None)], cols)
    got = incremental.row_changes(old, new, "request_number", ["request_number", "a"])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        [("y", None, -1), ("y", 2, 1), ("z", 3, -1), ("w", None, 1)], key=key)
    assert incremental.row_changes(old, old, "request_number", ["request_number", "a", "b"]).count() == 0


def test_the_fact_is_not_read(spark, wh, monkeypatch):
    feed = materialize(incremental.row_changes(wh.fct_request, wh.fct_request_second, "request_number", incremental.FEED))
    state, seen = wh.pivot_state, []
    plain = incremental.materialize
    monkeypatch.setattr(incremental, "materialize", lambda df: (seen.append(
        df._jdf.queryExecution().optimizedPlan().toString()), plain(df))[1])
    incremental.apply(state, feed, wh.dims["spr_client"], wh.dims["spr_act"], wh.stg_rso_plan)
    assert seen and not any("confirmation_number" in p or "added_dt" in p and "sign" not in p for p in seen)
    assert feed.where(F.col("sign") == 1).count() > 0
