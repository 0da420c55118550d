"""Spine (U5), plan by day (J9, K16), GROUPS frame (W3) and report formulas."""

import datetime as dt

from pyspark.sql import functions as F

from tierwell.operators.frames import previous_group_first, previous_value
from tierwell.operators.spine import date_spine, plan_by_day
from tierwell.plans import reports

from conftest import rows

PLAN = "client string, target bigint, effective_from date, effective_to date"
D = dt.date


def test_spine_to_end_of_month(spark):
    s = date_spine(spark, "2022-01-01", "2022-08-15")
    assert s.count() == 243
    assert s.agg(F.max("date")).first()[0] == D(2022, 8, 31)
    assert s.filter(F.col("date") == D(2022, 2, 3)).first()["month"] == "2022-02"


def test_plan_interval_edges(spark):
    plan = spark.createDataFrame([
        ("A", 10, D(2022, 1, 2), D(2022, 1, 4)),   # days 2, 3 (to is exclusive)
        ("B", 10, D(2022, 1, 5), D(2022, 1, 3)),   # from > to: nothing
        ("C", 10, D(2022, 1, 1), None),            # open end: nothing
    ], PLAN)
    got = rows(plan_by_day(plan, "2022-01-01", "2022-01-20"), "client", "date")
    assert got == [("A", D(2022, 1, 2)), ("A", D(2022, 1, 3))]


def test_overlapping_plans_double_rows(spark):
    plan = spark.createDataFrame([("A", 10, D(2022, 1, 1), D(2022, 1, 3)),
                                  ("A", 20, D(2022, 1, 2), D(2022, 1, 4))], PLAN)
    days = plan_by_day(plan, "2022-01-01", "2022-01-20")
    assert days.filter(F.col("date") == D(2022, 1, 2)).count() == 2


def test_previous_group_first_gap_example(spark):
    df = spark.createDataFrame([("c", "2022-01", 10), ("c", "2022-01", 10), ("c", "2022-03", 7),
                                ("c", "2022-04", 5)], "client string, month string, total long")
    got = rows(previous_group_first(df, "client", "month", ["total"]).distinct(),
               "month", "total_prev")
    assert got == [("2022-01", 10), ("2022-03", 10), ("2022-04", 7)]
    agg = df.distinct()
    assert rows(previous_value(agg, "client", "month", ["total"]), "month", "total_prev") == got


def _pivot_rows(spark, data):
    schema = ("date date, client string, cm long, rso long, util_rso long, act long, dp long")
    return spark.createDataFrame(data, schema)


def test_pivot_zero_target_gives_null_percentage(spark):
    m = _pivot_rows(spark, [(D(2022, 2, 1), "A", 5, 0, 0, 0, 0), (D(2022, 3, 1), "A", 9, 0, 0, 0, 0),
                            (D(2022, 3, 1), "B", 1, 0, 0, 0, 0)])
    plan = spark.createDataFrame([("A", 0, D(2022, 1, 1), D(2023, 1, 1))], PLAN)
    p = reports.daily_pivot(m, plan)
    a = {r["month"]: r for r in p.filter("client = 'A'").collect()}
    assert a["2022-02"]["percentage"] is None and a["2022-02"]["target_monthly"] == 0
    assert a["2022-03"]["prev_month_total"] == 5 and a["2022-02"]["prev_month_total"] == 5
    assert a["2022-03"]["days_in_prev_month"] == 28.0
    b = p.filter("client = 'B'").first()
    assert b["target_monthly"] is None and b["percentage"] is None


def test_days_at_max_total(spark):
    m = _pivot_rows(spark, [(D(2022, 2, 1), "A", 5, 0, 0, 0, 0), (D(2022, 3, 1), "A", 9, 0, 0, 0, 0)])
    plan = spark.createDataFrame([("A", 100, D(2022, 1, 1), D(2023, 1, 1))], PLAN)
    pivot = reports.daily_pivot(m, plan)
    s = reports.client_summary(pivot, ("2022-01-01", "2022-12-31"), "2022-03-11").first()
    # max total 9 is in March (31 days); yesterday is day 10
    assert s["forecast_without_dp"] == round(9 / 10 * 31)


def test_plan_fact_need_is_zero_when_plan_met(spark):
    m = _pivot_rows(spark, [(D(2022, 3, 1), "BLB", 50, 0, 0, 0, 0)])
    plan = spark.createDataFrame([("BLB", 10, D(2022, 1, 1), D(2023, 1, 1))], PLAN)
    clients = spark.createDataFrame([(1, "BLB", "BLB", 1, 1)],
                                    "id long, client string, client_name string, is_util int, "
                                    "is_active int")
    pivot = reports.daily_pivot(m, plan)
    r = reports.plan_fact(pivot, clients, ("2022-03-01", "2022-03-31"), "2022-03-11").first()
    assert r["need_cases_per_day"] == 0.0 and r["fact"] == 50


def test_report_window_is_inclusive(wh):
    stats = wh.daily_stats()
    dates = [r["date"] for r in stats.collect()]
    assert max(dates) <= D(2001, 8, 1) and min(dates) >= D(2001, 7, 1)
    assert D(2001, 8, 1) in dates


def test_pivot_view_answers_sql(spark, wh):
    name = reports.register_pivot_view(wh.pivot)
    n = spark.sql(f"select count(*) as n from {name} where client is not null").first()["n"]
    assert n == wh.pivot.count()
