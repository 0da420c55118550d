"""Daily metric block (A4), daily pivot (R1) and the three reports.

Plan shape (what the original view did with five scans of the fact and a
spine x plan cross product):

* one pass over the fact: ``groupBy(client, day)`` with five conditional
  counts, partial aggregation map-side (a hot client collapses before the
  shuffle);
* the act types are resolved through the tiny act dimension;
* the plan is joined on ``client`` with the half-open date interval as an
  extra join condition - no day explosion;
* monthly totals and the previous-month value are computed on the small
  (client, month) table and broadcast back.

All clocks are parameters: ``start`` (first spine day), ``as_of`` (today; the
spine ends with its month, reports use the day of month of yesterday) and
the inclusive report window ``(lo, hi)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import specs
from ..functions import keys as K
from ..functions.dates import (as_date, days_in_month, days_in_prev_month, end_of_month,
                               month_label, yesterday_day)
from ..operators.exact import exact_sums
from ..operators.frames import previous_value
from ..operators.intervals import interval_join

PIVOT_COLUMNS = ["date", "month", "client", "cm", "rso", "util_rso", "act", "dp", "cm_rso_act",
                 "target_monthly", "total", "total_with_dp", "prev_month_total",
                 "prev_month_total_with_dp", "days_in_prev_month", "days_in_curr_month",
                 "forecast_30_days", "plan_rso", "percentage", "plan_rso_daily", "month_num"]


COUNTS = ["cm", "rso", "act", "dp"]


def day_counts(rows: DataFrame, spr_act: DataFrame, sign: str | None = None) -> DataFrame:
    """(date, client, cm, rso, act, dp) of fact rows; with ``sign`` each row counts as that column (+1, -1).

    rso/act/dp overlap (each has its own predicate); cm is the remainder with
    neither a counted act nor an RSO.
    """
    acts = (spr_act.filter(F.col("act_type").isin(specs.ACT_YES, specs.ACT_DRAGON_PASS))
                   .select(F.col("id").alias("_act_id"), F.col("act_type").alias("_act")))
    facts = rows.select(K.client_of_request("request_number").alias("client"),
                        K.day_of("added_dt").alias("date"), "spr_act_id", "spr_rso_id", *([sign] if sign else []))
    facts = facts.join(acts, facts["spr_act_id"] == acts["_act_id"], "left")
    rso = F.col("spr_rso_id").isNotNull()

    def count(predicate):
        if sign is None:
            return F.count_if(predicate)
        return F.sum(F.when(F.coalesce(predicate, F.lit(False)), F.col(sign)).otherwise(0)).cast("long")
    return facts.groupBy("date", "client").agg(
        count(F.col("_act").isNull() & ~rso).alias("cm"), count(rso).alias("rso"),
        count(F.col("_act") == specs.ACT_YES).alias("act"),
        count(F.col("_act") == specs.ACT_DRAGON_PASS).alias("dp"))


def metrics_of(counts: DataFrame, spr_client: DataFrame) -> DataFrame:
    """Daily metrics from the counts: days with ``cm > 0``, with ``util_rso`` for utilisation clients."""
    per_day = counts.filter(F.col("cm") > 0)
    util = spr_client.select(F.col("client").alias("_u_client"), "is_util")
    per_day = per_day.join(util, per_day["client"] == util["_u_client"], "left")
    return per_day.select(
        "date", "client", "cm", "rso",
        F.when(F.col("is_util") == 1, F.col("rso")).otherwise(F.lit(0).cast("long")).alias("util_rso"),
        "act", "dp")


def daily_metrics(fct_request: DataFrame, spr_client: DataFrame, spr_act: DataFrame,
                  start, as_of) -> DataFrame:
    """(date, client, cm, rso, util_rso, act, dp) for spine days with ``cm > 0``.

    A (client, day) without cm is dropped.
    """
    lo = as_date(start).cast("timestamp_ntz")
    hi = F.date_add(end_of_month(as_of), 1).cast("timestamp_ntz")
    facts = fct_request.filter((F.col("added_dt") >= lo) & (F.col("added_dt") < hi))
    return metrics_of(day_counts(facts, spr_act), spr_client)


def with_target(metrics: DataFrame, plan: DataFrame) -> DataFrame:
    """The metrics with their month and each plan target that covers the day."""
    p = (plan.select(F.col("client").alias("_p_client"), F.col("target").alias("target_monthly"),
                            F.col("effective_from").alias("_p_from"),
                            F.col("effective_to").alias("_p_to")))
    cond = ((metrics["client"] == p["_p_client"]) & (metrics["date"] >= p["_p_from"])
            & (metrics["date"] < p["_p_to"]))
    return (metrics.join(p, cond, "left")
            .select("date", month_label(F.col("date")).alias("month"), "client", "cm", "rso",
                    "util_rso", "act", "dp",
                    (F.col("cm") + F.col("rso") + F.col("act")).alias("cm_rso_act"),
                    "target_monthly"))


def month_totals(base: DataFrame) -> DataFrame:
    return base.groupBy("client", "month").agg(
        F.sum("cm_rso_act").alias("total"),
        F.sum(F.col("cm_rso_act") + F.col("dp")).alias("total_with_dp"))


def with_previous(totals: DataFrame) -> DataFrame:
    """Totals by (client, month) with those of the previous month that has data."""
    totals = previous_value(totals, "client", "month", ["total", "total_with_dp"])
    return totals.select(
        "client", "month", "total", "total_with_dp",
        F.col("total_prev").alias("prev_month_total"),
        F.col("total_with_dp_prev").alias("prev_month_total_with_dp"))


def daily_pivot(metrics: DataFrame, plan: DataFrame) -> DataFrame:
    """Metrics x plan target, monthly totals, previous month and forecast."""
    base = with_target(metrics, plan)
    # (client, month) rows: small, but counting it would recompute the whole
    # chain; AQE turns this join into a broadcast from the measured size
    return pivot_rows(base, with_previous(month_totals(base)))


def pivot_rows(base: DataFrame, totals: DataFrame) -> DataFrame:
    out = base.join(totals, ["client", "month"])
    d_prev, d_curr = days_in_prev_month(F.col("date")), days_in_month(F.col("date"))
    forecast = (F.col("prev_month_total").cast("double") / d_prev) * F.lit(float(specs.FORECAST_DAYS))
    plan_rso = F.col("target_monthly") - F.col("forecast_30_days")
    return (out.withColumn("days_in_prev_month", d_prev)
            .withColumn("days_in_curr_month", d_curr)
            .withColumn("forecast_30_days", forecast)
            .withColumn("plan_rso", plan_rso)
            .withColumn("percentage", F.try_divide(F.col("plan_rso"), F.col("target_monthly")))
            .withColumn("plan_rso_daily", F.col("percentage") / F.col("days_in_curr_month"))
            .withColumn("month_num", F.col("month").substr(6, 2))
            .select(*PIVOT_COLUMNS))


def plan_on_spine(spine: DataFrame, plan: DataFrame) -> DataFrame:
    """J9 on dates alone: each spine day with every plan interval that holds it.

    The rows of ``plan_by_day`` from any spine, also one with gaps, without
    exploding an interval into its days.
    """
    named = plan.select("client", F.col("target").alias("target_monthly"), "effective_from", "effective_to")
    pairs = interval_join(spine, F.unix_date("date"), named, F.unix_date("effective_from"), F.unix_date("effective_to"))
    return pairs.select("date", "month", "client", "target_monthly")


def _window(pivot: DataFrame, window) -> DataFrame:
    lo, hi = window
    return pivot.filter(F.col("date").between(as_date(lo), as_date(hi)))


def _days_at_max_total():
    # days_in_curr_month of the row holding max(total); ties -> the larger value
    return F.max_by(F.col("days_in_curr_month"), F.struct("total", "days_in_curr_month"))


def _forecast_without_dp(as_of):
    return F.round((F.col("_max_total").cast("double") / yesterday_day(as_of)) * F.col("_days"), 0)


def client_summary(pivot: DataFrame, window, as_of) -> DataFrame:
    """R2: per client and plan target over the window, with a month-end forecast."""
    g = _window(pivot, window).groupBy("client", "target_monthly").agg(
        F.sum("cm").alias("cm"), F.sum("rso").alias("rso"), F.sum("act").alias("act"),
        F.max("total").alias("_max_total"), F.sum("dp").alias("dp"),
        _days_at_max_total().alias("_days"))
    return g.select("client", "cm", "rso", "act", F.col("_max_total").alias("total"), "dp",
                    _forecast_without_dp(as_of).alias("forecast_without_dp"), "target_monthly")


def daily_stats(pivot: DataFrame, window) -> DataFrame:
    """Per day, sums and the sum of per-client shares of the monthly total.

    The shares are added exactly and rounded once, so the result does not follow the partitioning.
    """
    def share(c):
        return F.try_divide(F.col(c).cast("double"), F.col("total_with_dp"))
    g = exact_sums(_window(pivot, window), ["date"], {f"pct_{c}_from_total": share(c) for c in ("rso", "act", "dp")},
                   sums=["cm", "rso", "act", "dp"])
    total = F.col("cm") + F.col("rso") + F.col("act") + F.col("dp")
    return g.select("date", total.alias("total_with_dp"), "cm", "rso", "act", "dp",
                    "pct_rso_from_total", "pct_act_from_total", "pct_dp_from_total")


def plan_fact(pivot: DataFrame, spr_client: DataFrame, window, as_of) -> DataFrame:
    """Plan versus fact for utilisation clients, with the daily need."""
    util = spr_client.filter(F.col("is_util") == 1).select("client")
    v = _window(pivot, window).join(util, "client", "left_semi")
    g = v.groupBy("client", "target_monthly").agg(
        F.sum("cm_rso_act").alias("fact"),
        F.sum(F.col("rso") + F.col("act")).alias("fact_rso"),
        F.max("total").alias("_max_total"), _days_at_max_total().alias("_days"))
    yday = yesterday_day(as_of)
    plan, fact, fact_rso = F.col("plan"), F.col("fact"), F.col("fact_rso")
    out = g.select("client", F.col("target_monthly").alias("plan"), "fact", "fact_rso",
                   _forecast_without_dp(as_of).alias("forecast_without_dp"))
    plan_rso = plan - F.col("forecast_without_dp")
    out = out.withColumn("plan_rso", plan_rso)
    left = F.col("plan_rso") - fact_rso
    return out.select(
        "client", "plan", "fact", "forecast_without_dp",
        (F.try_divide(fact.cast("double"), plan) - 1).alias("pf_diff"),
        F.when(plan - fact < 0, F.lit(0.0)).otherwise((plan - fact).cast("double") / yday)
        .alias("need_cases_per_day"),
        "plan_rso", "fact_rso",
        F.try_divide(fact_rso.cast("double"), F.col("plan_rso")).alias("pf_rso_diff"),
        F.when(left < 0, F.lit(0.0)).otherwise(left / yday).alias("need_rso_per_day"))


PIVOT_VIEW = "reports_daily_pivot_v"


def register_pivot_view(pivot: DataFrame, name: str = PIVOT_VIEW) -> str:
    """Expose the daily pivot as a session view for SQL report queries.

    The view is the lazy plan, recomputed on each read like the original view.
    """
    pivot.createOrReplaceTempView(name)
    return name
