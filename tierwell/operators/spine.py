"""Date spine (U5) and plan validity intervals by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import as_date, end_of_month, month_label


def date_spine(spark: SparkSession, start, as_of) -> DataFrame:
    """Every day from ``start`` to the last day of ``as_of``'s month, with its month."""
    days = spark.range(1).select(F.explode(F.sequence(as_date(start), end_of_month(as_of)))
                                 .alias("date"))
    return days.select("date", month_label(F.col("date")).alias("month"))


def spine_of(df: DataFrame, date_col: str) -> DataFrame:
    """The spine that covers a table's dates: first day to the end of the last month.

    The bounds are one aggregated row; a table without dates gives no days.
    """
    ends = df.agg(F.min(date_col).cast("date").alias("lo"), F.last_day(F.max(date_col)).alias("hi"))
    days = ends.filter(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.select("date", month_label(F.col("date")).alias("month"))


def plan_by_day(plan: DataFrame, start, as_of) -> DataFrame:
    """(date, month, client, target_monthly) for each spine day inside a plan interval.

    Intervals are half-open ``[effective_from, effective_to)``; NULL bounds and
    empty intervals give no days (``sequence`` would count downwards). Each
    interval is clipped to the spine before it is exploded, so the output is
    bounded by plans x spine days and overlapping plans yield one row each.
    """
    lo = F.greatest(F.col("effective_from"), as_date(start))
    hi = F.least(F.date_sub(F.col("effective_to"), 1), end_of_month(as_of))
    valid = (plan.filter(F.col("effective_from").isNotNull() & F.col("effective_to").isNotNull())
             .filter(lo <= hi))
    days = valid.select("client", F.col("target").alias("target_monthly"),
                        F.explode(F.sequence(lo, hi)).alias("date"))
    return days.select("date", month_label(F.col("date")).alias("month"), "client",
                       "target_monthly")

