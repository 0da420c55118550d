"""Upkeep of the daily pivot (R1) from the changes of the request fact.

A load of the fact leaves a *change feed*: the rows that differ, their old form
with sign -1 and their new form with +1. Counts per (client, day) are sums, so the
feed's signed counts are added to the stored ones; only (client, month)s
that the feed touches are totalled again; and only pivot rows are made anew
whose month was touched, whose previous month's total moved, or whose client
changed its utilisation flag. The fact is not read.

The stored counts cover all days, so that a later ``as_of`` only adds the days
that the longer spine covers now.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import as_date, end_of_month, month_label
from ..session import materialize
from . import reports

FEED = ["request_number", "added_dt", "spr_act_id", "spr_rso_id"]
_KEYS = ["client", "month"]


def row_changes(old: DataFrame, new: DataFrame, key: str, columns) -> DataFrame:
    """(columns, sign): rows of two snapshots of a table that are not alike in ``columns``.

    ``key`` is unique and not null in either. One join of the narrow columns.
    """
    rest = [c for c in columns if c != key]
    side = lambda df, s: df.select(F.col(key).alias(f"_{s}"), F.struct(*rest).alias(f"_{s}v"))
    pairs = (side(old, "o").join(side(new, "n"), F.col("_o") == F.col("_n"), "full_outer")
             .where(~F.col("_ov").eqNullSafe(F.col("_nv"))))
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col("_o").alias("k"), F.col("_ov").alias("v")),
                   F.struct(F.lit(1).alias("sign"), F.col("_n").alias("k"), F.col("_nv").alias("v")))
    return (pairs.select(F.explode(both).alias("c")).where("c.k is not null")
            .select(F.col("c.k").alias(key), *[F.col(f"c.v.{c}").alias(c) for c in rest], F.col("c.sign").alias("sign"))
            .select(*columns, "sign"))


@dataclass(frozen=True)
class PivotState:
    """What one load leaves for the next: stored tables, and the clocks they were made for."""

    counts: DataFrame       # date, client, cm, rso, act, dp: all days of the fact
    totals: DataFrame       # client, month, totals and previous totals
    pivot: DataFrame
    clients: DataFrame      # client, is_util
    start: object
    as_of: object


def _spine(counts: DataFrame, start, as_of) -> DataFrame:
    return counts.where(F.col("date").between(as_date(start), end_of_month(as_of)))


def _clients(spr_client: DataFrame) -> DataFrame:
    return spr_client.select("client", "is_util")


def build(fct_request: DataFrame, spr_client: DataFrame, spr_act: DataFrame, plan: DataFrame, start,
          as_of) -> PivotState:
    """The state from the whole fact (first load, or after a change of the plan)."""
    counts = materialize(reports.day_counts(fct_request, spr_act))
    base = reports.with_target(reports.metrics_of(_spine(counts, start, as_of), spr_client), plan)
    totals = materialize(reports.with_previous(reports.month_totals(base)))
    return PivotState(counts, totals, materialize(reports.pivot_rows(base, totals)), materialize(_clients(spr_client)),
                      start, as_of)


def apply(state: PivotState, feed: DataFrame, spr_client: DataFrame, spr_act: DataFrame, plan: DataFrame,
          as_of=None) -> PivotState:
    """The state after a load, from its change feed; the same rows as a new ``build``.

    The plan must be the one that the state was built with. ``as_of`` may move on.
    """
    as_of = state.as_of if as_of is None else as_of
    delta = materialize(reports.day_counts(feed, spr_act, sign="sign"))
    merged = (state.counts.unionByName(delta).groupBy("date", "client")
              .agg(*[F.sum(c).alias(c) for c in reports.COUNTS]))
    counts = materialize(merged.where(" or ".join(f"{c} <> 0" for c in reports.COUNTS)))
    month = month_label(F.col("date")).alias("month")
    # what has to be totalled again: touched by the feed, or covered by the spine only now, or no longer
    inside = lambda at: F.col("date").between(as_date(state.start), end_of_month(at))
    moved = counts.where(inside(as_of) != inside(state.as_of)).select("client", month)
    old, new = _clients(spr_client).alias("n"), state.clients.alias("o")
    flipped = (new.join(old, F.col("o.client") == F.col("n.client"), "full_outer")
               .where(~F.col("o.is_util").eqNullSafe(F.col("n.is_util")))
               .select(F.coalesce("n.client", "o.client").alias("client")))
    touched = materialize(delta.select("client", month).unionByName(moved).distinct())
    current = _spine(counts, state.start, as_of).withColumn("_month", month)

    def base_of(keys: DataFrame) -> DataFrame:
        k = keys.select(F.col("client").alias("_kc"), F.col("month").alias("_km"))
        rows = current.join(k, F.col("client").eqNullSafe(F.col("_kc")) & (F.col("_month") == F.col("_km")), "left_semi")
        return reports.with_target(reports.metrics_of(rows.drop("_month"), spr_client), plan)

    def without(df: DataFrame, keys: DataFrame) -> DataFrame:
        k = keys.select(F.col("client").alias("_kc"), F.col("month").alias("_km"))
        return df.join(k, F.col("client").eqNullSafe(F.col("_kc")) & (F.col("month") == F.col("_km")), "left_anti")

    plain = ["client", "month", "total", "total_with_dp"]
    again = reports.month_totals(base_of(touched))
    totals = materialize(reports.with_previous(without(state.totals, touched).select(*plain).unionByName(again)))
    # further months whose previous one moved, and all months of clients whose flag changed
    shifted = totals.join(state.totals, totals.columns, "left_anti").select(*_KEYS)
    whole = totals.join(flipped, "client", "left_semi").select(*_KEYS)
    affected = materialize(touched.unionByName(shifted).unionByName(whole).distinct())
    pivot = without(state.pivot, affected).unionByName(reports.pivot_rows(base_of(affected), totals))
    return PivotState(counts, totals, materialize(pivot), materialize(_clients(spr_client)), state.start, as_of)
