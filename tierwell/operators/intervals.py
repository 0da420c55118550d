"""Join of points with intervals that share no key.

An interval ``[lo, hi)`` of whole numbers is cut into dyadic cells, the fewest
aligned blocks of 2**k numbers that cover it exactly (at most two per level),
and a point lies in one block per level. Equality on (level, cell) then finds
every pair once: the cells of an interval do not overlap. The number of rows
grows with the logarithm of the longest interval, not with its length, and
the join is an ordinary shuffled one that AQE splits where a cell is crowded.
Spark does not see that the points are repeated per level and would broadcast
them by the bytes of their one column. So the cells of the intervals are stored:
they are broadcast if their bytes are under Spark's own threshold, and otherwise
both sides are shuffled; the points are never broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .lookup import broadcast_limit, planned_bytes


def _cells(lo: Column, hi: Column, levels: int) -> Column:
    """The dyadic cells that make up ``[lo, hi)``: array of (level, cell)."""
    def level(k):
        left = F.negative(F.call_function("shiftright", F.negative(lo), k))       # rounded up
        right = F.call_function("shiftright", hi, k)                              # rounded down
        odd = lambda x: x.bitwiseAND(F.lit(1).cast("long")) == 1
        cell = lambda ok, x: F.when((left < right) & ok, F.struct(k.alias("_level"), x.alias("_cell")))
        return F.array(cell(odd(left), left), cell(odd(right), right - 1))
    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), level))
    return F.filter(every, lambda c: c.isNotNull())


def interval_join(points: DataFrame, at: Column, intervals: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Every pair of a point and an interval with ``lo <= at < hi``, with the columns of both.

    ``at``, ``lo`` and ``hi`` are whole numbers (days, microseconds). Null points
    and bounds, and intervals with ``lo >= hi``, have no pairs; repeated rows pair
    each time. The two frames must not share a column name.
    """
    shared = set(points.columns) & set(intervals.columns)
    if shared:
        raise ValueError(f"both sides have the columns {sorted(shared)}")
    lo, hi, at = (c.cast("long") for c in (lo, hi, at))
    held = materialize(intervals.where(lo < hi))
    longest = held.agg(F.max(hi - lo)).head()[0]                # one number
    levels = int(longest or 1).bit_length()
    cut = materialize(held.select(*intervals.columns, F.explode(_cells(lo, hi, levels)).alias("_i")))
    cut = cut.hint("broadcast" if planned_bytes(cut) <= broadcast_limit(cut.sparkSession) else "merge")
    blocks = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(
        k.alias("_level"), F.call_function("shiftright", at, k).alias("_cell")))
    spread = points.where(at.isNotNull()).select(*points.columns, F.explode(blocks).alias("_p"))
    pairs = spread.join(cut, (F.col("_p._level") == F.col("_i._level")) & (F.col("_p._cell") == F.col("_i._cell")))
    return pairs.select(*points.columns, *intervals.columns)
