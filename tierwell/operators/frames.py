"""GROUPS frames, which Spark SQL does not offer as a frame clause.

``groups_frame`` is the general operator. ``previous_group_first`` and
``previous_value`` answer the reports' case, ``first_value(x) over (partition by
p order by o groups between 1 preceding and current row)`` for values that are
constant within a peer group: the value of the *previous peer group* (rows
with the previous distinct value of ``o``), or of the current group for the
first one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .merge import numbered


def previous_group_first(df: DataFrame, partition, order: str, cols,
                         suffix: str = "_prev") -> DataFrame:
    """Add ``<col><suffix>``: value of the first row of the previous peer group.

    Peer groups are first reduced to one row (with map-side combining), the
    previous group's value is taken on that table, and the result joins back
    to the rows; a partition with very many rows is never one task. Rows
    inside one peer group have no order, so ``cols`` should be constant within
    a group (as in the reports, where they are group totals); otherwise the
    least value stands for the group. NULL partitions and orders form groups
    like any value.
    """
    partition = [partition] if isinstance(partition, str) else list(partition)
    keys = [*partition, order]
    groups = df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in cols])
    prior = previous_value(groups, partition, order, cols, suffix).select(
        *[F.col(k).alias(f"_g_{k}") for k in keys], *[f"{c}{suffix}" for c in cols])
    match = None
    for k in keys:
        same = df[k].eqNullSafe(prior[f"_g_{k}"])
        match = same if match is None else match & same
    return df.join(prior, match, "left").drop(*[f"_g_{k}" for k in keys])


def previous_value(per_group: DataFrame, partition, order: str, cols, suffix: str = "_prev"):
    """Same answer on a table with one row per (partition, order) group.

    ``lag`` with the group's own value as the default for the first group.
    This is the form the reports use: the group table is small (clients x
    months), so the window runs on it instead of on the detail rows.
    """
    partition = [partition] if isinstance(partition, str) else list(partition)
    w = Window.partitionBy(*partition).orderBy(order)
    out = per_group
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.lag(c).over(w), F.col(c)))
    return out


#: Groups per block of the distributed frame.
BLOCK = 100_000
_COMBINE = {"sum": lambda a, b: F.coalesce(a + b, a, b), "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
            "min": F.least, "max": F.greatest, "first": F.coalesce, "last": lambda a, b: F.coalesce(b, a)}


def groups_frame(df: DataFrame, partition, order: str, outs: dict[str, tuple], preceding: int | None = 0,
                 following: int | None = 0, block: int = BLOCK) -> DataFrame:
    """Add ``<out> = f(col) over (partition by .. order by .. groups between n preceding and m following)``.

    ``outs``: name -> (function, column) for sum, count, min and max, or (function,
    column, tie columns) for first and last, where the tie columns order the rows
    inside a peer group and make the answer definite. ``None`` as a bound is
    "unbounded". NULL partitions and orders form groups like any value; NULLs come
    first in every order. Sums of doubles follow the usual rounding.

    Peer groups are reduced to one row each (map-side), numbered in order by range
    partitions, and cut into blocks of ``block`` consecutive groups. A group within
    reach of a neighbouring block's frames is copied to it, so that each block answers
    on its own; what an unbounded frame has before or after the block is carried
    in from one row per (partition, block). A partition with a third of all rows,
    or of all groups, is therefore spread over many tasks.
    """
    partition = [partition] if isinstance(partition, str) else list(partition)
    keys = [f"_p{i}" for i in range(len(partition))] + ["_o"]
    named = df.select(*[F.col(c).alias(k) for c, k in zip([*partition, order], keys)], *df.columns)
    per_group = []
    for i, (fn, col, *tie) in enumerate(outs.values()):
        if fn in ("first", "last"):
            row = F.struct(*tie[0], F.struct(F.col(col).alias("v")).alias("_v"))
            per_group.append((F.min if fn == "first" else F.max)(row).alias(f"_a{i}"))
        else:
            per_group.append(getattr(F, fn)(col).alias(f"_a{i}"))
    groups = named.groupBy(*keys).agg(*per_group)
    # a struct around the value tells "no row yet" from "its value is null"
    groups = groups.select(*keys, *[F.col(f"_a{i}._v").alias(f"_a{i}") if fn in ("first", "last") else F.col(f"_a{i}")
                                    for i, (fn, *_) in enumerate(outs.values())])
    framed = _frame(numbered(groups, keys, "_g"), keys, [fn for fn, *_ in outs.values()], preceding, following, block)
    answers = framed.select(*[F.col(k).alias(f"_j{k}") for k in keys], *[
        (F.col(f"_r{i}.v") if fn in ("first", "last") else F.col(f"_r{i}")).alias(out)
        for i, (out, (fn, *_)) in enumerate(outs.items())])
    match = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_j{k}"))
        match = same if match is None else match & same
    return named.join(answers, match).select(*df.columns, *outs)


def _frame(groups: DataFrame, keys, fns, preceding, following, block: int) -> DataFrame:
    p = keys[:-1]
    back, ahead = preceding or 0, following or 0
    own = F.expr(f"(_g - 1) div {block}")
    reach = F.sequence(F.expr(f"greatest(0, _g - 1 - {ahead}) div {block}"), F.expr(f"(_g - 1 + {back}) div {block}"))
    copies = groups.withColumn("_own", own).withColumn("_block", F.explode(reach))
    frame = Window.partitionBy("_block", *p).orderBy("_g").rowsBetween(
        Window.unboundedPreceding if preceding is None else -back,
        Window.unboundedFollowing if following is None else ahead)

    def over(fn, col, w):
        if fn == "first":
            return F.first(col).over(w)
        return (F.last(col) if fn == "last" else F.sum(col) if fn == "count" else getattr(F, fn)(col)).over(w)

    local = copies.select("*", *[over(fn, f"_a{i}", frame).alias(f"_r{i}") for i, fn in enumerate(fns)])
    local = local.where("_block = _own")
    if preceding is not None and following is not None:
        return local
    # one row per (partition, block): what lies before and after it
    whole = groups.withColumn("_block", own).groupBy(*p, "_block").agg(*[
        {"first": F.min_by, "last": F.max_by}[fn](f"_a{i}", "_g").alias(f"_t{i}") if fn in ("first", "last")
        else (F.sum if fn == "count" else getattr(F, fn))(f"_a{i}").alias(f"_t{i}") for i, fn in enumerate(fns)])
    order = Window.partitionBy(*p).orderBy("_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    carried = whole.select(*[F.col(k).alias(f"_c{k}") for k in p], F.col("_block").alias("_cb"),
                           *[over(fn, f"_t{i}", before).alias(f"_b{i}") for i, fn in enumerate(fns)],
                           *[over(fn, f"_t{i}", after).alias(f"_f{i}") for i, fn in enumerate(fns)])
    match = F.col("_block") == F.col("_cb")
    for k in p:
        match = match & F.col(k).eqNullSafe(F.col(f"_c{k}"))
    out = local.join(carried, match)
    for i, fn in enumerate(fns):
        value = F.col(f"_r{i}")
        if preceding is None:
            value = _COMBINE[fn](F.col(f"_b{i}"), value)
        if following is None:
            # the frame reaches the block's last group, and the copies of later ones are part of the carry
            value = _COMBINE[fn](value, F.col(f"_f{i}"))
        out = out.withColumn(f"_r{i}", value)
    return out
