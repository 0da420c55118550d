"""Keyed upserts (M2, M3) and surrogate keys (M7) on immutable snapshots.

``insert_new``  - "on conflict do nothing": source keys not yet present are
                  appended, existing rows are untouched.
``upsert``      - "on conflict do update": matched rows take the source
                  value of every column in ``update_cols`` and keep the rest
                  (insert-only columns, the surrogate id); unmatched source
                  rows are appended; untouched rows are unchanged. Where no column
                  and no id is kept, matched rows are the source's rows: only
                  keys are compared, and neither side's rows move for it.

Both return the whole new table (the caller writes it as the next snapshot).
The source is first reduced to one row per key (deterministically: the
greatest row wins), so a duplicated source key never duplicates the target.
When there is a target to compare with, the reduced source is written once
and both the update and the insert read that table; whether a side of those
joins is broadcast follows from the byte sizes of the stored tables.

Surrogate ids continue after the current maximum, in natural-key order. The
numbering is distributed: range-partition and sort the new keys, count the
rows of each partition, and add each row's position inside its partition to
the rows before it. There is no single-partition step and no size from which
it changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import known_empty, materialize
from .bloom import bloom_filter, maybe_in


def max_id(dst: DataFrame, id_col: str) -> int:
    """Current maximum surrogate id (0 for an empty table); one scalar."""
    value = dst.agg(F.max(id_col)).first()[0]
    return int(value or 0)


def numbered(df: DataFrame, order_cols, out: str = "id") -> DataFrame:
    """Add ``out`` = 1, 2, ... in ascending ``order_cols`` order (NULLs first).

    ``order_cols`` must identify a row for the numbering to be deterministic.
    The ordered rows are written once, so the partition-dependent positions
    are evaluated exactly once; only one count per partition is collected.
    """
    order_cols = list(order_cols)
    ranged = materialize(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                         .withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    counts = {r["p"]: r["n"] for r in
              ranged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(p, 0)
    start = F.get(F.array(*[F.lit(b).cast("long") for b in before or [0]]), part.cast("int"))
    inside = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn(out, (start + inside + 1).cast("long")).drop("_m")


def assign_ids(df: DataFrame, order_cols, start: int = 0, id_col: str = "id") -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... in ascending ``order_cols`` order."""
    return numbered(df, order_cols, id_col).withColumn(id_col, F.col(id_col) + F.lit(int(start)))


def one_per_key(src: DataFrame, keys) -> DataFrame:
    """One row per key: the greatest by the remaining columns (NULLs lowest)."""
    keys = list(keys)
    rest = [c for c in src.columns if c not in keys]
    if not rest:
        return src.select(*keys).distinct()
    return (src.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def newest_of_colliding(df: DataFrame, keys: dict[str, Column], order: list[str]) -> DataFrame:
    """Keep one row per key (``order`` descending, NULLs last) where keys collide.

    For wide rows whose keys hardly ever collide: the keys are counted without
    the rest of the row, and only rows under colliding keys are compared. The
    wide rows themselves are filtered against that table, not reduced, so they
    move only if Spark finds the table too large to broadcast. The order must
    tell rows apart.
    """
    named = df.select(*[c.alias(k) for k, c in keys.items()], *order)
    often = materialize(named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                        .select(*keys))
    # only rows that may be under such a key are moved; an inner join, since Spark would move a
    # semi join below the filter
    hashed = F.xxhash64(*keys)
    first = materialize(maybe_in(named, hashed, bloom_filter(often, hashed)).join(often, list(keys)).groupBy(*keys)
                        .agg(F.max(F.struct(*order)).alias("_first"))
                        .select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_first"))
    match = None
    for k, c in keys.items():
        same = c == F.col(f"_c_{k}")
        match = same if match is None else match & same
    return (df.join(first, match, "left")
            .filter(F.col("_first").isNull() | F.col("_first").eqNullSafe(F.struct(*order)))
            .drop("_first", *[f"_c_{k}" for k in keys]))


def _prepared(dst: DataFrame, src: DataFrame, keys, src_unique: bool) -> DataFrame:
    src = src if src_unique else one_per_key(src, keys)
    # an empty target needs one evaluation only; else the source is written once
    return src if known_empty(dst) else materialize(src)


def _new_rows(dst: DataFrame, src: DataFrame, keys, id_col, order_cols, start):
    new = src if known_empty(dst) else src.join(dst.select(*keys), list(keys), "left_anti")
    if id_col is None:
        return new
    if start is None:
        start = 0 if known_empty(dst) else max_id(dst, id_col)
    return assign_ids(new, order_cols or keys, start, id_col)


def insert_new(dst: DataFrame, src: DataFrame, keys, id_col: str | None = "id",
               order_cols=None, src_unique: bool = False, start: int | None = None) -> DataFrame:
    """M2: append source rows whose key is not in ``dst``.

    ``start`` is the current maximum id when the caller knows it; otherwise
    it is read from ``dst``.
    """
    keys = list(keys)
    src = _prepared(dst, src, keys, src_unique)
    new = _new_rows(dst, src, keys, id_col, order_cols, start)
    return dst.unionByName(new.select(*dst.columns))


def _replaced(dst: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """``dst`` with the rows of each key of ``src`` replaced by the source's row, other source rows appended."""
    held = dst.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # keys whose row is not simply replaced: without a source row, or held several times
    odd = materialize(held.join(src.select(*keys, F.lit(True).alias("_hit")), keys, "left")
                      .where("_hit is null or _n > 1").select(*[F.col(k).alias(f"_o_{k}") for k in keys], "_hit", "_n"))
    alone, often = odd.where("_hit is null"), odd.where("_hit")
    null_safe, same = F.lit(True), F.lit(True)
    for k in keys:
        null_safe, same = null_safe & F.col(k).eqNullSafe(F.col(f"_o_{k}")), same & (F.col(k) == F.col(f"_o_{k}"))
    new = src.select(*dst.columns)
    if not often.isEmpty():
        new = new.join(often, same, "left").select(*dst.columns, F.explode_outer(
            F.when(F.col("_hit"), F.sequence(F.lit(1).cast("long"), F.col("_n"))))).select(*dst.columns)
    return dst.join(alone, null_safe, "left_semi").unionByName(new)


def upsert(dst: DataFrame, src: DataFrame, keys, update_cols, id_col: str | None = "id",
           order_cols=None, src_unique: bool = False, start: int | None = None) -> DataFrame:
    """M3: update ``update_cols`` of matched keys, append unmatched source rows.

    Without an id, and with every column updated, the source is read twice (the first time
    its keys only) and not written.
    """
    keys = list(keys)
    update_cols = [c for c in update_cols if c not in keys]
    if id_col is None and {*keys, *update_cols} == set(dst.columns) and not known_empty(dst):
        return _replaced(dst, src if src_unique else one_per_key(src, keys), keys)
    src = _prepared(dst, src, keys, src_unique)
    new = _new_rows(dst, src, keys, id_col, order_cols, start).select(*dst.columns)
    if known_empty(dst):
        return dst.unionByName(new)
    changes = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in update_cols],
                         F.lit(True).alias("_hit"))
    kept = dst.join(changes, keys, "left").select(*[
        F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
        if c in update_cols else F.col(c)
        for c in dst.columns
    ])
    return kept.unionByName(new)
