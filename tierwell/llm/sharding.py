"""Sharding by sampled splitters.

Records are range-partitioned on a key: the hash of the text, then the hash
of the id, then the record's own number, so equal texts lie together and yet
no key is indivisible. A sample drawn in proportion to size gives quantile
boundaries, between texts at first; the ranges are then measured, and a range
that turns out overfull (one text may hold a third of all rows) is sampled
again and subdivided inside the text. With the measured sums of the ranges
before it, each range places its own records exactly: the shard follows from
the running sum of bytes, the slot from the running count. Equal texts share
a shard unless they weigh more than a small part of one.

Only DataFrame operations are used. What the driver sees is the sample, the
sums of the ranges and those of the shards, all bounded by their numbers.
"""

from __future__ import annotations

from bisect import bisect_left

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import checkpointed

#: Records that one range holds about, least number of ranges, sampled records per range.
ROWS_PER_RANGE, LEAST_RANGES, SAMPLE_PER_RANGE = 250_000, 64, 32
#: Equal texts of at most this part of a shard's bytes are kept in one shard.
GROUP_SHARE = 0.005
_LOW = -(1 << 63)


def quantile_cuts(sample: list[tuple[tuple, float]], parts: int) -> list[tuple]:
    """Keys that cut a weighted sample into parts of like weight; ascending and distinct."""
    sample = sorted(sample)
    total, run, cuts = sum(w for _, w in sample), 0.0, []
    for key, weight in sample:
        if run and run >= total * (len(cuts) + 1) / parts:
            cuts.append(key)
        run += weight
        while len(cuts) + 1 < parts and run > total * (len(cuts) + 2) / parts:
            cuts.append(cuts[-1] if cuts else key)     # a heavy key takes several parts
    return sorted(set(cuts))


def range_of(key: Column, cuts: list[tuple], names: list[str], types: list[str]) -> Column:
    """How many cuts are at or below the key: a binary search in a literal array."""
    if not cuts:
        return F.lit(0)
    lit = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(c, names, types)]) for c in cuts])
    count, steps = len(cuts), [1 << k for k in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when((at + step <= count)
                                & (F.get(lit, F.least(at + step, F.lit(count)) - 1) <= key), at + step).otherwise(at))


def _sample(rows: DataFrame, share: Column, keys: list[str]) -> list[tuple[tuple, float]]:
    """Records drawn with probability ``share`` (repeatable); weight: share if it is over 1."""
    draw = F.pmod(F.xxhash64(*keys, F.lit(17)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    got = rows.select(*keys, share.alias("share")).where(draw < F.col("share")).collect()
    return [(tuple(r[k] for k in keys), max(1.0, r["share"])) for r in got]


def _choice(of: Column, table: dict[int, object], cast: str) -> Column:
    """The value that a small table (dense from 0) has for an integer column."""
    return F.get(F.array(*[F.lit(table[k]).cast(cast) for k in range(len(table))]), of)


def shard(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
          carry: list[str] | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` and the columns to carry, with shards of like bytes.

    A record's size is the UTF-8 bytes of its text plus 1 (null: no bytes).
    Shards are 0 to ``n_shards`` - 1, each within one record and
    ``GROUP_SHARE`` of an equal share of the bytes; slots run from 0 without
    gaps. Repeated rows, ties and null ids are placed like any others. An
    empty table gives an empty result. ``carry`` names further columns of the
    input that the records take along (for writing the shards).
    A very long text is read whole, by one task; nothing is cut off.
    """
    keys, types = ["__key", "__id", "__no"], ["long", "long", "long"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = checkpointed(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("__key"),
        F.xxhash64(F.col(id_col)).alias("__id"), F.monotonically_increasing_id().alias("__no"),
        *[F.col(c).alias(f"__carry_{c}") for c in carry or []]))
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).head()
    ranges = max(LEAST_RANGES, -(-count // ROWS_PER_RANGE))
    goal = max(1.0, total / ranges)
    key = F.struct(*keys)

    drawn = _sample(rows, F.col("size") * (SAMPLE_PER_RANGE / goal), keys) if count else []
    cuts = sorted({(k[0], _LOW, _LOW) for k in quantile_cuts(drawn, ranges)})

    def measured() -> tuple[DataFrame, dict[int, tuple[int, int]]]:
        ranged = rows.withColumn("__range", range_of(key, cuts, keys, types))
        sums = {r["__range"]: (r["b"], r["n"]) for r in
                ranged.groupBy("__range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
        return ranged, {k: sums.get(k, (0, 0)) for k in range(len(cuts) + 1)}

    ranged, sums = measured()
    for _ in range(3):      # subdivide overfull ranges, now also inside a text
        over = {k: b / goal for k, (b, n) in sums.items() if b > 2 * goal and n > 1}
        if not over:
            break
        drawn = _sample(ranged.where(F.col("__range").isin(list(over))),
                        F.col("size") * (2 * SAMPLE_PER_RANGE / goal), keys)
        by_range: dict[int, list] = {}
        for k, w in drawn:
            at = bisect_left(cuts, k)
            at += at < len(cuts) and cuts[at] == k
            by_range.setdefault(at, []).append((k, w))
        more = {c for k, part in by_range.items() if k in over
                for c in quantile_cuts(part, int(2 * over[k]) + 1)}
        if more <= set(cuts):
            break
        cuts = sorted({*cuts, *more})
        ranged, sums = measured()

    before_b, before_n, b, n = {}, {}, 0, 0
    for k in range(len(cuts) + 1):
        before_b[k], before_n[k] = b, n
        b, n = b + sums[k][0], n + sums[k][1]
    ordered = Window.partitionBy("__range").orderBy(*keys)
    same = Window.partitionBy("__range", "__key")
    start = _choice(F.col("__range"), before_b, "long") + F.sum("size").over(ordered) - F.col("size")
    placed = (ranged.withColumn("__start", start)
              .withColumn("__row", _choice(F.col("__range"), before_n, "long") + F.row_number().over(ordered) - 1)
              .withColumn("__group", F.sum("size").over(same))
              .withColumn("__first", F.min("__start").over(same)))
    middle = F.when(F.col("__group") <= int(GROUP_SHARE * total / n_shards), 2 * F.col("__first") + F.col("__group")) \
        .otherwise(2 * F.col("__start") + F.col("size"))
    at = F.least(F.floor(middle.cast("decimal(28,0)") * n_shards / (2 * max(1, total))).cast("int"),
                 F.lit(n_shards - 1))
    out = checkpointed(placed.select("doc_id", "size", "text_crc32", at.alias("shard"), "__row",
                                     *[f"__carry_{c}" for c in carry or []]))
    first = {r["shard"]: r["f"] for r in out.groupBy("shard").agg(F.min("__row").alias("f")).collect()}
    begin = _choice(F.col("shard"), {k: first.get(k, 0) for k in range(n_shards)}, "long")
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("__row") - begin).cast("int").alias("slot"),
                      *[F.col(f"__carry_{c}").alias(c) for c in carry or []])


_OWN = ("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the records as Parquet, one folder per shard (``shard=k``), with slot and size.

    All columns of the documents are kept. Where one has the name of a column
    of the operator, the operator's is written as ``shard_<name>``.
    """
    taken = [c for c in docs.columns if c in _OWN and c != id_col]
    aside = {c: f"aside_{uuid.uuid4().hex}" for c in taken if c != text_col}
    renamed = docs.withColumnsRenamed(aside)
    rest = [c for c in renamed.columns if c not in (id_col, *_OWN)]
    out = shard(renamed, n_shards, id_col, text_col, carry=rest)
    own = {c: next(n for n in (f"shard_{c}" + "_" * k for k in range(99)) if n not in docs.columns) for c in taken}
    out = out.withColumnsRenamed(own).withColumnsRenamed({v: k for k, v in aside.items()})
    out.write.partitionBy(own.get("shard", "shard")).parquet(path)


def digests(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
