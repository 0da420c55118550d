"""Versioned history load (M1): stamp, dedupe versions (W1), current flag.

The ODS table keeps every distinct version of an entity with the time it was
last delivered (``effective_from``) and a current-row flag (``is_active``):

1. the valid staging rows are stamped with the load clock ``as_of``;
2. they are appended to the history;
3. rows equal on the spec's dedupe columns collapse to the newest one
   (an unchanged re-delivery therefore moves ``effective_from`` forward, and
   columns outside the dedupe list take the newest value);
4. per entity key exactly one row is flagged active: the newest, ties broken
   by the change timestamp, then every other column, all descending with
   NULLs last (deterministic; the source database left ties open).

Scale notes. The stamped rows are stored once, bucketed by a hash of the
dedupe columns (96 bits tell versions apart) and written by the tasks that make them: the
wide rows are never shuffled or sorted by key, and an entity with millions of versions is spread
over all buckets. Everything else is narrow: (one shuffle, combined map-side) the newest
``(effective_from, change timestamp)`` per key with the hash of the version that has it, and in
each bucket the newest delivery of every version. Only keys with
several such versions, if there are any, look at the remaining columns; a Bloom filter of them drops
all others before they move. The flags go back to the buckets, where the wide
rows lie, and are stored there: the snapshot is the join of the two tables, bucket by bucket,
so the wide rows are written once. ``touched_only=True`` reprocesses only the history of keys that a Bloom
filter of the batch's keys lets pass, which is the same result because all steps stay
inside one entity key, and a key that passes by chance comes out as it was. The split
moves no row of the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..specs import EFFECTIVE_FROM, IS_ACTIVE, EntitySpec
from ..session import bucketed_table, empty_frame, materialize
from . import gate
from .bloom import bloom_filter, maybe_in, may_be_in

#: 2**20 words of 16 bytes: 16 MB, good for about eight million keys of a batch.
TOUCHED_WORDS = 1 << 20


def empty_ods(spark: SparkSession, spec: EntitySpec) -> DataFrame:
    schema = T.StructType(list(spec.schema.fields))
    for name in spec.derived:
        schema = schema.add(name, T.StringType(), True)
    schema = (schema.add(EFFECTIVE_FROM, T.TimestampNTZType(), True)
              .add(IS_ACTIVE, T.IntegerType(), True))
    return empty_frame(spark, schema)


def _with_derived(df: DataFrame, spec: EntitySpec) -> DataFrame:
    for name, build in spec.derived.items():
        df = df.withColumn(name, build())
    return df


def stamp(valid: DataFrame, spec: EntitySpec, as_of) -> DataFrame:
    """Valid staging rows as history rows of one load (``effective_from = as_of``).

    ``as_of`` is a literal timestamp, or a Column when several batches that
    were stamped at different times are merged in one pass.
    """
    from ..functions.dates import as_timestamp
    rows = valid.select(*spec.columns, as_timestamp(as_of).alias(EFFECTIVE_FROM))
    return _with_derived(rows, spec).select(*spec.ods_columns[:-1])


_HASH = ("_h1", "_h2")


def _version_hash(cols) -> list:
    """Two 64-bit hashes of the columns; NULLs are told apart from what they leave out."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(nulls, *cols).alias(_HASH[0]),
            F.xxhash64(*reversed(list(cols)), nulls, F.lit("v")).alias(_HASH[1])]


def _hashed_versions(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    residual = [c for c in spec.columns if c not in spec.dedupe]
    newest = F.max(F.struct(F.col(EFFECTIVE_FROM), *[F.col(c) for c in residual])).alias("_v")
    out = (rows.select(*spec.columns, EFFECTIVE_FROM, *_version_hash(spec.dedupe))
           .groupBy(*_HASH).agg(newest, F.first(F.struct(*spec.dedupe)).alias("_d"))
           .select(*_HASH, "_d.*", "_v.*"))
    return _with_derived(out.select(*_HASH, *spec.columns, EFFECTIVE_FROM), spec)


def dedupe_versions(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per distinct combination of the dedupe columns, newest wins."""
    return _hashed_versions(rows, spec).drop(*_HASH)


def _newest(versions: DataFrame, spec: EntitySpec) -> DataFrame:
    """(_key, version hash) of the versions with the newest (effective_from, change timestamp) of their key."""
    at = F.struct(F.col(EFFECTIVE_FROM), F.col(spec.change_ts))
    newest = versions.groupBy(F.col(spec.key).alias("_k")).agg(F.max(at).alias("_at"))
    # null-safe matches: no inferred not-null filter on one branch only, so all
    # branches share the one exchange of the versions
    return (versions.select(F.col(spec.key).alias("_key"), at.alias("_own"), *_HASH)
            .join(newest, F.col("_key").eqNullSafe(F.col("_k")) & F.col("_own").eqNullSafe(F.col("_at")))
            .select("_key", *_HASH))


def _counted(newest: DataFrame) -> DataFrame:
    return newest.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min(_HASH[0]).alias(_HASH[0]),
                                      F.min(_HASH[1]).alias(_HASH[1]))


def _decided(tied: DataFrame, spec: EntitySpec) -> DataFrame:
    """Hash of the winner of each key among whole rows that tie on the newest order."""
    rest = [c for c in spec.columns + list(spec.derived) if c != spec.change_ts]
    full = F.struct(F.col(EFFECTIVE_FROM), F.col(spec.change_ts), *[F.col(c) for c in rest], *_HASH)
    return (tied.groupBy(spec.key).agg(F.max(full).alias("_w"))
            .select(*[F.col(f"_w.{h}").alias(h) for h in _HASH]))


def _winners(versions: DataFrame, spec: EntitySpec) -> DataFrame:
    """Hash of the newest version of each entity key."""
    first = _counted(_newest(versions, spec))
    # several versions with the same newest order: the other columns decide
    tied = first.filter(F.col("_n") > 1).select(F.col("_key").alias("_tied"))
    decided = _decided(versions.join(tied, F.col(spec.key).eqNullSafe(F.col("_tied")), "left_semi"), spec)
    return first.filter(F.col("_n") == 1).select(*_HASH).unionByName(decided)


def flag_current(versions: DataFrame, spec: EntitySpec) -> DataFrame:
    """``is_active = 1`` on the newest version of each entity key.

    ``versions`` as made by the version dedupe, with the version hashes.
    """
    won = _winners(versions, spec).withColumn("_won", F.lit(1))
    return (versions.join(won, list(_HASH), "left")
            .withColumn(IS_ACTIVE, F.coalesce("_won", F.lit(0)).cast("int"))
            .select(*spec.ods_columns))


def merge_history(ods: DataFrame, stamped: DataFrame, spec: EntitySpec) -> DataFrame:
    """As ``merge_stored``, in one lazy plan that stores nothing: for small pieces, as it shuffles the wide rows."""
    rows = ods.select(*spec.ods_columns[:-1]).unionByName(stamped.select(*spec.ods_columns[:-1]))
    return flag_current(_hashed_versions(rows, spec), spec)


#: The column that rows are bucketed by, and 32 bits more that tell versions apart.
_BUCKET, _REST = "_h1", "_h3"


def _same(a: str, b: str):
    # no equality that Spark could take for a join key: the rows would leave their buckets for it
    return F.col(a).bitwiseXOR(F.col(b)) == 0


def stored_rows(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """The rows as a table bucketed by version hash, each with a number of its own (``_row``).

    The table lies in the shared checkpoint folder, as those of ``materialize`` do.
    """
    h1, h2 = _version_hash(spec.dedupe)
    numbered = rows.select(*spec.columns, EFFECTIVE_FROM, h1, h2.cast("long").bitwiseAND(F.lit(0xffffffff))
                           .alias(_REST), F.monotonically_increasing_id().alias("_row"))
    return bucketed_table(numbered, [_BUCKET])


def _kept(stored: DataFrame, spec: EntitySpec) -> DataFrame:
    """The row that each version keeps, the newest one: (bucket hash, row, effective_from, key, change timestamp)."""
    residual = [c for c in spec.columns if c not in spec.dedupe]
    order = F.struct(F.col(EFFECTIVE_FROM), *[F.col(c).alias(f"_r_{c}") for c in residual], F.col("_row"),
                     F.col(spec.key).alias("_key"), F.col(spec.change_ts).alias("_ts"))
    return (_with_derived(stored, spec).groupBy(_BUCKET, _REST).agg(F.max(order).alias("_v"))
            .select(_BUCKET, *[F.col(f"_v.{c}").alias(c) for c in ("_row", EFFECTIVE_FROM, "_key", "_ts")]))


def _settled(spec: EntitySpec) -> bool:
    """Whether all rows of a version agree in key and change timestamp."""
    return set(spec.columns) <= set(spec.dedupe) or {spec.key, spec.change_ts} <= set(spec.dedupe)


def _stored_winners(stored: DataFrame, spec: EntitySpec) -> DataFrame:
    """The newest version of each entity key: (bucket hash, 32 bits of the key)."""
    rows = _with_derived(stored, spec)
    # where a version's rows agree in key and change timestamp, its newest row decides, so that all
    # rows may be compared as they lie; else the one that each version keeps is found first
    each = (rows.select(_BUCKET, EFFECTIVE_FROM, F.col(spec.key).alias("_key"), F.col(spec.change_ts).alias("_ts"))
            if _settled(spec) else _kept(stored, spec))
    # the greatest and the least hash among the newest: they differ where several versions tie
    # (told by 64 bits; a tie overlooked would take two equal hashes under one key)
    top = each.groupBy("_key").agg(
        F.max(F.struct(EFFECTIVE_FROM, "_ts", _BUCKET)).alias("_most"),
        F.max(F.struct(EFFECTIVE_FROM, "_ts", F.bitwise_not(_BUCKET).alias("_not"))).alias("_least"))
    single = F.col(f"_most.{_BUCKET}") == F.bitwise_not(F.col("_least._not"))
    at = lambda *cols: F.xxhash64(*cols).alias("_at")
    # stored: 12 bytes a key, read by the branches below
    first = materialize(top.select(F.when(single, F.col(f"_most.{_BUCKET}")).alias("_won"), F.hash("_key").alias("_won_key"),
                                   F.when(~single, at("_key", f"_most.{EFFECTIVE_FROM}", "_most._ts")).alias("_at")))
    won = first.where(F.col("_won").isNotNull()).select("_won", "_won_key")
    tied = first.where(F.col("_at").isNotNull()).select("_at")
    if tied.isEmpty():
        return won
    bloom = bloom_filter(tied, F.col("_at"))
    # inner joins, since Spark would move a semi join below the filter
    if _settled(spec):
        rows = rows.withColumn("_at", at(spec.key, EFFECTIVE_FROM, spec.change_ts))
        rows = maybe_in(rows, F.col("_at"), bloom).join(tied.distinct(), "_at")
    else:
        maybe = maybe_in(each.select(_BUCKET, "_row", at("_key", EFFECTIVE_FROM, "_ts")), F.col("_at"), bloom)
        named = maybe.join(tied.distinct(), "_at").select(_BUCKET, F.col("_row").alias("_own"))
        rows = _with_derived(stored.join(named.hint("shuffle_hash"), _BUCKET).filter(_same("_row", "_own")), spec)
    # the other columns decide
    rest = [c for c in spec.columns + list(spec.derived) if c != spec.change_ts]
    full = F.struct(F.col(EFFECTIVE_FROM), F.col(spec.change_ts), *[F.col(c) for c in rest], _BUCKET)
    decided = (rows.groupBy(F.col(spec.key).alias("_key")).agg(F.max(full).alias("_w"))
               .select(F.col(f"_w.{_BUCKET}").alias("_won"), F.hash("_key").alias("_won_key")))
    return won.unionByName(decided)


def _named(stored: DataFrame, spec: EntitySpec) -> DataFrame:
    """The row that each version keeps: (bucket hash, row, 32 bits of the key)."""
    if not set(spec.columns) <= set(spec.dedupe):
        return _kept(stored, spec).select(_BUCKET, F.col("_row").alias("_own"), F.hash("_key").alias("_own_key"))
    # rows of a version differ in their delivery only: plain numbers, which are aggregated without a sort
    # (max_by leaves out rows without an order)
    newest = F.max_by("_row", F.coalesce(EFFECTIVE_FROM, F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00"))))
    return (_with_derived(stored, spec).groupBy(_BUCKET, _REST)
            .agg(newest.alias("_own"), F.max(F.hash(spec.key)).alias("_own_key")).drop(_REST))


def flag_stored(stored: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per version, ``is_active = 1`` on the newest of each entity key.

    ``stored`` as made by ``stored_rows``. The flags are stored in the same buckets, so the result
    may be read many times: each read joins the two tables bucket by bucket, and nothing is
    decided again. The wide rows are not written a second time.
    """
    won = _stored_winners(stored, spec)
    # the narrow sides are hashed bucket by bucket: the wide one is neither moved nor sorted; the joins
    # are on the bucket column alone, the rest is compared after it
    flags = bucketed_table(
        _named(stored, spec)
        .join(won.hint("shuffle_hash"), (F.col(_BUCKET) == F.col("_won")) & _same("_own_key", "_won_key"), "left")
        .select(_BUCKET, "_own", F.col("_won").isNotNull().cast("int").alias(IS_ACTIVE)), [_BUCKET])
    out = stored.join(flags.hint("shuffle_hash"), _BUCKET).filter(_same("_row", "_own"))
    return _with_derived(out, spec).select(*spec.ods_columns)


def merge_stored(ods: DataFrame, stamped: DataFrame, spec: EntitySpec) -> DataFrame:
    """The history with the stamped rows merged in, over rows stored in buckets (see above)."""
    rows = ods.select(*spec.ods_columns[:-1]).unionByName(stamped.select(*spec.ods_columns[:-1]))
    return flag_stored(stored_rows(rows, spec), spec)


def load_history(ods: DataFrame, staging: DataFrame, spec: EntitySpec, as_of,
                 touched_only: bool = False) -> DataFrame:
    """Full history load of one staging batch into the ODS snapshot ``ods``.

    Returns the new snapshot; the caller writes it as the next version (the
    table being read is never overwritten in place).
    """
    stamped = stamp(gate.valid_rows(staging, spec.required), spec, as_of)
    if not touched_only:
        return merge_stored(ods, stamped, spec)
    # the gated batch and the filter are written once. All rows of a key lie on one side, those
    # without a key on the untouched one; with far more keys than the filter can tell apart
    # everything is reprocessed, as in a full load
    stamped = materialize(stamped)
    bloom = materialize(bloom_filter(stamped, F.col(spec.key), TOUCHED_WORDS))
    marked = may_be_in(ods.select(*spec.ods_columns), F.col(spec.key), bloom, "_touched", TOUCHED_WORDS)
    touched, untouched = marked.filter("_touched"), marked.filter("not _touched")
    return untouched.select(*spec.ods_columns).unionByName(merge_stored(touched, stamped, spec))
