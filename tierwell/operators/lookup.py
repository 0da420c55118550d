"""The dimension lookups used by the star joins.

A lookup joins a two-column ``(key, id)`` projection of a stored dimension.
The dimensions are stored tables, so Spark knows the bytes of the two columns.

``star_lookup`` resolves many roles of one fact. Dimensions below Spark's
broadcast threshold are looked up one after another without moving the fact.
All larger ones are resolved together, whatever their number: the fact's codes
are unpivoted to narrow rows (key, role, code), joined once with the united
dimensions, and pivoted back to one row of ids per key. That takes three
shuffles of fact size (codes, ids, fact), not one of the whole fact per role. The
codes are salted by the fact's key, so a code under a third of all rows is spread
over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def dim_pairs(dim: DataFrame, key: str, value: str = "id", reduce_max: bool = False) -> DataFrame:
    """Two-column ``(key, value)`` projection of a dimension.

    ``reduce_max`` keeps one value per key (the highest) for dimensions whose
    lookup column is not unique on its own (city names exist per country);
    without it such a lookup would multiply fact rows. It also tells Spark that
    the key is unique, so that a lookup whose id is not read is left out of the plan.
    """
    d = dim.select(F.col(key).alias("_k"), F.col(value).alias("_v")).filter(F.col("_k").isNotNull())
    return d.groupBy("_k").agg(F.max("_v").alias("_v")) if reduce_max else d


def lookup(fact: DataFrame, pairs: DataFrame, fact_col: str, out_col: str) -> DataFrame:
    """Left join ``fact[fact_col]`` to prepared ``pairs``; adds ``out_col``."""
    p = pairs.select(F.col("_k").alias(f"_k_{out_col}"), F.col("_v").alias(out_col))
    return (fact.join(p, fact[fact_col] == p[f"_k_{out_col}"], "left")
            .drop(f"_k_{out_col}"))


SALTS = 16


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes below which Spark broadcasts a side by itself (-1: never)."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def planned_bytes(df: DataFrame) -> int:
    """Spark's estimate of the rows' bytes; the stored bytes of the columns for a stored table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def star_lookup(fact: DataFrame, key: str, roles, pairs: dict[str, DataFrame]) -> DataFrame:
    """Add an id column per role; ``roles``: (fact column, name in ``pairs``, id column).

    ``key`` tells the fact's rows apart and is never null. ``pairs`` are made by
    ``dim_pairs`` and hold one value per key. Codes that a dimension lacks, and
    null codes, give null ids.
    """
    limit = broadcast_limit(fact.sparkSession)
    large = {name for name, p in pairs.items() if planned_bytes(p) > limit}
    for column, name, out in roles:
        if name not in large:
            fact = lookup(fact, pairs[name], column, out)
    rest = [r for r in roles if r[1] in large]
    return _one_pass(fact, key, rest, pairs) if rest else fact


def _one_pass(fact: DataFrame, key: str, roles, pairs: dict[str, DataFrame]) -> DataFrame:
    names = sorted({name for _, name, _ in roles})
    united = None
    for i, name in enumerate(names):
        part = pairs[name].select(F.lit(i).alias("_dim"), F.col("_k").cast("string").alias("_k"), "_v")
        united = part if united is None else united.unionByName(part)
    united = united.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    codes = fact.select(F.col(key).alias("_key"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("role"), F.lit(names.index(name)).alias("dim"), F.col(c).cast("string").alias("code"))
        for n, (c, name, _) in enumerate(roles)])).alias("_c"))
    codes = (codes.where(F.col("_c.code").isNotNull())
             .select("_key", F.col("_c.role").alias("_role"), F.col("_c.dim").alias("_dim"),
                     F.col("_c.code").alias("_k"), F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int").alias("_salt")))
    found = codes.join(united, ["_dim", "_k", "_salt"])
    ids = found.groupBy("_key").agg(*[F.max(F.when(F.col("_role") == n, F.col("_v"))).alias(out)
                                      for n, (_, _, out) in enumerate(roles)])
    return fact.join(ids, fact[key] == ids["_key"], "left").drop("_key")
