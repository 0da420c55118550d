"""Sums of doubles that do not depend on order (A8), rounded once.

A finite double is a whole number times a power of two. The exponents are cut
into bins of ``WIDTH``; inside a bin every value is a whole number of the bin's
unit that fits a long, and whole numbers are added exactly, in any order and
with map-side partial sums (as decimals, for up to 10**19 rows). The few bins
of a group are then added exactly and rounded once, to the nearest double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WIDTH = 8
#: Bins of values that are no finite number.
_NAN, _PLUS, _MINUS = 1_000_000, 1_000_001, 1_000_002


def _split(x: Column) -> tuple[Column, Column]:
    """(bin, whole units in the bin) of a double; a null value has neither."""
    # one below the exponent: the logarithm may be off by one next to a power of two
    low = F.floor(F.log2(F.abs(x))) - 1
    bin_ = F.floor(low / F.lit(WIDTH)).cast("int")
    shift = F.lit(52) - bin_ * WIDTH
    half = F.floor(shift / F.lit(2))
    # powers of two scale exactly; two of them, so that neither is out of range
    units = x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), shift - half)
    odd = (F.when(F.isnan(x), _NAN).when(x == float("inf"), _PLUS).when(x == float("-inf"), _MINUS)
           .when(x == 0, 0))
    return (F.when(x.isNotNull(), F.coalesce(odd, bin_)),
            F.when(x.isNotNull(), F.when(x == 0, F.lit(0)).when(odd.isNotNull(), F.lit(1))
                   .otherwise(units.cast("long"))))


def _rounded(bins) -> float | None:
    total, seen = 0, set()
    floor = -200 * WIDTH                        # below the least bin
    for bin_, units in bins or []:
        if bin_ is None:
            continue
        seen.add(bin_)
        if bin_ < _NAN:
            total += int(units) << (bin_ * WIDTH - floor)
    if not seen:
        return None
    if _NAN in seen or {_PLUS, _MINUS} <= seen:
        return float("nan")
    if _PLUS in seen or _MINUS in seen:
        return float("inf" if _PLUS in seen else "-inf")
    try:
        return total / (1 << (52 - floor))      # whole numbers divide with one correct rounding
    except OverflowError:
        return float("inf" if total > 0 else "-inf")


def exact_sums(df: DataFrame, keys, values: dict[str, Column], sums=()) -> DataFrame:
    """Per group of ``keys``: the exactly rounded sum of each of ``values``, and plain sums of ``sums``.

    Nulls are left out; a group with nulls only has the sum null. NaN, or both
    infinities, give NaN; one infinity gives itself, and so does a sum past the largest
    double. One pass: rows are first added per group and combination of bins,
    then per group. ``sums`` are whole-number columns that keep their names.
    """
    keys, names = list(keys), list(values)
    split = {n: _split(v.cast("double")) for n, v in values.items()}
    rows = df.select(*keys, *sums, *[c.alias(f"_{k}_{i}") for i, n in enumerate(names)
                                     for k, c in zip("bu", split[n])])
    part = rows.groupBy(*keys, *[f"_b_{i}" for i in range(len(names))]).agg(
        *[F.sum(F.col(f"_u_{i}").cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"_u_{i}")
          for i in range(len(names))],
        *[F.sum(c).alias(c) for c in sums])
    lists = part.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.collect_list(F.struct(F.col(f"_b_{i}").alias("b"), F.col(f"_u_{i}").alias("u"))).alias(f"_l_{i}")
          for i in range(len(names))])
    rounded = F.udf(_rounded, "double", useArrow=True)
    return lists.select(*keys, *sums, *[rounded(f"_l_{i}").alias(n) for i, n in enumerate(names)])
