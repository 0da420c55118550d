"""Completeness gate (P3) and reject split.

One classification expression, two outputs that are exact complements:
``valid`` has every required column non-NULL, ``rejected`` has at least one
NULL among them. Both are lazy filters over the same input, so each is a
single scan with the predicate pushed to the parquet reader.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def is_complete(required) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])


def split_valid(df: DataFrame, required) -> tuple[DataFrame, DataFrame]:
    ok = is_complete(required)
    return df.filter(ok), df.filter(~ok)


def valid_rows(df: DataFrame, required) -> DataFrame:
    return df.filter(is_complete(required))


def rejected_rows(df: DataFrame, required) -> DataFrame:
    return df.filter(~is_complete(required))
