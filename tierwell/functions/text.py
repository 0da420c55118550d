"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# fixed value: citation/link marker pattern, greedy ("a[1] b [2]c" -> "ac")
CITATION_PATTERN = r"\[.*\]"
# '.' stops only at '\n' in the original regex engine; Java's UNIX_LINES flag
# (?d) gives the same (by default Java also stops at '\r', U+0085, U+2028/9)
_JAVA_PATTERN = "(?d)" + CITATION_PATTERN


def strip_citations(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, _JAVA_PATTERN, "")


def strip_citations_df(df: DataFrame) -> DataFrame:
    """Apply :func:`strip_citations` to every string column, others untouched."""
    return df.select([
        strip_citations(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
