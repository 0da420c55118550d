"""Batch table copy (S6) with a post-copy row count check.

Each listed table is read from the source and overwrites the target; the
result is one reconciliation row per table. Source and target each have a
format and options of their own, used for the read, the write and the read
back, so a copy may change the kind of store. ``{table}`` in an option stands
for the table's name (for sources that name the table in an option).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .store import checksum, write_checked, write_counted


def _options(options: dict | None, table: str) -> dict:
    return {k: v.replace("{table}", table) if isinstance(v, str) else v
            for k, v in (options or {}).items()}


def copy_tables(spark: SparkSession, tables, src_base: str, dst_base: str,
                src_fmt: str = "parquet", dst_fmt: str = "parquet", src_suffix: str = ".parquet",
                src_options: dict | None = None, dst_options: dict | None = None) -> DataFrame:
    out = []
    for t in tables:                         # the list of table names, not data
        read, write = _options(src_options, t), _options(dst_options, t)
        df = spark.read.format(src_fmt).options(**read).load(f"{src_base}/{t}{src_suffix}")
        written = write_counted(df, f"{dst_base}/{t}", fmt=dst_fmt, options=write)
        back = spark.read.format(dst_fmt).options(**write).load(f"{dst_base}/{t}").count()
        out.append((t, written, back))
    return spark.createDataFrame(out, "table_name string, rows_written long, rows_read long")


def copy_tables_checked(spark: SparkSession, tables, src_base: str, dst_base: str,
                        src_fmt: str = "parquet", dst_fmt: str = "parquet", src_suffix: str = ".parquet",
                        src_options: dict | None = None, dst_options: dict | None = None) -> DataFrame:
    """``copy_tables`` with a check of the content: (table_name, rows_written, rows_read, content_equal).

    The rows' checksum is observed while they are written and computed again
    from what the target gives back under the same schema, so a changed cell
    shows although the counts agree.
    """
    out = []
    for t in tables:                         # the list of table names, not data
        read, write = _options(src_options, t), _options(dst_options, t)
        df = spark.read.format(src_fmt).options(**read).load(f"{src_base}/{t}{src_suffix}")
        written = write_checked(df, f"{dst_base}/{t}", fmt=dst_fmt, options=write)
        back = content_of(spark, f"{dst_base}/{t}", df.schema, dst_fmt, write)
        out.append((t, written["n"], back["n"], written == back))
    return spark.createDataFrame(out, "table_name string, rows_written long, rows_read long, content_equal boolean")


def content_of(spark: SparkSession, path: str, schema, fmt: str = "parquet", options: dict | None = None) -> dict:
    """The checksum of a stored table, read under ``schema``."""
    back = spark.read.schema(schema).format(fmt).options(**(options or {})).load(path)
    return back.agg(*checksum(schema.fieldNames())).head().asDict()
