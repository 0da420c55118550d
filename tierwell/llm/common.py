"""Helpers shared by the corpus operators.

Texts are handed to Python tasks as Arrow batches and cut into *blocks* of
whole documents; a block is closed once it holds ``BLOCK_CHARS`` characters,
so a task's memory is bounded by one block plus its longest document.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

BLOCK_CHARS = 4_000_000
WORK_TABLE = "tierwell_work_"
_BASE = 0x9E3779B97F4A7C15          # odd, so invertible modulo 2**64
_STRETCH, _LONG = 1 << 18, 256       # symbols hashed at a time; longest span in the running sum
_powers: dict[str, np.ndarray] = {}


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder.

    The files survive lost executors, and Spark's context cleaner removes them
    when the frame is no longer referenced and the session asks for it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def colocated(df: DataFrame, key: str) -> DataFrame:
    """Write ``df`` once as a table bucketed by ``key`` and read it back.

    A later grouping or join on the key finds the rows where they are, with no
    shuffle of this side. The table lies in the shared checkpoint folder (its
    name starts with ``WORK_TABLE``) until ``drop_work_tables``.
    """
    spark = df.sparkSession
    name = f"{WORK_TABLE}{uuid.uuid4().hex}"
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    (df.write.format("parquet").option("compression", "none").option("path", folder)
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(name))
    return spark.table(name)


def drop_work_tables(spark: SparkSession) -> None:
    """Remove the tables of ``colocated``, once the results that read them are stored."""
    for table in spark.catalog.listTables(pattern=f"{WORK_TABLE}*"):
        folder = spark.sql(f"describe formatted {table.name}").where("col_name = 'Location'").head()
        spark.sql(f"drop table {table.name}")
        if folder:
            jvm = spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder.data_type)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so other columns never clash or travel."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def blocks(batches, limit: int = BLOCK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """Lists of (ids, texts) of whole documents from Arrow batches of two columns."""
    ids, texts, size = [], [], 0
    for batch in batches:
        # cut large Arrow batches before they become Python strings
        step = max(1, min(batch.num_rows, int(batch.num_rows * limit / max(1, batch.nbytes)) or 1))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids.append(i)
                texts.append(t or "")
                size += len(texts[-1]) + 1
                if size >= limit:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def release_memory() -> None:
    """Give freed memory back: Spark keeps a task's Python process for the tasks that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):        # another C library
        pass


def pack(values) -> bytes:
    """Unsigned 32-bit integers as byte planes under zstd."""
    a = np.ascontiguousarray(values, dtype="<u4")
    planes = a.view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def _power_table() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for one stretch of symbols."""
    if not _powers:
        size = _STRETCH + _LONG
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out, done = np.ones(size, dtype=np.uint64), 1
            while done < size:
                out[done:2 * done] = out[:min(done, size - done)] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            _powers[name] = out
    return _powers["up"], _powers["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ascending spans [start, end) of a symbol array.

    A polynomial over mixed symbols from a running sum, one stretch of symbols
    at a time. Spans past ``_LONG`` symbols, where such polynomials have known
    collisions, are hashed apart.
    """
    up, down = _power_table()
    out = np.empty(len(starts), dtype=np.uint64)
    sizes = ends - starts
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = int(np.searchsorted(starts, base + _STRETCH))
        part = symbols[base:base + _STRETCH + _LONG]
        total = np.empty(len(part) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(mix64(part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=total[1:])
        at = starts[lo:hi] - base
        size = np.minimum(sizes[lo:hi], _LONG)
        stop = np.minimum(at + size, len(part))
        out[lo:hi] = mix64((total[stop] - total[at]) * down[at] + size.astype(np.uint64))
        lo = hi
    for k in np.flatnonzero(sizes > _LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(symbols[starts[k]:ends[k]].tobytes())
    return out


_WORD_TABLES: dict[bytes, np.ndarray] = {}


def word_spans(raw: np.ndarray, separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are not separators."""
    table = _WORD_TABLES.get(separators)
    if table is None:
        table = np.ones(256, dtype=bool)
        table[list(separators)] = False
        _WORD_TABLES[separators] = table
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = table[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: Fixed value: the white space that separates words, \x09-\x0D and \x20.
SPACE = b"\x09\x0a\x0b\x0c\x0d\x20"


def block_words(texts: list[str], separators: bytes = SPACE, lower: bool = False):
    """Words of a block of texts.

    Returns (raw bytes, word starts, word ends, first word of each document
    plus the end). Texts are joined by a line feed, which is a separator.
    """
    parts = [t.encode() for t in texts]
    joined = b"\n".join(parts)
    if lower:
        joined = joined.lower()          # bytes.lower touches A-Z only
    raw = np.frombuffer(joined, dtype=np.uint8)
    starts, ends = word_spans(raw, separators)
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    begin = np.concatenate(([0], np.cumsum(sizes)))
    return raw, starts, ends, np.searchsorted(starts, begin)
