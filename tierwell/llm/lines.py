"""Line dedup: drop lines that many documents share.

Lines are exploded per document and normalised; a key is a 128-bit hash of the
normalised line. Distinct documents are counted per key (with map-side
partial aggregation, so a line found in a third of all documents is a few
rows), keys at or over the threshold are joined back to the documents that
hold them (a shuffle join that AQE splits for a hot key), and each document
is reassembled from the lines that stay, in order.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import SPACE, id_and_text


def _key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the normalised line, or None if it has fewer code points than asked for."""
    norm = line.strip(SPACE)
    if len(norm) < min_chars:
        return None
    if len(norm) < 4 * min_chars and len(norm.decode()) < min_chars:
        return None
    return hashlib.md5(norm.lower(), usedforsecurity=False).digest()


def _explode(min_chars: int):
    def run(batches):
        for batch in batches:
            rows, keys = [], []
            ids = batch.column(0)
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                for k in {k for line in text.split(b"\n") if (k := _key(line, min_chars))}:
                    rows.append(i)
                    keys.append(k)
            halves = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                 ids.take(pa.array(rows, pa.int64()))], names=["h1", "h2", "doc_id"])
    return run


def _rebuild(min_chars: int, names: list[str], text_at: int):
    """names: of the result; the last input column holds the keys to drop."""
    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                kept, lines, dropped = [], [], []
                for text, gone in zip(batch.column(text_at).cast(pa.binary()).to_pylist(),
                                      batch.column(batch.num_columns - 1).to_pylist()):
                    parts = (text or b"").split(b"\n")
                    stay = parts
                    if gone:
                        keys = {(x["h1"], x["h2"]) for x in gone}
                        pair = lambda k: tuple(np.frombuffer(k, "<i8").tolist())
                        stay = [p for p in parts
                                if (k := _key(p, min_chars)) is None or pair(k) not in keys]
                    kept.append(text if stay is parts else b"\n".join(stay))
                    lines.append(len(parts))
                    dropped.append(len(parts) - len(stay))
                columns = list(batch.columns[:-1])
                columns[text_at] = pa.array(kept, pa.binary()).cast(pa.string())
                columns += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns[:len(names)], names=names)
    return run


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                id_col: str = "doc_id", text_col: str = "text",
                keep_columns: bool = False) -> DataFrame:
    """Drop repeated lines: ``(doc_id, text, n_lines, n_dropped)``.

    A line's key is the line stripped of ASCII white space with A-Z lowered.
    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    distinct documents stay only in the largest id that holds them; all other
    lines stay as they are. Null and empty texts are one empty line, and a
    null text stays null with ``keep_columns``. Rows that repeat an id count
    as one document and are treated alike; rows without an id are not counted
    and keep all their lines. With ``keep_columns`` the result has exactly the
    input's columns, with the new text. An empty table gives an empty result.
    A very long text is read whole, by one task; nothing is cut off.
    """
    pairs = (id_and_text(docs, id_col, text_col).where("doc_id is not null")
             .mapInArrow(_explode(min_chars), T.StructType([
                 T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
                 T.StructField("doc_id", docs.schema[id_col].dataType)]))
             .distinct())
    common = (pairs.groupBy("h1", "h2")
              .agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("last"))
              .where(F.col("n") >= min_docs).drop("n"))
    # names of their own, so that no column of the documents clashes
    marked, gone = (f"lines_{uuid.uuid4().hex}" for _ in range(2))
    marks = (pairs.join(common, ["h1", "h2"]).where("doc_id <> last")
             .groupBy(F.col("doc_id").alias(marked))
             .agg(F.collect_set(F.struct("h1", "h2")).alias(gone)))
    if keep_columns:
        left = docs
        names, text_at = docs.columns, docs.columns.index(text_col)
        schema = docs.schema
    else:
        left = id_and_text(docs, id_col, text_col)
        names, text_at = ["doc_id", "text", "n_lines", "n_dropped"], 1
        schema = T.StructType([*left.schema.fields, T.StructField("n_lines", T.LongType()),
                               T.StructField("n_dropped", T.LongType())])
        id_col = "doc_id"
    joined = left.join(marks, left[id_col] == marks[marked], "left").drop(marked)
    return joined.mapInArrow(_rebuild(min_chars, names, text_at), schema)


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
