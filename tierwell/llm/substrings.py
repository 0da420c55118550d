"""Substring dedup: every word of a repeated passage but its first place goes.

A window is a run of ``WINDOW`` words. Its *minimizer* is the smallest hash of
the ``GRAM``-word runs in it, so equal windows have equal minimizers wherever
they are; neighbouring windows mostly share theirs and form a *segment*.

1. Documents are cut into blocks, written once as a table bucketed by block.
   A block sends the distinct minimizers of its windows, packed, to buckets.
2. A bucket counts their places over all blocks and answers with bits:
   repeated or not, and whether very frequent. No repeated window can hide behind a
   minimizer that occurs once.
3. A block sends its segments under repeated minimizers to the shard of the
   minimizer; equal segments of a block are sent once, and the others are
   settled there. Windows under a very frequent minimizer are sent one by one
   to the shard of their own content, so a passage in a third of all
   documents does not gather its surroundings in one shard.
4. A shard builds a compressed FM-index (wavelet matrix over the
   Burrows-Wheeler transform) of its distinct segments in the order of ids and
   positions. Backward search gives the matching statistics of the streamed
   segments; windows whose match reaches the threshold are reported with the
   earliest place of their words, and those that start later are marked.
5. A block unites the marks of its documents and rebuilds the texts.

Shards and buckets grow in number with the session's shuffle partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import (SPACE, block_words, blocks, checkpointed, colocated, id_and_text, mix64, pack, span_hashes,
                     unpack, word_spans)
from .fmindex import FMIndex

WINDOW, GRAM = 20, 6
#: Windows of a segment at most; places from which a minimizer counts as very frequent.
SEGMENT, FREQUENT = 64, 1000


def _block_windows(texts: list[str], window: int):
    """(first word of each text, start of each window, its minimizer, its content hash, places of minimizers).

    The last holds a minimizer once for every place in the texts at which it
    is one; a run of neighbouring windows over one place counts as one.
    """
    raw, starts, ends, begin = block_words(texts)
    word = span_hashes(raw, starts, ends)
    n = len(word)
    gram = max(1, min(GRAM, window))
    runs = window - gram + 1
    if n < window:
        empty = np.empty(0, dtype=np.int64)
        return begin, empty, *[empty.astype(np.uint64)] * 3
    hashed = word[:n - gram + 1].copy()
    for k in range(1, gram):
        hashed = mix64(hashed * np.uint64(0x9E3779B97F4A7C15) + word[k:n - gram + 1 + k])
    low = _sliding(np.minimum, hashed, runs)
    whole = word[:n - window + 1].copy()
    for k in range(1, window):
        whole = whole * np.uint64(0xC2B2AE3D27D4EB4F) + word[k:n - window + 1 + k]
    doc = np.searchsorted(begin, np.arange(n - window + 1), side="right") - 1
    inside = np.arange(n - window + 1) + window <= begin[doc + 1]
    at = np.flatnonzero(inside)
    edge = np.zeros(runs - 1, dtype=np.uint64)
    reach = _sliding(np.maximum, np.concatenate((edge, np.where(inside, low, np.uint64(0)), edge)), runs)
    return begin, at, low[at], mix64(whole[at]), hashed[reach == hashed]


def _sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:len(values) - step], values[step:])
        done += step
    return values


def _bucket_lists(places: np.ndarray, buckets: int):
    """Distinct minimizers by bucket, ascending: (bucket, minimizers, counts)."""
    value, count = np.unique(places, return_counts=True)
    bucket = (value & np.uint64(0xFFFFFFFF)).astype(np.int64) % buckets
    order = np.lexsort((value, bucket))
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
    for lo, hi in zip(cut, cut[1:]):
        own = order[lo:hi]
        yield int(bucket[order[lo]]), value[own], count[own]


def _pack64(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 3)


def _unpack64(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()


def _count_bucket(key, table):
    """Bits of one bucket's minimizers for every block: repeated, very frequent."""
    rows = table.select(["block", "values", "counts"]).to_pylist()
    lists = [_unpack64(r["values"]) for r in rows]
    value, where = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(where.ravel(), weights=np.concatenate([unpack(r["counts"]) for r in rows]),
                        minlength=len(value))
    cuts = np.cumsum([0, *map(len, lists)])
    flags = ((total > 1).astype(np.uint8) + (total > FREQUENT))[where.ravel()]
    out = [np.packbits(np.stack((flags[a:b] > 0, flags[a:b] > 1))).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table({"block": pa.array([r["block"] for r in rows], pa.string()),
                     "bucket": pa.array([int(key[0].as_py())] * len(rows), pa.int32()),
                     "bits": pa.array(out, pa.binary())})


def _texts(row: dict) -> list[str]:
    data, ends = zstandard.decompress(row["data"]), np.cumsum(unpack(row["counts"]).astype(np.int64))
    return [data[a:b].decode() for a, b in zip([0, *ends.tolist()], ends.tolist())]


def _segments(window: int, buckets: int, shards: int, schema: pa.Schema):
    """The segments that a block sends, and the marks that it settles itself."""
    def run(key, docs, answers):
        out = []
        bits = {r["bucket"]: r["bits"] for r in answers.select(["bucket", "bits"]).to_pylist()}
        for row in docs.select(["block", "ids", "counts", "data"]).to_pylist():
            texts = _texts(row)
            begin, at, low, whole, places = _block_windows(texts, window)
            flagged = [np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)]
            for bucket, value, _ in _bucket_lists(places, buckets):
                flag = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=2 * len(value)).reshape(2, -1)
                flagged = [np.concatenate((f, value[b > 0])) for f, b in zip(flagged, flag)]
            again, frequent = np.isin(low, flagged[0]), np.isin(low, flagged[1])
            doc = np.searchsorted(begin, at, side="right") - 1
            # a segment begins where the minimizer, the document or the kind of window changes
            new = np.ones(len(at), dtype=bool)
            new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | frequent[1:]
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(at)))
            # cut long segments
            pieces = -(-size // SEGMENT)
            head = np.repeat(head, pieces) + SEGMENT * (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            size = np.diff(np.append(head, len(at)))
            keep = again[head]
            head, size = head[keep], size[keep]
            route = np.where(frequent[head], whole[head], low[head])
            shard = (mix64(route) >> np.uint64(33)).astype(np.int64) % shards
            order = _order(row["ids"])
            start_in = at[head] - begin[doc[head]]
            place = np.lexsort((start_in, order[doc[head]]))         # by id, then by position
            words, of = None, -1
            first: dict[bytes, int] = {}
            sent: dict[int, list] = {}
            settled = []
            for k in place.tolist():
                d, start = int(doc[head[k]]), int(start_in[k])
                if d != of:
                    words, of = texts[d].encode().split(), d
                text = b" ".join(words[start:start + int(size[k]) + window - 1])
                known = first.get(text)
                if known is None or known == (order[d], start):
                    first.setdefault(text, (order[d], start))
                    sent.setdefault(int(shard[k]), []).append((d, start, int(size[k]), text))
                else:
                    settled.append((d, start, int(size[k])))
            out.append({"shard": -1, "block": row["block"], "ids": None, "data": None,
                        "places": pack(np.array(settled, dtype=np.uint32).reshape(-1, 3).T.ravel())})
            for s, rows in sent.items():
                out.append({"shard": s, "block": row["block"], "ids": [row["ids"][r[0]] for r in rows],
                            "places": pack(np.array([r[:3] for r in rows], dtype=np.uint32).T.ravel()),
                            "data": zstandard.compress(b"\n".join(r[3] for r in rows), 3)})
        return pa.Table.from_pylist(out, schema=schema)
    return run


def _order(ids: list) -> np.ndarray:
    """Rank of each id; equal ids are equal, null comes first."""
    known = sorted({i for i in ids if i is not None})
    rank = {i: k + 1 for k, i in enumerate(known)}
    return np.fromiter((rank.get(i, 0) for i in ids), np.int64, len(ids))


def _search_shard(window: int):
    """Marks of one shard: runs of windows whose words also start earlier."""
    def run(key, table):
        rows = table.select(["block", "ids", "places", "data"]).to_pylist()
        ids, start, size, text, where, doc = [], [], [], [], [], []
        for k, r in enumerate(rows):
            d, s, n = unpack(r["places"]).astype(np.int64).reshape(3, -1)
            ids += r["ids"]
            start.append(s)
            size.append(n)
            doc.append(d)
            where.append(np.full(len(s), k))
            text += zstandard.decompress(r["data"]).split(b"\n")
        start, size, doc, where = map(np.concatenate, (start, size, doc, where))
        order = _order(ids)
        place = np.lexsort((start, order))
        number: dict[bytes, int] = {}        # distinct segments, by their first place
        lead = []
        segment = np.empty(len(place), dtype=np.int64)
        for k in place.tolist():
            m = number.setdefault(text[k], len(number))
            if m == len(lead):
                lead.append(k)
            segment[k] = m
        lead = np.array(lead, dtype=np.int64)
        joined = np.frombuffer(b"\n".join(number), dtype=np.uint8)
        del text
        begin, end = word_spans(joined, SPACE)
        _, word = np.unique(span_hashes(joined, begin, end), return_inverse=True)
        word = word.ravel() + 1
        # words of a segment: its windows and the rest of the last one; then a separator
        long = size[lead] + window - 1
        offset = np.cumsum(long + 1) - (long + 1)
        sequence = np.zeros(int((long + 1).sum()), dtype=np.int64)
        sequence[np.arange(len(word)) + np.repeat(np.arange(len(lead)), long)] = word
        index = FMIndex(sequence, window)
        windows = _ranges(offset, size[lead])
        found, earliest = index.repeated(windows + window - 1)
        # earliest place of each window's words as (id rank, start)
        owner = np.repeat(np.arange(len(lead)), size[lead])
        best_doc, best_at = order[lead][owner], start[lead][owner] + windows - offset[owner]
        other = np.searchsorted(offset, earliest, side="right") - 1
        best_doc[found] = order[lead][other]
        best_at[found] = start[lead][other] + earliest - offset[other]
        # every streamed segment takes the matching statistics of its words
        base = np.cumsum(size[lead]) - size[lead]
        own = _ranges(base[segment], size)
        entry = np.repeat(np.arange(len(segment)), size)
        at = start[entry] + own - base[segment][entry]
        late = (best_doc[own] < order[entry]) | ((best_doc[own] == order[entry]) & (best_at[own] < at))
        entry, at = entry[late], at[late]
        new = np.ones(len(entry), dtype=bool)
        new[1:] = (entry[1:] != entry[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(entry)))
        entry, at = entry[head], at[head]
        out = {"block": [], "places": []}
        for k, r in enumerate(rows):
            mine = where[entry] == k
            if mine.any():
                out["block"].append(r["block"])
                out["places"].append(pack(np.concatenate((doc[entry[mine]], at[mine], count[mine]))))
        return pa.table(out, schema=pa.schema([("block", pa.string()), ("places", pa.binary())]))
    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenated ranges [start, start + size)."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _rebuild(window: int, schema: pa.Schema):
    def run(key, docs, marks):
        found = [unpack(b).astype(np.int64).reshape(3, -1) for b in marks.column("places").to_pylist()]
        doc, start, count = np.concatenate(found, axis=1) if found else np.empty((3, 0), dtype=np.int64)
        order = np.lexsort((start, doc))
        doc, start, count = doc[order], start[order], count[order]
        out = []
        for row in docs.select(["ids", "counts", "data"]).to_pylist():
            cut = np.searchsorted(doc, np.arange(len(row["ids"]) + 1))
            for d, (i, text) in enumerate(zip(row["ids"], _texts(row))):
                words, spans = text.encode().split(), []
                for a, n in zip(start[cut[d]:cut[d + 1]].tolist(), count[cut[d]:cut[d + 1]].tolist()):
                    if spans and a <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], a + n + window - 1)
                    else:
                        spans.append({"start": a, "end": a + n + window - 1})
                kept = words if not spans else [w for a, b in zip([0, *(s["end"] for s in spans)],
                                                                 [*(s["start"] for s in spans), len(words)])
                                                for w in words[a:b]]
                out.append({"doc_id": i, "n_words": len(words), "n_removed": len(words) - len(kept),
                            "spans": spans, "kept": b" ".join(kept).decode()})
        return pa.Table.from_pylist(out, schema=schema)
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", block_chars: int = 4_000_000) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept)``.

    Words are runs of signs other than ASCII white space, unchanged. A word
    goes if a window that covers it has words that also start earlier: in a
    smaller id, or at an earlier place of the same document; all windows are
    judged on the input. ``spans`` are the removed word ranges, ``kept`` the
    words that stay, joined by one blank. Null and empty texts have no words.
    Null ids count as smallest, and rows that share an id as one place: a copy
    under the same id at the same place is not earlier, so both stay. An empty
    table gives an empty result; other columns are ignored.
    A very long text is read whole, by one task; nothing is cut off.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)
    many = max(96, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = T.StructType([
        T.StructField("block", T.StringType()), T.StructField("bucket", T.IntegerType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("counts", T.BinaryType()),
        T.StructField("data", T.BinaryType())])
    arrow = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("ids", pa.list_(arrow_id)),
                       ("counts", pa.binary()), ("data", pa.binary())])

    def cut(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(blocks(batches, block_chars)):
            block, parts = f"{part}-{number}", [t.encode() for t in texts]
            out = [{"block": block, "bucket": -1, "ids": ids, "counts": pack([len(p) for p in parts]),
                    "data": zstandard.compress(b"".join(parts), 3)}]
            del parts
            places = _block_windows(texts, window)[-1]
            out += [{"block": block, "bucket": b, "ids": None, "counts": pack(c), "data": _pack64(v)}
                    for b, v, c in _bucket_lists(places, many)]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    made = colocated(rows.mapInArrow(cut, fields), "block")
    payload = made.where("bucket = -1").select("block", "ids", "counts", "data")
    answers = (made.where("bucket >= 0").select("bucket", "block", F.col("data").alias("values"), "counts")
               .groupBy("bucket").applyInArrow(_count_bucket, "block string, bucket int, bits binary"))
    sent_fields = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.StringType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("places", T.BinaryType()),
        T.StructField("data", T.BinaryType())])
    sent_arrow = pa.schema([("shard", pa.int32()), ("block", pa.string()), ("ids", pa.list_(arrow_id)),
                            ("places", pa.binary()), ("data", pa.binary())])
    sent = checkpointed(payload.groupBy("block").cogroup(answers.groupBy("block"))
                        .applyInArrow(_segments(window, many, many, sent_arrow), sent_fields))
    searched = (sent.where("shard >= 0").groupBy("shard")
                .applyInArrow(_search_shard(window), "block string, places binary"))
    marks = sent.where("shard = -1").select("block", "places").union(searched)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    final = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()),
                          T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(span)),
                          T.StructField("kept", T.StringType())])
    final_arrow = pa.schema([("doc_id", arrow_id), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                             ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                             ("kept", pa.string())])
    return (payload.groupBy("block").cogroup(marks.groupBy("block"))
            .applyInArrow(_rebuild(window, final_arrow), final))


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
