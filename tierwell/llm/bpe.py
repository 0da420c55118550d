"""Byte-level BPE encoding and decoding.

Global distinct-word shuffle. Documents are cut into blocks; a block keeps its
pre-tokens as a compressed sequence of positions in the block's own word list
and sends each of its words once to the bucket that the word hashes to. A
bucket meets every distinct word of the corpus that belongs to it, runs the
merges once per distinct word, and answers each block with the ids of its
words. A block then reassembles its documents by position. The blocks are
written once as a table bucketed by block, so their position lists are never
shuffled; what moves is the distinct words per block and their ids, never one
row per pre-token. A frequent word costs one entry per block.

Decoding joins the token-byte table (as many rows as the vocabulary file, a
fixed bound) and concatenates the bytes in order.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .common import blocks, colocated, id_and_text, pack, span_hashes, unpack

#: Longest vocabulary file that is sent to the tasks.
MAX_VOCABULARY_BYTES = 64_000_000
#: Characters that are cut into pre-tokens at a time.
STRETCH_CHARS = 500_000
_SPACE, _LETTER, _NUMBER, _OTHER, _EDGE = range(5)
_classes: list[np.ndarray] = []


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is larger than MAX_VOCABULARY_BYTES")
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


def _class_table() -> np.ndarray:
    if not _classes:
        table = np.full(0x110000, _OTHER, dtype=np.uint8)
        every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
        for kind, name in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(name, every):
                table[ord(m[0][0]):ord(m[0][-1]) + 1] = kind
        _classes.append(table)
    return _classes[0]


def pretoken_spans(texts: list[str]):
    """Spans that the pre-token pattern matches, for many texts at once.

    Returns (joined text, code points, starts, ends, first span of each text plus the
    end). The pattern is that of the public rank files: contractions, an
    optional blank with a run of letters, of numbers or of other signs, and
    runs of white space that leave their last sign to what follows.
    """
    joined = "\n".join([*texts, ""])
    cp = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
    n = len(cp)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    edge = np.cumsum(sizes) - 1
    kind = _class_table()[cp]
    kind[edge] = _EDGE
    first = np.ones(n, dtype=bool)
    first[1:] = kind[1:] != kind[:-1]
    first[edge] = True
    first[edge[:-1] + 1] = True
    # white space before another run: its last sign stands alone or, if a blank, joins the run
    run = np.flatnonzero((kind[1:] >= _LETTER) & (kind[1:] <= _OTHER) & (kind[:-1] == _SPACE)) + 1
    first[run - 1] = True
    first[run] = cp[run - 1] != 0x20
    # contractions begin at an apostrophe that begins a span and is followed by a letter
    quote = np.flatnonzero((cp == 0x27) & first & (kind == _OTHER))
    quote = quote[quote + 2 < n]
    quote = quote[kind[quote + 1] == _LETTER]
    a, b = cp[quote + 1], cp[quote + 2]
    letter = lambda x, s: np.isin(x, [ord(c) for c in s])
    two = letter(a, "stmd")
    three = ~two & ((letter(a, "rv") & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
    three &= kind[quote + 2] == _LETTER
    first[quote[two | three] + 1] = False
    first[quote[two] + 2] = True
    first[quote[three] + 3] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n)
    real = kind[starts] != _EDGE
    starts, ends = starts[real], ends[real]
    begin = np.concatenate(([0], edge + 1))
    return joined, cp, starts, ends, np.searchsorted(starts, begin)


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, leftmost first, until none is known."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 96:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    known = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
    while known:
        low = min(known)
        if low == 1 << 60:
            break
        i = known.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del known[i]
        if i < len(known):
            known[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        if i:
            known[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges over a linked list with a heap, for very long words."""
    n = len(word)
    end = list(range(1, n + 1))            # the part that starts at i ends at end[i]; 0: no part
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, j, end[j]))

    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or j >= n or end[j] != k:
            continue
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def _split_blocks(buckets: int, limit: int):
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(blocks(batches, limit)):
            parts, keys, per_doc, size, lo = [], [], [], 0, 0
            for hi, text in enumerate(texts, 1):        # a stretch of texts at a time
                size += len(text) + 1
                if size >= STRETCH_CHARS or hi == len(texts):
                    joined, cp, starts, ends, begin = pretoken_spans(texts[lo:hi])
                    parts.append((joined, starts.astype(np.int32), ends.astype(np.int32)))
                    keys.append(span_hashes(cp, starts, ends))
                    per_doc.append(np.diff(begin))
                    lo, size = hi, 0
            base = np.cumsum([0, *map(len, keys)])
            distinct, at, where, count = np.unique(np.concatenate(keys), return_index=True,
                                                   return_inverse=True, return_counts=True)
            del keys, texts
            # number the words by bucket first (so that the answers join on),
            # then by frequency, which keeps most positions small
            bucket = (distinct >> np.uint64(33)).astype(np.int64) % buckets
            rank = np.empty(len(distinct), dtype=np.uint32)
            by_count = np.argsort(-count, kind="stable")
            rank[by_count] = np.arange(len(distinct), dtype=np.uint32)
            block = f"{part}-{number}"
            out = [{"block": block, "bucket": -1, "ids": ids, "counts": pack(np.concatenate(per_doc)),
                    "data": pack(rank[where.ravel()])}]
            order = np.lexsort((rank, bucket))
            cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
            for lo, hi in zip(cut, cut[1:]):
                own = order[lo:hi]
                words = []
                for place, which in zip(at[own].tolist(),
                                        (np.searchsorted(base, at[own], side="right") - 1).tolist()):
                    joined, starts, ends = parts[which]
                    words.append(joined[starts[place - base[which]]:ends[place - base[which]]].encode())
                lens = np.fromiter(map(len, words), np.uint32, len(words))
                out.append({"block": block, "bucket": int(bucket[order[lo]]), "ids": None,
                            "counts": pack(np.concatenate((rank[own], lens))),
                            "data": zstandard.compress(b"".join(words), 3)})
            yield out
    return run


def _encode_bucket(shared):
    def run(key, table):
        ranks = shared.value
        known: dict[bytes, list[int]] = {}
        rows = []
        for row in table.select(["block", "counts", "data"]).to_pylist():
            places = unpack(row["counts"])
            half = len(places) // 2
            words, at = zstandard.decompress(row["data"]), 0
            ids, sizes = [], np.empty(half, dtype=np.uint32)
            for k, size in enumerate(places[half:].tolist()):
                word = words[at:at + size]
                at += size
                tokens = known.get(word)
                if tokens is None:
                    tokens = known[word] = merge_word(word, ranks)
                ids += tokens
                sizes[k] = len(tokens)
            rows.append({"block": row["block"], "places": pack(np.concatenate((places[:half], sizes))),
                         "tokens": pack(np.array(ids, dtype=np.uint32))})
        return pa.Table.from_pylist(rows, schema=pa.schema(
            [("block", pa.string()), ("places", pa.binary()), ("tokens", pa.binary())]))
    return run


def _gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indexes of the concatenated ranges [start, start + len)."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    shift = np.repeat(starts - (np.cumsum(lens) - lens), lens)
    return shift + np.arange(total)


def _reassemble(id_type):
    schema = pa.schema([("doc_id", id_type), ("ids", pa.list_(pa.int32()))])

    def run(key, docs, answers):
        n = sum(len(unpack(b)) // 2 for b in answers.column("places").to_pylist())
        first, lens = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        tokens, base = [], 0
        for row in answers.to_pylist():
            places = unpack(row["places"]).astype(np.int64)
            half = len(places) // 2
            own, size = places[:half], places[half:]
            first[own] = base + np.cumsum(size) - size
            lens[own] = size
            tokens.append(unpack(row["tokens"]))
            base += len(tokens[-1])
        pool = np.concatenate(tokens).astype(np.int32) if tokens else np.empty(0, np.int32)
        for row in docs.select(["ids", "counts", "data"]).to_pylist():
            words = unpack(row["data"]).astype(np.int64)
            flat = pool[_gather(first[words], lens[words])]
            stops = np.concatenate(([0], np.cumsum(lens[words])))
            cuts = np.concatenate(([0], np.cumsum(unpack(row["counts"]).astype(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], type=id_type),
                 pa.ListArray.from_arrays(pa.array(stops[cuts].astype(np.int32)), pa.array(flat))],
                schema=schema)

    def table(key, docs, answers):
        return pa.Table.from_batches(list(run(key, docs, answers)), schema=schema)
    return table


def encode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id",
           text_col: str = "text", buckets: int | None = None,
           block_chars: int = 8_000_000) -> DataFrame:
    """``(doc_id, ids array<int>)``: the token ids of every whole text.

    Null and empty texts give an empty list. Repeated rows and repeated or
    null ids each give their own row (nothing is joined on the id). An empty
    table gives an empty result. Other columns are ignored. ``buckets``
    (default: twice the session's shuffle partitions, at least 96) is the
    number of groups of distinct words.
    A very long text is read whole, by one task; nothing is cut off.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    if buckets is None:
        buckets = max(96, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = T.StructType([
        T.StructField("block", T.StringType()), T.StructField("bucket", T.IntegerType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("counts", T.BinaryType()),
        T.StructField("data", T.BinaryType())])
    arrow = pa.schema([("block", pa.string()), ("bucket", pa.int32()),
                       ("ids", pa.list_(to_arrow_type(id_type))), ("counts", pa.binary()),
                       ("data", pa.binary())])
    split = _split_blocks(buckets, block_chars)

    def to_arrow(batches):
        for out in split(batches):
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    made = colocated(rows.mapInArrow(to_arrow, fields), "block")
    shared = spark.sparkContext.broadcast(ranks)
    answers = (made.where("bucket >= 0").select("bucket", "block", "counts", "data")
               .groupBy("bucket")
               .applyInArrow(_encode_bucket(shared), "block string, places binary, tokens binary"))
    payload = made.where("bucket = -1").select("block", "ids", "counts", "data")
    return (payload.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_reassemble(to_arrow_type(id_type)),
                          T.StructType([T.StructField("doc_id", id_type),
                                        T.StructField("ids", T.ArrayType(T.IntegerType()))])))


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for: a join with the token-byte table.

    The table has one row per vocabulary entry and is sent to every task, a
    bound that the vocabulary file sets. Null lists give null, empty lists
    empty bytes; an id that the table lacks raises.
    """
    spark = encoded.sparkSession
    size = max(ranks.values()) + 1 if ranks else 0
    lens = np.full(size, -1, dtype=np.int64)
    for token, rank in ranks.items():
        lens[rank] = len(token)
    at = np.concatenate(([0], np.cumsum(np.maximum(lens, 0))))
    flat = np.empty(int(at[-1]), dtype=np.uint8)
    for token, rank in ranks.items():
        flat[at[rank]:at[rank + 1]] = np.frombuffer(token, dtype=np.uint8)
    shared = spark.sparkContext.broadcast((flat, at, lens))
    where = encoded.columns.index(ids_col)
    names = [*encoded.columns, out_col]

    def run(batches):
        flat, at, lens = shared.value
        for batch in batches:
            step = 512
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                lists = part.column(where)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(lens) or (lens[ids] < 0).any()):
                    raise ValueError("an id is not in the token-byte table")
                size = lens[ids]
                data = flat[_gather(at[ids], size)] if len(ids) else np.empty(0, np.uint8)
                count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
                raw = memoryview(data.tobytes())
                values = [None if n else bytes(raw[a:b])
                          for a, b, n in zip(ends.tolist(), ends[1:].tolist(),
                                             lists.is_null().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.binary())],
                                                 names=names)

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields,
                                                 T.StructField(out_col, T.BinaryType())]))


def digests(decoded: DataFrame) -> DataFrame:
    """Contract columns of the query from the operator's ids and bytes."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
