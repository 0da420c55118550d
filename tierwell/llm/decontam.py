"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by documents: a row holds one block of documents with
its sorted term list and, for every term, the ascending token positions in the
block (gaps, packed). It is stored in the shared checkpoint folder. Nothing is
shuffled, a frequent term is only a longer list within a block, and the work
grows with the documents.

Searching sends the test phrases to the blocks in pieces of bounded size (more
phrases mean more pieces, not a larger broadcast). In a block a phrase that
lacks a term ends at once; the others begin with the list of their rarest term
and intersect the offset-adjusted lists of the next rarer terms. Every list is
whole, so what remains is every exact occurrence. With ``slop`` the same lists
also give proximity matches: all terms of the phrase, in any order, near the
rarest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .common import block_words, blocks, checkpointed, id_and_text, pack, span_hashes, unpack

#: Fixed value: all ASCII but digits and letters (capitals are lowered before).
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Characters of test texts that one broadcast holds at most (one longer item is a piece of its own).
PIECE_CHARS = 4_000_000


def _index_block(ids, texts) -> dict:
    raw, starts, ends, begin = block_words(texts, SEPARATORS, lower=True)
    keys = span_hashes(raw, starts, ends)
    order = np.argsort(keys, kind="stable")          # by term, then by position
    ranked = keys[order]
    first = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1])) if len(ranked) else np.empty(0, int)
    text = raw.tobytes()
    at = order[first]
    terms = [text[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
    counts = np.diff(np.append(first, len(order)))
    gaps = np.diff(order, prepend=0)
    gaps[first] = at
    return {"ids": ids, "n_words": pack(np.diff(begin)),
            "terms": zstandard.compress(b" ".join(terms), 3), "counts": pack(counts),
            "postings": pack(gaps)}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_chars: int = 8_000_000) -> DataFrame:
    """The positional index of every whole text; one row per block of documents.

    A very long text is read whole, by one task; nothing is cut off.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    blobs = ("n_words", "terms", "counts", "postings")
    fields = T.StructType([T.StructField("block", T.StringType()), T.StructField("ids", T.ArrayType(id_type)),
                           *[T.StructField(n, T.BinaryType()) for n in blobs]])
    arrow = pa.schema([("block", pa.string()), ("ids", pa.list_(to_arrow_type(id_type))),
                       *[(n, pa.binary()) for n in blobs]])

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(blocks(batches, block_chars)):
            row = {"block": f"{part}-{number}"} | _index_block(ids, texts)
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return checkpointed(rows.mapInArrow(run, fields))


class Block:
    """One block of the index: posting lists by term."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.n_words = unpack(row["n_words"]).astype(np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.n_words)))
        terms = zstandard.decompress(row["terms"]).split(b" ")
        self.counts = unpack(row["counts"]).astype(np.int64)
        self.slot = {t: i for i, t in enumerate(terms)} if len(self.counts) else {}
        self.at = np.concatenate(([0], np.cumsum(self.counts)))
        self.gaps = unpack(row["postings"]).astype(np.int64)
        self.lists: dict[int, np.ndarray] = {}

    def postings(self, slot: int) -> np.ndarray:
        got = self.lists.get(slot)
        if got is None:
            gaps = self.gaps[self.at[slot]:self.at[slot + 1]].copy()
            # the first entry is a position, the others are steps
            got = self.lists[slot] = np.cumsum(gaps)
        return got

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, positions, side="right") - 1


def phrases_of(items: list[tuple[str | None, str]], window: int):
    """Distinct terms and the windows over them: (terms, [(item id, term numbers)])."""
    number: dict[bytes, int] = {}
    phrases: dict[tuple[int, ...], set] = {}
    for item, text in items:
        raw, starts, ends, _ = block_words([text], SEPARATORS, lower=True)
        data = raw.tobytes()
        words = [number.setdefault(data[s:e], len(number)) for s, e in zip(starts.tolist(), ends.tolist())]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            phrases.setdefault(tuple(words[i:i + window]), set()).add(item)
    return list(number), [(sorted(x for x in v if x is not None), k) for k, v in phrases.items()]


def _inside(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Those of the sorted values that the sorted array holds."""
    at = np.searchsorted(among, values)
    at[at == len(among)] = len(among) - 1
    return values[among[at] == values]


def exact_matches(block: Block, slots: np.ndarray, phrase: tuple[int, ...]) -> np.ndarray:
    """Start positions of the phrase, from its rarest term on."""
    own = slots[list(phrase)]
    found = None
    for k in np.argsort(block.counts[own], kind="stable").tolist():
        here = block.postings(int(own[k])) - k
        found = here if found is None else _inside(found, here)
        if not len(found):
            return found
    found = found[found >= 0]
    doc = block.document(found)
    return found[found + len(phrase) <= block.begin[doc + 1]]


def near_matches(block: Block, slots: np.ndarray, phrase: tuple[int, ...], slop: int) -> np.ndarray:
    """Positions of the rarest term with every other term within slop words in the same document."""
    own = sorted(set(slots[list(phrase)].tolist()), key=lambda s: block.counts[s])
    found = block.postings(own[0])
    for s in own[1:]:
        doc = block.document(found)
        low = np.maximum(found - slop, block.begin[doc])
        high = np.minimum(found + slop, block.begin[doc + 1] - 1)
        here = block.postings(s)
        found = found[np.searchsorted(here, high, side="right") > np.searchsorted(here, low)]
        if not len(found):
            break
    return found


def _search(shared, slop: int | None):
    terms, phrases = shared.value

    def block_rows(row: dict) -> list[dict]:
        block = Block(row)
        slots = np.fromiter((block.slot.get(t, -1) for t in terms), np.int64, len(terms))
        edges = np.zeros(int(block.begin[-1]) + 1, dtype=np.int64)
        items: list[set] = [set() for _ in block.ids]
        near: list[set] = [set() for _ in block.ids]
        for names, phrase in phrases:
            if (slots[list(phrase)] < 0).any():
                continue
            found = exact_matches(block, slots, phrase)
            np.add.at(edges, found, 1)
            np.add.at(edges, found + len(phrase), -1)
            for d in np.unique(block.document(found)).tolist():
                items[d].update(names)
            if slop is not None:
                for d in np.unique(block.document(near_matches(block, slots, phrase, slop))).tolist():
                    near[d].update(names)
        hit = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1]) > 0)))
        hits = hit[block.begin[1:]] - hit[block.begin[:-1]]
        spans = np.diff(np.concatenate(([0], (np.cumsum(edges[:-1]) > 0).astype(np.int8), [0])))
        lo, hi = np.flatnonzero(spans == 1), np.flatnonzero(spans == -1)
        out = []
        for d, doc_id in enumerate(block.ids):
            a, b = block.begin[d], block.begin[d + 1]
            own = [(int(max(x, a) - a), int(min(y, b) - a)) for x, y in
                   zip(*(z[slice(np.searchsorted(hi, a, side="right"), np.searchsorted(lo, b))] for z in (lo, hi)))]
            out.append({"block": row["block"], "place": d, "doc_id": doc_id, "n_words": int(block.n_words[d]), "n_hit": int(hits[d]),
                        "items": sorted(items[d]), "near_items": sorted(near[d]),
                        "spans": [{"start": x, "end": y} for x, y in own if y > x]})
        return out
    return block_rows


def _pieces(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, str]]]:
    """Test items in lists of bounded size, one at a time on the driver."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")) \
        .where("text is not null and text <> ''")
    piece, size = [], 0
    for r in rows.toLocalIterator():
        piece.append((r.item_id, r.text))
        size += len(r.text)
        if size >= PIECE_CHARS:
            yield piece
            piece, size = [], 0
    yield piece


def search(index: DataFrame, benchmark: DataFrame, window: int = 10, slop: int | None = None,
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Matches per document: ``doc_id, n_words, n_hit, items, near_items, spans``.

    A phrase is ``window`` consecutive words of an item (all its words if it
    has fewer). ``n_hit`` counts the words inside any exact occurrence and
    ``spans`` lists them as word ranges; ``items`` are the ids, as sorted
    strings, of the items with an exact phrase in the document, ``near_items``
    (with ``slop``) of those with all terms of a phrase near its rarest term.
    Null or empty texts have no words; items without words match nothing; an
    item without an id counts for hits but is not listed; repeated items count
    once. Repeated rows or ids give a row each. With an empty benchmark all
    counts are 0.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    spark = index.sparkSession
    id_type = index.schema["ids"].dataType.elementType
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField("block", T.StringType()), T.StructField("place", T.IntegerType()),
                           T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()),
                           T.StructField("n_hit", T.LongType()),
                           T.StructField("items", T.ArrayType(T.StringType())),
                           T.StructField("near_items", T.ArrayType(T.StringType())),
                           T.StructField("spans", span)])
    arrow = pa.schema([("block", pa.string()), ("place", pa.int32()),
                       ("doc_id", to_arrow_type(id_type)), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                       ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string())),
                       ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def searched(piece) -> DataFrame:
        shared = spark.sparkContext.broadcast(phrases_of(piece, window))

        def run(batches):
            search_block = _search(shared, slop)
            for batch in batches:
                for at in range(batch.num_rows):
                    rows = search_block(batch.slice(at, 1).to_pylist()[0])
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        return index.mapInArrow(run, schema)

    parts = [searched(p) for p in _pieces(benchmark, item_id_col, item_text_col)]
    if len(parts) == 1:
        return parts[0].drop("block", "place")
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = union.groupBy("block").applyInArrow(_merge(arrow), schema)
    return merged.drop("block", "place")


def _merge(arrow: pa.Schema):
    """The rows that several pieces of the benchmark gave the documents of one block."""
    def run(key, table):
        docs: dict[int, dict] = {}
        for row in table.to_pylist():
            have = docs.setdefault(row["place"], row)
            if have is not row:
                for name in ("items", "near_items"):
                    have[name] = sorted({*have[name], *row[name]})
                have["spans"] = have["spans"] + row["spans"]
        for have in docs.values():
            joined: list[dict] = []
            for s in sorted(have["spans"], key=lambda s: s["start"]):
                if joined and s["start"] <= joined[-1]["end"]:
                    joined[-1]["end"] = max(joined[-1]["end"], s["end"])
                else:
                    joined.append(dict(s))
            have["spans"] = joined
            have["n_hit"] = sum(s["end"] - s["start"] for s in joined)
        return pa.Table.from_pylist(list(docs.values()), schema=arrow)
    return run


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
