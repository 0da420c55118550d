"""Secret scans over a trigram inverted index.

Documents are cut into blocks. A block is one index row: its texts
(compressed), the distinct trigrams of their lowered bytes, and for every
trigram the documents that hold it. Each rule's regular expression is turned
into a Boolean query over trigrams that every match must contain; a block
answers the query by intersecting and uniting posting lists, and only the
candidate documents are matched against the rule. A rule without mandatory
trigrams is matched against every document.
"""

from __future__ import annotations

import re
from re import _constants as sre, _parser as sre_parser
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .common import blocks, checkpointed, id_and_text, pack, unpack


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its group has at least ``least`` characters."""
    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 0


# The patterns of the base kinds, in their order, then further public token formats.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.ASCII | re.IGNORECASE, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)

#: A query is True (any document), a trigram, or ("and" | "or", parts).
_MOST = 64


def _both(parts) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _either(parts) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _grams(text: bytes) -> object:
    return _both([text[i:i + 3] for i in range(len(text) - 2)])


def _lowered(code: int) -> bytes:
    return chr(code).encode().lower()


def _strings(op, arg) -> tuple[set[bytes] | None, object]:
    """(the few strings that an element can match, or None; a query that holds if it is None)."""
    if op is sre.LITERAL:
        return {_lowered(arg)}, True
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {_lowered(c) for _, c in arg}, True
    if op is sre.AT:
        return {b""}, True
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        kinds = [_sequence(x) for x in arg[1]]
        if all(e is not None for e, _ in kinds) and sum(len(e) for e, _ in kinds) <= _MOST:
            return set().union(*(e for e, _ in kinds)), True
        return None, _either([q if e is None else _either([_grams(s) for s in e]) for e, q in kinds])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        exact, query = _sequence(inner)
        if exact is not None and high == 1:
            return exact | ({b""} if low == 0 else set()), True
        if low == 0:
            return None, True
        return None, query if exact is None else _either([_grams(s) for s in exact])
    return None, True


def _sequence(tree) -> tuple[set[bytes] | None, object]:
    now, needed, whole = {b""}, [], True
    for op, arg in tree:
        exact, query = _strings(op, arg)
        if exact is not None and len(now) * len(exact) <= _MOST:
            now = {a + b for a in now for b in exact}
            continue
        whole = False
        needed.append(_either([_grams(s) for s in now]))
        now = {b""}
        if exact is not None and len(exact) <= _MOST:
            now = exact
        else:
            needed.append(query)
    if whole:
        return now, True
    needed.append(_either([_grams(s) for s in now]))
    return None, _both(needed)


def trigram_query(rule: Rule) -> object:
    """A Boolean query over lowered trigrams that every match of the rule satisfies."""
    exact, query = _sequence(sre_parser.parse(rule.pattern, rule.flags))
    return query if exact is None else _either([_grams(s) for s in exact])


def _index_block(ids, texts) -> dict:
    parts = [t.encode() for t in texts]
    joined = b"\n".join(parts)
    raw = np.frombuffer(joined.lower(), dtype=np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    doc = np.repeat(np.arange(len(parts), dtype=np.uint64), np.diff(ends, prepend=0))[:len(raw)]
    if len(raw) >= 3:
        code = (raw[:-2].astype(np.uint64) << np.uint64(16)) | (raw[1:-1].astype(np.uint64) << np.uint64(8)) | raw[2:]
        key = (code << np.uint64(32)) | doc[:-2]
        # a trigram over the end of a document is none of its own
        key = key[(np.repeat(ends, np.diff(ends, prepend=0))[:len(raw) - 2] - np.arange(len(raw) - 2)) > 3]
        key.sort()
        key = key[np.diff(key, prepend=~key[:1]) != 0] if len(key) else key
    else:
        key = np.empty(0, dtype=np.uint64)
    code = (key >> np.uint64(32)).astype(np.uint32)
    first = np.flatnonzero(np.diff(code, prepend=~code[:1])) if len(code) else np.empty(0, np.int64)
    return {"ids": ids, "grams": pack(np.diff(code[first], prepend=np.uint32(0))),
            "counts": pack(np.diff(np.append(first, len(code)))),
            "docs": pack((key & np.uint64(0xFFFFFFFF)).astype(np.uint32)),
            "sizes": pack([len(p) for p in parts]), "texts": zstandard.compress(b"".join(parts), 3)}


_BLOBS = ("grams", "counts", "docs", "sizes", "texts")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_chars: int = 2_000_000) -> DataFrame:
    """The trigram index of every whole text, one row per block of documents."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    fields = T.StructType([T.StructField("ids", T.ArrayType(id_type)),
                           *[T.StructField(n, T.BinaryType()) for n in _BLOBS]])
    arrow = pa.schema([("ids", pa.list_(to_arrow_type(id_type))), *[(n, pa.binary()) for n in _BLOBS]])

    def run(batches):
        for ids, texts in blocks(batches, block_chars):
            yield pa.RecordBatch.from_pylist([_index_block(ids, texts)], schema=arrow)

    return checkpointed(rows.mapInArrow(run, fields))


def _candidates(query, postings, n: int) -> np.ndarray:
    """Documents of a block that satisfy the query."""
    if query is True:
        return np.arange(n)
    if isinstance(query, bytes):
        return postings(query)
    op, parts = query
    sets = [_candidates(p, postings, n) for p in parts]
    out = sets[0]
    for s in sorted(sets[1:], key=len) if op == "and" else sets[1:]:
        out = np.intersect1d(out, s, assume_unique=True) if op == "and" else np.union1d(out, s)
    return out


def find(rule: Rule, text: str, compiled: re.Pattern) -> list[tuple[int, int]]:
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan(index: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``(doc_id, spans)`` with spans ``(kind, start, end)`` in code points, end exclusive.

    Matches of a rule are leftmost and do not overlap; spans are ordered by
    start, then by the rules' order. Null and empty texts have none. Repeated
    rows or ids give a row each; an empty table gives an empty result.
    A very long text is read whole, by one task; nothing is cut off.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = index.schema["ids"].dataType.elementType
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("spans", T.ArrayType(span))])
    arrow = pa.schema([("doc_id", to_arrow_type(id_type)), ("spans", pa.list_(pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])
    queries = [trigram_query(r) for r in rules]

    def run(batches):
        compiled = [re.compile(r.pattern, r.flags) for r in rules]
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                n = len(row["ids"])
                grams = np.cumsum(unpack(row["grams"]), dtype=np.uint32)
                cuts = np.concatenate(([0], np.cumsum(unpack(row["counts"]).astype(np.int64))))
                docs = unpack(row["docs"])

                def postings(gram: bytes) -> np.ndarray:
                    k = int(np.searchsorted(grams, int.from_bytes(gram, "big")))
                    if k == len(grams) or grams[k] != int.from_bytes(gram, "big"):
                        return np.empty(0, dtype=np.int64)
                    return docs[cuts[k]:cuts[k + 1]].astype(np.int64)

                data = zstandard.decompress(row["texts"])
                ends = np.cumsum(unpack(row["sizes"]).astype(np.int64))
                texts: dict[int, str] = {}
                found: list[list] = [[] for _ in range(n)]
                for order, (rule, query, pattern) in enumerate(zip(rules, queries, compiled)):
                    for d in _candidates(query, postings, n).tolist():
                        if d not in texts:
                            texts[d] = data[ends[d - 1] if d else 0:ends[d]].decode()
                        found[d] += [(s, order, e) for s, e in find(rule, texts[d], pattern)]
                rows = [{"doc_id": i, "spans": [{"kind": rules[o].kind, "start": s, "end": e}
                                                for s, o, e in sorted(f)]}
                        for i, f in zip(row["ids"], found)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return index.mapInArrow(run, schema)


def digests(found: DataFrame) -> DataFrame:
    base = F.array(*[F.lit(r.kind) for r in BASE])
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    own = F.filter("spans", lambda s: F.array_contains(base, s["kind"]))
    return found.select("doc_id", *[of(r.kind).alias(f"n_{r.kind}") for r in BASE],
                        F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
