"""Sequence packing by non-negative least squares over length combinations.

Documents become token ids, one end id each, and are laid into windows of
``window`` ids. Only lengths matter for the plan, so it is made from a
histogram of ``window`` counts, whatever the number of documents:

1. whole windows of long documents stand alone; what is left of each document
   is a length below the window;
2. shallow combinations (up to three lengths, in steps of ``window / 512``) that
   fill a window are enumerated, and non-negative least squares finds how often
   to repeat each so that the counts meet the histogram; counts are rounded
   down and cut to what is there, longest lengths of a step first;
3. the residual is packed greedily, longest first into the tightest open
   window, by length and count;
4. what would leave a window with more than ``window / 128`` ids of padding is
   laid end to end and cut at window ends, its last part at powers of two.

The plan is a list of ranges: "ranks lo to hi of length L go to these slots of
these sequences". Ranks are given to documents by block (narrow rows: block,
length, count), each block then reads its own ids again and emits its pieces,
and offsets are running sums inside a sequence (at most ``window`` rows).
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialize
from .common import blocks, colocated, id_and_text, pack as packed, release_memory, unpack

STEPS = 512                 # length steps that combinations are made of
ITERATIONS = 400            # of the least-squares solver
WORD_CACHE = 500_000        # distinct words that a task remembers
BLOCK_CHARS = 4_000_000
PIECE_CHARS = 1_000_000     # of a block that are split into words at a time (one longer text at least)


# ------------------------------------------------------------------ token ids

#: Words whose normal form and parts are plain: ASCII without blanks, Latin-1 letters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Fixed value: the vocabulary's own split of such a word, in lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class _Codes(dict):
    """Numbers of words in the order they came; the empty word, the end of a text, is 0."""

    def __init__(self):
        super().__init__({b"": 0})
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class WordIds:
    """Ids of words (text between ASCII white space), each distinct word encoded once.

    A text's ids are those of its words one after another: the vocabulary's
    split never crosses white space. Plain words are split here and their parts
    given to the vocabulary's model; all others go through the whole tokenizer.
    Ids are kept as bytes (unsigned, 32 bits), which Python's garbage collector need not visit.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.parts: dict[str, bytes] = {}
        self.clear()

    def clear(self):
        self.codes = _Codes()
        self.flat, self.size = array("I", [self.end_id]), array("I", [1])

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) > WORD_CACHE:
                self.parts.clear()
            # the letters of ASCII signs are the signs themselves
            letters = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            ids = self.parts[part] = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return ids

    def learn(self, words: list[bytes]) -> None:
        """Encode the words that got a code last, in its order."""
        if not words:
            return
        out: list = [None] * len(words)
        rest, known, part = [], self.parts.get, self._part
        # words hold no line feed; lower case of a plain word is the same in a longer text
        joined = b"\n".join(words).decode()
        for i, (text, low) in enumerate(zip(joined.split("\n"), joined.lower().split("\n"))):
            if text.isascii():
                if text.isalpha():                       # most words: one part
                    out[i] = known(low) or part(low)
                    continue
                head, sign = low[:-1], low[-1:]
                if head.isalpha() and "!" <= sign <= "~" and not sign.isalnum():    # one part and one sign
                    out[i] = (known(head) or part(head)) + (known(sign) or part(sign))
                    continue
            if "<|" not in text and _PLAIN.fullmatch(text):
                out[i] = b"".join([known(p) or part(p) for p in _PARTS.findall(low)])
            else:
                rest.append(i)
        for lo in range(0, len(rest), 5000):
            some = rest[lo:lo + 5000]
            done = self.tokenizer.encode_batch([words[i].decode() for i in some], add_special_tokens=False)
            for i, e in zip(some, done):
                out[i] = array("I", e.ids).tobytes()
        self.size.extend([len(ids) // self.flat.itemsize for ids in out])
        self.flat.frombytes(b"".join(out))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by the end id; number of ids of each text)."""
        if len(self.codes) > WORD_CACHE:
            self.clear()
        # lists of words take many times the room of their ids, so few are held at a time
        done, some, size = [], [], 0
        for t in texts:
            some.append(t)
            size += len(t)
            if size >= PIECE_CHARS:
                done.append(self._encode(some))
                some, size = [], 0
        if some or not done:
            done.append(self._encode(some))
        return np.concatenate([ids for ids, _ in done]), np.concatenate([n for _, n in done])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, counts = [], []
        for t in texts:
            own = t.encode().split()                     # bytes.split: ASCII white space
            words += own
            words.append(b"")
            counts.append(len(own) + 1)
        seen = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        del words
        self.learn(self.codes.new)
        self.codes.new = []
        # views, gone before the next words are added
        pool, size = np.frombuffer(self.flat, np.uint32), np.frombuffer(self.size, np.uint32)
        at = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        lens = size[seen].astype(np.int64)
        ends = np.cumsum(lens)
        places = np.repeat(at[seen] - (ends - lens), lens)
        places += np.arange(len(places))
        stops = ends[np.cumsum(counts) - 1] if counts else np.empty(0, np.int64)
        return pool[places], np.diff(np.concatenate(([0], stops)))


def token_blocks(docs: DataFrame, path: str, window: int, end_id: int, block_chars: int,
                 id_col: str, text_col: str) -> DataFrame:
    """Blocks of whole documents: their ids, and how often each length occurs in them."""
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches):
        from pyspark import TaskContext
        words, task, n = WordIds(path, end_id), TaskContext.get().partitionId(), 0
        for ids, texts in blocks(batches, block_chars):
            tokens, count = words.encode(texts)
            lengths = np.concatenate((count % window, np.full(int((count // window).sum()), window)))
            found, often = np.unique(lengths[lengths > 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([task << 33 | n], pa.int64()), pa.array([ids], pa.list_(arrow_id)),
                pa.array([packed(count)], pa.binary()), pa.array([packed(tokens)], pa.binary()),
                pa.array([found.tolist()], pa.list_(pa.int32())), pa.array([often.tolist()], pa.list_(pa.int64()))],
                names=["block", "ids", "counts", "data", "lengths", "often"])
            n += 1
        # the task's process stays for other tasks: neither its words nor their room
        words = ids = texts = tokens = None
        release_memory()

    return rows.mapInArrow(run, T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("counts", T.BinaryType()), T.StructField("data", T.BinaryType()),
        T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("often", T.ArrayType(T.LongType()))]))


# ----------------------------------------------------------------------- plan

def combinations(steps: int = STEPS) -> np.ndarray:
    """All ways to make ``steps`` of one to three steps' lengths (0: none), as rows of three."""
    out = [(steps, 0, 0)]
    out += [(a, steps - a, 0) for a in range((steps + 1) // 2, steps)]
    for a in range((steps + 2) // 3, steps - 1):
        rest = steps - a
        out += [(a, b, rest - b) for b in range((rest + 1) // 2, min(a, rest - 1) + 1)]
    return np.array(out, dtype=np.int64)


def repeat_counts(combos: np.ndarray, have: np.ndarray) -> np.ndarray:
    """Non-negative least squares: how often to repeat each combination, in whole numbers.

    Accelerated projected gradient on ``|A x - have|`` (column of A: the lengths
    of one combination); then rounded, and no length is used more often than it
    occurs.
    """
    x = np.zeros(len(combos))
    steps = len(have) - 1
    target = have.astype(np.float64)
    target[0] = 0
    scale = target.max()
    if scale == 0:
        return x.astype(np.int64)
    target /= scale
    used = lambda v: np.bincount(combos.ravel(), np.repeat(v, 3), steps + 1)
    # step length from the norm of A, by power iteration
    v = np.ones(len(combos))
    for _ in range(20):
        w = used(v)
        w[0] = 0
        v = w[combos].sum(axis=1)
        norm = np.linalg.norm(v)
        v /= norm
    y, momentum = x, 1.0
    for _ in range(ITERATIONS):
        gap = used(y) - target
        gap[0] = 0
        new = np.maximum(0, y - gap[combos].sum(axis=1) / norm)
        after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y, x, momentum = new + (momentum - 1) / after * (new - x), new, after
    # the larger counts first; never more than there is
    counts, left = np.zeros(len(combos), np.int64), have.copy()
    want = np.floor(x * scale + 0.5).astype(np.int64)
    for k in np.argsort(-want, kind="stable"):
        if not want[k]:
            break
        lengths, times = np.unique(combos[k][combos[k] > 0], return_counts=True)
        n = min(int(want[k]), int((left[lengths] // times).min()))
        counts[k] = n
        left[lengths] -= n * times
    return counts


def greedy(have: np.ndarray, window: int) -> list[tuple[int, list[tuple[int, int]], int]]:
    """Longest first into the tightest open window, for lengths with counts.

    Returns (number of windows, [(length, copies)], room left in each).
    """
    rooms: dict[int, list[tuple[int, list]]] = {}      # room: open windows (how many, what is inside)
    order: list[int] = []                              # the rooms, ascending

    def put(room, n, inside):
        if n > 0:
            if room not in rooms:
                bisect.insort(order, room)
            rooms.setdefault(room, []).append((n, inside))

    for length in range(len(have) - 1, 0, -1):
        left = int(have[length])
        while left:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                room = order[at]
                n, inside = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[at]
            else:
                room, inside, n = window, [], left
            copies = room // length
            whole, over = min(n, left // copies), 0
            left -= whole * copies
            if whole < n and left:                     # fewer than one more window takes
                over, left = left, 0
                put(room - over * length, 1, [*inside, (length, over)])
            put(room - copies * length, whole, [*inside, (length, copies)])
            if inside:
                put(room, n - whole - (over > 0), inside)
    return [(n, inside, room) for room, found in rooms.items() for n, inside in found]


class Plan:
    """Where the k-th piece of each length goes.

    ``ranges``: one row per range of ranks, sorted by (length, lo), with columns
    length, lo, first sequence, copies in one sequence, first slot, first place
    in the sequence; or -1 as sequence and the place in the cut stream as slot.
    """

    def __init__(self, histogram: np.ndarray, window: int):
        self.window = window
        have = histogram.astype(np.int64).copy()
        taken = np.zeros_like(have)            # ranks of each length that have a place
        rows, self.sequences, self.padding = [], 0, 0

        def place(length, n, sequence, copies, slot, first):
            rows.append((length, taken[length], sequence, copies, slot, first))
            taken[length] += n
            have[length] -= n

        if have[window]:
            place(window, int(have[window]), self.sequences, 1, 0, 0)
            self.sequences += int(taken[window])
        # combinations of length steps; the longest lengths of a step are used first
        steps = STEPS if window % STEPS == 0 and window >= STEPS else window
        width = window // steps
        step = -(-np.arange(window + 1) // width)
        combos = combinations(steps)
        counts = repeat_counts(combos, np.bincount(step, have, steps + 1).astype(np.int64))
        for combo, n in zip(combos[counts > 0].tolist(), counts[counts > 0].tolist()):
            first = 0
            for s in sorted(set(combo) - {0}, reverse=True):
                copies = combo.count(s)
                slots, done = n * copies, 0
                for length in range(min(s * width, window), (s - 1) * width, -1):
                    some = min(int(have[length]), slots - done)
                    if some:
                        place(length, some, self.sequences, copies, done, first)
                        self.padding += some * (s * width - length)
                        done += some
                first += copies
            self.sequences += n
        stream: dict[int, int] = {}
        for n, inside, room in greedy(have, window):
            if room > window // 128:
                for length, copies in inside:
                    stream[length] = stream.get(length, 0) + n * copies
                continue
            for first, (length, copies) in enumerate(inside):
                # places of one window: its lengths one after another
                place(length, n * copies, self.sequences, copies, 0, first * window)
            self.sequences += n
            self.padding += n * room
        self.stream, at = self.sequences, 0
        for length in sorted(stream, reverse=True):
            place(length, stream[length], -1, 0, at, 0)
            at += length * stream[length]
        # the stream is cut at window ends, what is left over at powers of two
        full, rest = divmod(at, window)
        cuts, end = [], full * window
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                end += 1 << bit
                cuts.append(end)
        self.full, self.cuts = full, np.array([full * window, *cuts], dtype=np.int64)
        self.sequences += full + len(cuts)
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 6)
        self.lo, self.where = table[:, 1], table[:, 2:]
        self.first = np.searchsorted(table[:, 0], np.arange(window + 2))

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, size, sequence, place) of the pieces of the rank-th rest of a length."""
        a, b = self.first[length], self.first[length + 1]
        k = a + int(np.searchsorted(self.lo[a:b], rank, "right")) - 1
        sequence, copies, slot, first = self.where[k].tolist()
        rank -= int(self.lo[k])
        if sequence >= 0:
            slot += rank
            return [(0, length, sequence + slot // copies, first + slot % copies)]
        at, out, start = slot + rank * length, [], 0
        while start < length:
            here = at + start
            if here < self.full * self.window:
                sequence = here // self.window
                end = (sequence + 1) * self.window
            else:
                sequence = self.full + int(np.searchsorted(self.cuts, here, "right")) - 1
                end = int(self.cuts[sequence - self.full + 1])
            size = min(length - start, end - here)
            out.append((start, size, self.stream + sequence, here))
            start += size
        return out


# ------------------------------------------------------------------- operator

def _emit(plan, window, id_type, with_ids):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "place"]
    types = [id_type] + [pa.int64()] * 6
    if with_ids:
        names, types = [*names, "ids"], [*types, pa.list_(pa.int32())]
    schema = pa.schema(list(zip(names, types)))

    def run(key, own, starts):
        made = plan.value
        rank = np.zeros(window + 1, np.int64)
        rank[starts.column("length").to_numpy()] = starts.column("before").to_numpy()
        out = []
        for row in own.select(["ids", "counts", "data"]).to_pylist():
            data, at = unpack(row["data"]).astype("<u4"), 0
            for doc, n in zip(row["ids"], unpack(row["counts"]).tolist()):
                whole, rest = divmod(n, window)
                for start, length in [(i * window, window) for i in range(whole)] + [(whole * window, rest)] * (rest > 0):
                    for cut, size, sequence, place in made.pieces(length, int(rank[length])):
                        ids = data[at + start + cut:at + start + cut + size]
                        found = (doc, start + cut, size, zlib.crc32(ids.tobytes()), n, sequence, place)
                        out.append((*found, ids.tolist()) if with_ids else found)
                    rank[length] += 1
                at += n
        columns = list(zip(*out)) if out else [[]] * len(names)
        made_table = pa.table([pa.array(c, t) for c, t in zip(columns, types)], schema=schema)
        out = columns = data = None
        release_memory()
        return made_table
    return run


def pack(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece.

    A document is the ids of its whole text by the vocabulary file ``path``
    (without special tokens) and then ``end_id``; each of its ids lies in exactly
    one piece, and pieces of a sequence lie gapless from offset 0, at most
    ``window`` ids in all. Sequences are numbered from 0 without gaps; their
    padding is at most one 128th of the window each, but for combinations of
    length steps, whose rounding costs up to three steps. ``with_ids`` adds the
    piece's ids.

    Null and empty texts are one id, the end id. Repeated rows, repeated and null
    ids are documents of their own. A very long text is a block of its own, read by one
    task. Documents of equal length are dealt by their place in the table. Other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    made = colocated(token_blocks(docs, path, window, end_id, block_chars, id_col, text_col), "block")
    counted = materialize(made.select("block", F.explode(F.arrays_zip("lengths", "often")).alias("x"))
                          .select("block", F.col("x.lengths").alias("length"), F.col("x.often").alias("n")))
    # at most ``window`` rows
    histogram = np.zeros(window + 1, np.int64)
    for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(Plan(histogram, window))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField("doc_id", id_type)] + [T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "place")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    pieces = (made.select("block", "ids", "counts", "data").groupBy("block").cogroup(starts.groupBy("block"))
              .applyInArrow(_emit(plan, window, to_arrow_type(id_type), with_ids), T.StructType(fields)))
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (pieces.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0).cast("long")))
            .drop("place"))


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of pieces that carry their ids; at most a window's ids in a row."""
    return (pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids")))
