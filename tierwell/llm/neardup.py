"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

1. Documents are reduced to the set of their word shingles. Equal sets are one
   *class*, named by its smallest document id; all further work is on classes.
2. Circulant MinHash: one permutation of the shingle hashes (sigma), then one
   second permutation (pi) read at circularly shifted places, coordinate k
   being min over shingles of pi(sigma(x) + k mod 2**32). Two permutations
   generate the whole signature.
3. Signatures are cut into bands; classes with an equal band share a bucket
   and are candidates. Each class is paired with the bucket's centre (its
   smallest class) only, and the pair is confirmed on the full sets.
4. Confirmed links are joined to components. A bucket whose members are in one
   component is done: no further link changes anything. Of every other
   bucket, the component with most of its members is its *home*.
5. The members outside their home are cut into pieces of bounded size, each
   with a few representatives of the bucket (its first and last outside
   member, the first of the home), and compared piece by piece. That joins
   nearly all of what belongs together; homes are then chosen again.
6. What is still outside its home is compared with the whole home component and
   with everything else that is outside the home in its bucket, in pieces of
   bounded size. Nothing needs repeating: of a candidate pair either both were
   in the home, or one was and the other has met the whole home, or both
   were outside and have met each other.

So every candidate pair is confirmed, or its ends are already connected;
nothing is capped. Comparisons happen inside tasks on pieces of a bucket, so
no pair of a group is ever a row; only links are. Joins on a bucket or a component,
which may hold a third of all classes, are salted by the class.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import block_words, blocks, checkpointed, id_and_text, mix64, release_memory, span_hashes
from ..operators.lookup import broadcast_limit, planned_bytes
from ..session import materialize

#: Rows of a band and number of bands. A pair with similarity 0.8 shares no band
#: with probability (1 - 0.8**ROWS)**BANDS, about 3e-6.
ROWS, BANDS = 5, 32
#: Members of a piece that is compared within one task.
PIECE = 100
_SIGMA, _PI = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def permute(x: np.ndarray, key: np.uint32) -> np.ndarray:
    """A keyed bijection of 32-bit values (in place)."""
    x ^= key
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set of 64-bit hashes: ``size`` coordinates."""
    place = permute((hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32), _SIGMA)
    out = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    shift = np.arange(size, dtype=np.uint32)
    step = max(1, 64_000 // size)
    for at in range(0, len(place), step):
        block = permute(shift[:, None] + place[None, at:at + step], _PI)
        np.minimum(out, block.min(axis=1), out=out)
    return out


def band_keys(hashes: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, distinct between bands."""
    parts = signature(hashes, rows * bands).reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.view(np.int64)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Ascending distinct hashes of each text's runs of ``size`` words (fewer words: one run)."""
    raw, starts, ends, begin = block_words(texts, lower=True)
    word = span_hashes(raw, starts, ends)
    run = word.copy()
    for k in range(1, size):
        full = max(0, len(run) - k)          # a block may hold fewer words than a run
        run[:full] = mix64(run[:full] * np.uint64(0x9E3779B97F4A7C15) + word[k:])
    out = []
    for a, b in zip(begin.tolist(), begin[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(run[a:b - size + 1]))
        elif b > a:
            whole = word[a:a + 1].copy()
            for k in range(a + 1, b):
                whole = mix64(whole * np.uint64(0xC2B2AE3D27D4EB4F) + word[k:k + 1])
            # told apart from runs of full size
            out.append(mix64(whole + np.uint64(b - a)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    a = mix64(s)
    one, two = a.sum(dtype=np.uint64), (a * mix64(s ^ np.uint64(0x5851F42D4C957F2D))).sum(dtype=np.uint64)
    both = np.array([one + np.uint64(len(s)), two ^ np.uint64(len(s))], dtype=np.uint64).view(np.int64)
    return int(both[0]), int(both[1])


def document_sets(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, n, s1, s2, bands)``: size, key and band keys of every document's set.

    Key and bands are null for an empty set and for a row without an id.
    """
    rows = id_and_text(docs, id_col, text_col)
    arrow_id = to_arrow_type(rows.schema["doc_id"].dataType)

    def run(batches):
        for ids, texts in blocks(batches, 1_000_000):
            sets = shingle_sets(texts, shingle)
            used = [len(s) > 0 and i is not None for s, i in zip(sets, ids)]
            keys = [_set_key(s) if u else (None, None) for s, u in zip(sets, used)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, arrow_id), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([band_keys(s) if u else None for s, u in zip(sets, used)], pa.list_(pa.int64()))],
                names=["doc_id", "n", "s1", "s2", "bands"])
        release_memory()

    return rows.mapInArrow(run, T.StructType([
        rows.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()),
        T.StructField("s2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]))


def class_sets(docs: DataFrame, classes: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(cls, hashes)`` for the given classes ``(cls)``, from the text of their first document."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.join(classes.withColumnRenamed("cls", "doc_id"), "doc_id", "left_semi")
    arrow_id = to_arrow_type(rows.schema["doc_id"].dataType)

    def run(batches):
        for ids, texts in blocks(batches, 1_000_000):
            sets = shingle_sets(texts, shingle)
            keys = [_set_key(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, arrow_id), pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([k[1] for k in keys], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["cls", "s1", "s2", "hashes"])
        release_memory()

    sets = rows.mapInArrow(run, T.StructType([
        T.StructField("cls", rows.schema["doc_id"].dataType), T.StructField("s1", T.LongType()),
        T.StructField("s2", T.LongType()), T.StructField("hashes", T.BinaryType())]))
    # repeated rows give the same set again
    return sets.groupBy("cls", "s1", "s2").agg(F.first("hashes").alias("hashes")).select("cls", "hashes")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact Jaccard test of two ascending distinct arrays: 100 * both >= percent * either."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _links_in_piece(percent: int, schema: pa.Schema):
    """Links within a piece: from queries to members, only as many as connect what is connected."""
    def run(key, table):
        ids, ask = table.column("cls").to_pylist(), table.column("ask").to_pylist()
        hold = table.column("hold").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        member = [k for k, h in enumerate(hold) if h]
        flat = np.concatenate([sets[k] for k in member]) if member else np.empty(0, np.uint64)
        owner = np.repeat(np.array(member, dtype=np.int64), size[member]) if member else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        root = list(range(len(ids)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        seen: dict = {}
        for k, i in enumerate(ids):          # rows of one class are one vertex
            root[k] = seen.setdefault(i, k)
        out = []
        for k in (k for k, a in enumerate(ask) if a):
            lo, hi = np.searchsorted(flat, sets[k]), np.searchsorted(flat, sets[k], side="right")
            wide = hi - lo
            at = np.repeat(lo - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
            both = np.bincount(owner[at], minlength=len(ids))
            for m in np.flatnonzero(100 * both >= percent * (size + size[k] - both)).tolist():
                if both[m] and find(m) != find(k):
                    root[find(m)] = find(k)
                    out.append((ids[k], ids[m]))
        return pa.Table.from_arrays([pa.array([x[j] for x in out], schema.field(j).type) for j in (0, 1)],
                                    schema=schema)
    return run


def components(links: DataFrame) -> DataFrame:
    """``(cls, comp)``: the smallest vertex reachable over links ``(a, b)``, for vertices with links.

    Minimum labels spread to neighbours and jump along labels, so rounds grow
    with the logarithm of a component's extent; each round is checkpointed.
    """
    edges = checkpointed(links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
                         .where("a <> b").distinct())
    labels = checkpointed(edges.groupBy(F.col("a").alias("cls"))
                          .agg(F.min("b").alias("comp")).select("cls", F.least("cls", "comp").alias("comp")))
    while True:
        near = (edges.join(labels.withColumnRenamed("cls", "b"), "b")
                .groupBy(F.col("a").alias("cls")).agg(F.min("comp").alias("near")))
        spread = labels.join(near, "cls").select("cls", F.col("comp").alias("old"),
                                                 F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("cls").alias("comp"), F.col("comp").alias("further"))
        spread = checkpointed(spread.join(jump, "comp", "left")
                              .select("cls", "old", F.least("comp", "further").alias("comp")))
        labels = spread.select("cls", "comp")
        if spread.where("comp <> old").isEmpty():
            return labels


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after further links: components of the components, a class without one being its own.

    Stored as tables: a checkpoint keeps the estimated bytes of its joins, and
    estimates that multiply round by round bring the planner to a halt.
    """
    ends = links.select(F.col("a").alias("cls")).union(links.select(F.col("b").alias("cls"))).distinct()
    comps = materialize(comps.union(ends.join(comps, "cls", "left_anti").select("cls", F.col("cls").alias("comp"))))
    a = comps.select(F.col("cls").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("cls").alias("b"), F.col("comp").alias("cb"))
    up = components(materialize(links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
    up = up.select(F.col("cls").alias("comp"), F.col("comp").alias("further"))
    return materialize(comps.join(up, "comp", "left").select("cls", F.coalesce("further", "comp").alias("comp")))


#: Salts of a join on a bucket or component.
SALTS = 32


def _salted(rows: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """``rows`` (with a class) joined with one row per ``key``; a hot key is spread over ``SALTS`` tasks.

    ``sizes`` is stored, so Spark knows its bytes. Below its broadcast threshold it is joined as it is,
    without salts: no row moves then. Spark's estimate does not see the copies of a salted table, so one
    that has them is never broadcast.
    """
    if planned_bytes(sizes) <= broadcast_limit(rows.sparkSession):
        return rows.join(sizes, key)
    left = rows.withColumn("_salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int"))
    right = sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right.hint("merge"), [key, "_salt"]).drop("_salt")


def _outside(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, cls, comp, home, first): members outside their bucket's home, and the home's first member there."""
    own = materialize(buckets.join(comps, "cls", "left").select("bucket", "cls", F.coalesce("comp", "cls").alias("comp")))
    tally = own.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.min("cls").alias("first"))
    homes = materialize(tally.groupBy("bucket").agg(F.max(F.struct("n", "comp", "first")).alias("h"), F.count("*").alias("k"))
                        .where("k > 1").select("bucket", F.col("h.comp").alias("home"), F.col("h.first").alias("first")))
    return materialize(_salted(own, homes, "bucket").where("comp <> home"))


def _piece_of(column: str, pieces: str):
    return F.pmod(F.xxhash64(column), F.col(pieces)).cast("int")


def _numbers(pieces: str):
    return F.explode(F.sequence(F.lit(0), F.col(pieces).cast("int") - 1))


def _open(outside: DataFrame) -> DataFrame:
    """One row per bucket with members outside; of buckets that gather the same members, one is kept."""
    return (outside.groupBy("bucket").agg(
        F.count("*").alias("size"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("same"),
        F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.min("comp").alias("one"), F.max("comp").alias("two"),
        F.min("home").alias("home"), F.min("first").alias("first"))
        .groupBy("size", "same", "lo", "hi", "home", "one", "two").agg(F.min(F.struct("bucket", "first")).alias("b"))
        .select("b.*", "lo", "hi", "one", "two", F.ceil(F.col("size") / PIECE).alias("pieces")))


def _side(side: bool, g1, g2, g3, ask: bool, hold: bool) -> list:
    return [F.lit(side).alias("side"), g1.alias("g1"), g2.alias("g2"), g3.alias("g3"), F.col("cls"),
            F.lit(ask).alias("ask"), F.lit(hold).alias("hold")]


def _near_pieces(outside: DataFrame) -> DataFrame:
    """Pieces ``(side, g1, g2, g3, cls, ask, hold)`` of the members outside, with the bucket's representatives in each."""
    open_ = materialize(_open(outside))
    nil = F.lit(0)
    own = _salted(outside.select("bucket", "cls"), open_.select("bucket", "pieces"), "bucket").select(
        *_side(True, F.col("bucket"), _piece_of("cls", "pieces"), nil, True, True))
    first = (open_.select("bucket", _numbers("pieces").alias("n"), F.array("lo", "hi", "first").alias("c"))
             .select("bucket", "n", F.explode("c").alias("cls")).distinct()
             .select(*_side(True, F.col("bucket"), F.col("n"), nil, True, True)))
    return own.union(first)


def _all_pieces(outside: DataFrame, comps: DataFrame) -> DataFrame:
    """Pieces in which every member outside meets its whole home, and all others outside of its bucket."""
    # homes are components; their names and classes' names are of one kind, and so are buckets' (a long)
    asked = outside.select(F.col("home").alias("comp"), "cls").distinct()
    lone = outside.select(F.col("home").alias("comp")).distinct().join(comps, "comp", "left_anti")
    held = comps.select("comp", "cls").union(lone.select("comp", F.col("comp").alias("cls")))
    sizes = (asked.groupBy("comp").agg(F.ceil(F.count("*") / PIECE).alias("asks"))
             .join(held.groupBy("comp").agg(F.ceil(F.count("*") / PIECE).alias("holds")), "comp")
             .withColumn("name", F.xxhash64("comp")))
    sizes = materialize(sizes)
    # different homes under one name would only compare more: a piece's links are confirmed on their sets
    ask = _salted(asked, sizes, "comp").select(
        *_side(False, F.col("name"), _piece_of("cls", "asks"), _numbers("holds"), True, False))
    hold = _salted(held, sizes, "comp").select(
        *_side(False, F.col("name"), _numbers("asks"), _piece_of("cls", "holds"), False, True))
    several = materialize(_open(outside).where("one <> two").select("bucket", "pieces"))
    among = (_salted(outside.select("bucket", "cls"), several, "bucket")
             .withColumn("own", _piece_of("cls", "pieces")).withColumn("other", _numbers("pieces"))
             .select(*_side(True, F.col("bucket"), F.least("own", "other"), F.greatest("own", "other"), True, True)))
    return ask.union(hold).union(among)


def find_components(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every document.

    Texts are lowered (A-Z) and cut into words at ASCII white space; a
    document's set holds its distinct runs of ``shingle`` words (fewer words:
    the whole sequence; none: empty). Documents with
    100 * intersection >= percent * union are linked; the component is the
    smallest id reachable. Empty sets are linked with nothing. Rows without
    an id are linked with nothing, have no component and are kept. Repeated
    rows get the same component; a repeated id with another text is judged by
    that text. An empty table gives an empty result.
    A very long text is read whole, by one task; nothing is cut off.
    """
    sets = checkpointed(document_sets(docs, shingle, id_col, text_col))
    classes = checkpointed(sets.where("s1 is not null").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("cls"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    spread = classes.select("cls", "n", F.explode("bands").alias("bucket"))
    centres = (spread.groupBy("bucket").agg(F.count("*").alias("size"), F.min("cls").alias("centre"))
               .where("size > 1").select("bucket", "centre"))
    buckets = checkpointed(spread.join(centres, "bucket").select("bucket", "cls", "n", "centre"))
    hashes = checkpointed(class_sets(docs, buckets.select("cls").distinct(), shingle, id_col, text_col))
    id_type = sets.schema["doc_id"].dataType
    link_type = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)])
    arrow = pa.schema([(n, to_arrow_type(id_type)) for n in ("a", "b")])

    own = hashes.select(F.col("cls").alias("a"), F.col("hashes").alias("ha"))
    mid = hashes.select(F.col("cls").alias("b"), F.col("hashes").alias("hb"))
    pairs = buckets.where("cls <> centre").select(F.col("cls").alias("a"), F.col("centre").alias("b")).distinct()
    links = checkpointed(pairs.join(own, "a").join(mid, "b").select("a", "b", "ha", "hb")
                         .mapInArrow(_confirm(percent), link_type))

    def joined(comps: DataFrame, pieces: DataFrame) -> DataFrame:
        found = materialize(pieces.join(hashes, "cls").groupBy("side", "g1", "g2", "g3")
                            .applyInArrow(_links_in_piece(percent, arrow), link_type))
        return comps if found.isEmpty() else merged(comps, found)

    comps, buckets = materialize(components(links)), buckets.select("bucket", "cls")
    for pieces in (lambda out, _: _near_pieces(out), _all_pieces):
        outside = _outside(buckets, comps)
        if outside.isEmpty():
            break
        comps = joined(comps, pieces(outside, comps))

    named = classes.select("s1", "s2", "cls").join(comps, "cls", "left") \
        .select("s1", "s2", F.coalesce("comp", "cls").alias("comp"))
    component = F.coalesce("comp", "doc_id")
    return (sets.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The documents with one of each component left (that of the smallest id); the columns stay."""
    gone = find_components(docs, shingle, percent, id_col, text_col).where("not kept")
    gone = gone.select(F.col("doc_id").alias(f"gone_{uuid.uuid4().hex}")).distinct()
    return docs.join(gone, docs[id_col] == gone[gone.columns[0]], "left_anti")
