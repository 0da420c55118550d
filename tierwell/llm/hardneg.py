"""Hard-negative mining over lists that clusters of anchors share.

Exact search for the largest inner products, after the MAXIMUS index. Anchors
of similar direction form clusters of at most ``CLUSTER`` members. Candidates are
dealt over lists of about ``LIST_ROWS`` rows. For a cluster and a list, the angle
between a candidate and the cluster's centre, less the widest angle of a member,
bounds the candidate's inner product with every member; the list is sorted by that
bound once, and every member walks it until no later candidate can matter. The best of
every list are then merged per anchor (a ranked window, cut before its shuffle).

Candidates move to their list, clusters are copied to every list; a task streams
clusters past one list at a time, so its memory is one list and one cluster. The
walk runs twice: for the positives (same label), then for the negatives, whose
limits follow from the positives' scores.

Scores are whole numbers: products are taken in the narrowest of 32-bit and
64-bit floats or 64-bit integers in which the vectors' lengths prove them exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize

LIST_ROWS = 8192
CLUSTER = 64
#: The centres that group the anchors are fitted on at most so many anchors, and are at most so many.
FIT_ANCHORS, CENTRES, ROUNDS = 4096, 256, 8


def whole_numbers(vector: Column, scale: float = 256.0) -> Column:
    """``floor(scale * x)`` of each component, as long; null for a vector with a component that is no finite number."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(False)), F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")))


# ------------------------------------------------------------------ the walk

def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of whole numbers; shorter ones are filled up with zeros."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(size.max(initial=0)))
    if len(size) * width == len(flat):
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _unit(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, rows of length one; zero rows stay zero)."""
    x = a.astype(np.float64)
    size = np.sqrt((x * x).sum(axis=1))
    return size, x / np.where(size > 0, size, 1)[:, None]


class Candidates:
    """One list's rows, as a task holds them."""

    def __init__(self, ids, labels, vectors):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.size, self.unit = _unit(vectors)

    def sorted_for(self, vectors: np.ndarray):
        """(order, bound): candidates by falling upper bound of cosine times length for a cluster's members."""
        size, unit = _unit(vectors)
        centre = unit.sum(axis=0)
        centre /= np.linalg.norm(centre) or 1.0
        spread = np.arccos(np.clip(unit @ centre, -1, 1)).max()
        common = min(len(centre), self.unit.shape[1])
        angle = np.arccos(np.clip(self.unit[:, :common] @ centre[:common], -1, 1)) - spread
        bound = self.size * np.cos(np.maximum(angle, 0))
        order = np.argsort(-bound, kind="stable")
        return size, order, bound[order]

    def walk(self, vectors, need, keep):
        """Blocks of the list in order until every member is certified.

        ``need(limit)`` tells which members still need candidates whose score is at
        most ``limit`` (one number a member); ``keep(members, rows, scores)`` takes a block.
        """
        width = max(vectors.shape[1], self.vectors.shape[1])
        vectors, own = _wide(vectors, width), _wide(self.vectors, width)
        size, order, bound = self.sorted_for(vectors)
        most = size.max(initial=0) * self.size.max(initial=0)
        kind = np.float32 if most < 2 ** 23 else np.float64 if most < 2 ** 52 else np.int64
        at, step = 0, 256
        while at < len(order):
            # rounding of the bound itself is covered by a little more than its precision
            active = np.flatnonzero(need(size * bound[at] + 1e-9 * most + 1))
            if not len(active):
                break
            rows = order[at:at + step]
            scores = (vectors[active].astype(kind) @ own[rows].astype(kind).T).astype(np.int64)
            keep(active, rows, scores)
            at, step = at + step, min(2 * step, 4096)


def _best(keys, scores, ids, n):
    """The first n of each key by falling score, then id."""
    order = np.lexsort((ids, -scores, keys))
    k = keys[order]
    first = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(k)), 0)) if len(k) else np.empty(0, np.int64)
    return order[np.arange(len(k)) - start < n]


class _Kept:
    """The best so far of each key, and the score that a newcomer must reach."""

    def __init__(self, keys: int, n: int):
        self.n, self.keys = n, np.empty(0, np.int64)
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = np.full(keys, np.iinfo(np.int64).min)

    def add(self, keys, scores, ids):
        if not len(keys):
            return
        keys, scores, ids = (np.concatenate(x) for x in
                             ((self.keys, keys), (self.scores, scores), (self.ids, ids)))
        at = _best(keys, scores, ids, self.n)
        self.keys, self.scores, self.ids = keys[at], scores[at], ids[at]
        full, count = np.unique(self.keys, return_counts=True)
        last = np.cumsum(count) - 1
        self.least[full[count == self.n]] = self.scores[last[count == self.n]]


def _positives(n):
    def find(there: Candidates, row):
        ids, labels = np.array(row["ids"], np.int64), np.array(row["labels"], np.int64)
        best = _Kept(len(ids), n)

        def keep(members, rows, scores):
            ok = ((labels[members][:, None] == there.labels[rows]) & (ids[members][:, None] != there.ids[rows])
                  & (scores >= best.least[members][:, None]))
            m, c = np.nonzero(ok)
            best.add(members[m], scores[m, c], there.ids[rows[c]])

        there.walk(row["vectors"], lambda limit: best.least <= limit, keep)
        return best.keys, np.zeros(len(best.keys), np.int64), best.scores, best.ids
    return find


def _negatives(n, low, high):
    def find(there: Candidates, row):
        labels = np.array(row["labels"], np.int64)
        # one key a member and positive, in member order; whole-number limits of its scores
        member = np.array(row["members"], np.int64)
        place = np.array(row["places"], np.int64)
        score = [int(x) for x in row["scores"]]
        lo = np.array([-(-low * s // 100) for s in score], np.int64)
        hi = np.array([high * s // 100 for s in score], np.int64)
        best = _Kept(len(member), n)

        def need(limit):
            open_ = np.zeros(len(labels), bool)
            open_[member[(lo <= hi) & (np.maximum(lo, best.least) <= limit[member])]] = True
            return open_

        def keep(members, rows, scores):
            other = labels[members][:, None] != there.labels[rows]
            at = np.full(len(labels), -1)
            at[members] = np.arange(len(members))
            for k in np.flatnonzero(at[member] >= 0).tolist():
                line = scores[at[member[k]]]
                c = np.flatnonzero((line >= max(lo[k], best.least[k])) & (line <= hi[k]) & other[at[member[k]]])
                if len(c):
                    found.append((np.full(len(c), k), line[c], there.ids[rows[c]]))
            if found:
                best.add(*(np.concatenate(x) for x in zip(*found)))
                found.clear()

        found: list = []
        there.walk(row["vectors"], need, keep)
        return member[best.keys], place[best.keys], best.scores, best.ids
    return find


_STREAM = ["list", "cluster", "ids", "labels", "vectors", "members", "places", "scores"]
_FOUND = "cluster long, member long, place long, score long, id long"


def _search(find):
    """Rows arrive by list, candidates (cluster -1) first; every cluster meets the list."""
    def run(batches):
        now, held, there = None, [], None
        for batch in batches:
            lists, clusters = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            # runs of candidates are taken as columns, clusters one by one
            edge = np.flatnonzero(np.diff((clusters >= 0).astype(np.int8))) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(clusters)]):
                part = batch.slice(lo, hi - lo)
                if clusters[lo] < 0:
                    for a, b in _runs(lists[lo:hi]):
                        if lists[lo + a] != now:
                            now, held, there = lists[lo + a], [], None
                        held.append(part.slice(a, b - a))
                    continue
                for i, row in enumerate(part.select(["cluster", "members", "places", "scores"]).to_pylist()):
                    if lists[lo + i] != now:         # a list without candidates
                        continue
                    if there is None:
                        there = Candidates(*_columns(held))
                        held = []
                    one = part.slice(i, 1)
                    row["ids"] = one.column(2).flatten().to_numpy(zero_copy_only=False)
                    row["labels"] = one.column(3).flatten().to_numpy(zero_copy_only=False)
                    row["vectors"] = _matrix(one.column(4).flatten())
                    member, place, score, ids = find(there, row)
                    if len(ids):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(ids), row["cluster"])), pa.array(member), pa.array(place),
                             pa.array(score), pa.array(ids)], names=["cluster", "member", "place", "score", "id"])
    return run


def _runs(values):
    edge = [i for i in range(1, len(values)) if values[i] != values[i - 1]]
    return zip([0, *edge], [*edge, len(values)])


def _columns(parts):
    ids = np.concatenate([p.column(2).flatten().to_numpy(zero_copy_only=False) for p in parts])
    labels = np.concatenate([p.column(3).flatten().to_numpy(zero_copy_only=False) for p in parts])
    made = [_matrix(p.column(4).flatten()) for p in parts]
    width = max(m.shape[1] for m in made)
    return ids, labels, np.concatenate([_wide(m, width) for m in made])


# --------------------------------------------------------------- clusters

def _centres(anchors: DataFrame, wanted: int) -> np.ndarray:
    """Directions that group the anchors, by spherical k-means on a bounded sample of them."""
    sample = (anchors.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(FIT_ANCHORS).collect())
    width = max((len(r["vector"]) for r in sample), default=0)
    points = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        points[i, :len(r["vector"])] = r["vector"]
    if not sample:
        return points
    points = _unit(points)[1]
    rnd = np.random.default_rng(0)
    centres = points[rnd.permutation(len(points))[:wanted]]
    for _ in range(ROUNDS):
        near = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        moved = _unit(sums)[1]
        centres = np.where(np.abs(moved).sum(axis=1)[:, None] > 0, moved, centres)
    return centres


def _nearest(centres: np.ndarray):
    def run(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(2)))[1]
            width = max(unit.shape[1], centres.shape[1])
            cosine = _wide(unit, width) @ _wide(centres, width).T
            near = cosine.argmax(axis=1) if len(unit) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int64)),
                 pa.array(cosine[np.arange(len(near)), near] if len(unit) else np.empty(0))],
                names=["id", "label", "vector", "centre", "cosine"])
    return run


def _cut(members: int):
    """Sorted anchors into clusters of one centre and at most ``members`` rows."""
    def run(batches):
        from pyspark import TaskContext
        task, n, held, now = TaskContext.get().partitionId(), 0, [], None

        def cluster():
            ids, labels, vectors = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 33 | n], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([labels], pa.list_(pa.int64())), pa.array([vectors], pa.list_(pa.list_(pa.int64())))],
                names=["cluster", "ids", "labels", "vectors"])

        for batch in batches:
            for i, label, vector, centre in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held and (centre != now or len(held) >= members):
                    yield cluster()
                    n, held = n + 1, []
                now = centre
                held.append((i, label, vector))
        if held:
            yield cluster()
    return run


def _clusters(anchors: DataFrame, count: int) -> DataFrame:
    centres = _centres(anchors, max(1, min(CENTRES, count // CLUSTER)))
    vectors = "id long, label long, vector array<long>"
    near = (anchors.select("id", "label", "vector")
            .mapInArrow(_nearest(centres), vectors + ", centre long, cosine double"))
    return (near.repartitionByRange("centre", "cosine", "id").sortWithinPartitions("centre", "cosine", "id")
            .mapInArrow(_cut(CLUSTER), "cluster long, ids array<long>, labels array<long>, vectors array<array<long>>"))


# ------------------------------------------------------------------- operator

def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         id_col: str = "id", label_col: str = "label", vector_col: str = "vector",
         anchor_col: str = "anchor") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vector_col`` holds whole numbers (see ``whole_numbers``); a score is their
    inner product. An anchor's positives are its ``positives`` highest other rows of
    the same label; for each, the ``negatives`` highest rows of other labels whose score
    lies between ``low`` and ``high`` percent of the positive's, both included. Higher scores come
    first, ties by smaller id.

    Rows without id, label or vector, or with a null component, take no part, nor does a
    row whose squared length reaches 2**62 (its scores might not fit a long). Vectors of
    unequal length are compared as if the shorter were filled up with zeros. A repeated row
    counts each time; rows that share an anchor's id are none of its positives. A positive of
    negative score has no negatives; an anchor without positives, and an empty table, give no
    rows. Other columns are not read.
    A very long vector is one row, held by one task.
    """
    usable = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                         F.col(vector_col).cast("array<long>").alias("vector"),
                         F.coalesce(F.col(anchor_col), F.lit(False)).alias("anchor"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = usable.where("id is not null and label is not null and vector is not null").where(square < 2.0 ** 62)
    usable = materialize(usable)
    count = usable.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).head()
    lists = max(1, -(-count["n"] // LIST_ROWS))
    clusters = materialize(_clusters(usable.where("anchor"), count["anchors"]))

    none = F.array().cast("array<long>")
    dealt = F.pmod(F.xxhash64("id"), F.lit(lists))
    one = usable.select(dealt.alias("list"), F.lit(-1).cast("long").alias("cluster"), F.array("id").alias("ids"),
                        F.array("label").alias("labels"), F.array("vector").alias("vectors"),
                        none.alias("members"), none.alias("places"), none.alias("scores"))

    def search(of: DataFrame, find) -> DataFrame:
        copies = of.withColumn("list", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lists - 1).cast("long"))))
        return (one.unionByName(copies.select(*_STREAM)).repartition("list").sortWithinPartitions("list", "cluster")
                .mapInArrow(_search(find), _FOUND))

    def first(found: DataFrame, n: int) -> DataFrame:
        order = Window.partitionBy("cluster", "member", "place").orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    best = materialize(first(search(clusters.select("*", *[none.alias(c) for c in ("members", "places", "scores")]),
                                    _positives(positives)), positives))
    # at most CLUSTER * positives rows a cluster
    own = F.array_sort(F.collect_list(F.struct("member", "rank", "score")))
    wanted = (clusters.join(best.groupBy("cluster").agg(own.alias("p")), "cluster")
              .select("cluster", "ids", "labels", "vectors", F.col("p.member").alias("members"),
                      F.transform("p.rank", lambda r: r.cast("long")).alias("places"), F.col("p.score").alias("scores")))
    found = first(search(wanted, _negatives(negatives, low, high)), negatives)
    named = (best.select("cluster", "member", F.col("rank").cast("long").alias("place"),
                         F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    anchors = clusters.select("cluster", F.posexplode("ids").alias("member", "anchor_id"))
    return (found.join(named, ["cluster", "member", "place"])
            .join(anchors.withColumn("member", F.col("member").cast("long")), ["cluster", "member"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
