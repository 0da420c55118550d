"""Hard negatives against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwell.llm import hardneg

SCHEMA = "id long, label int, embedding array<float>, anchor boolean, list string, score int"


def brute(rows, positives=5, negatives=10, low=30, high=90, scale=256.0):
    usable = []
    for i, label, v, anchor, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, label, [int(np.floor(scale * float(np.float32(x)))) for x in v], anchor))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v, anchor in usable:
        if not anchor:
            continue
        scored = sorted((-dot(v, w), j, k == label) for j, k, w, _ in usable)
        for s, j, _ in [x for x in scored if x[2] and x[1] != i][:positives]:
            found = [x for x in scored if not x[2] and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    df = df.withColumn("vector", hardneg.whole_numbers(F.col("embedding")))
    got = hardneg.mine(df, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dims, seed, labels=4, tight=0.4):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(labels, dims))
    out = []
    for i in range(n):
        label = int(rnd.integers(labels))
        v = centres[label] * tight + rnd.normal(size=dims)
        out.append((i, label, [float(np.float32(x)) for x in v / np.linalg.norm(v)], i % 10 == 0))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hardneg, "LIST_ROWS", 150)
    monkeypatch.setattr(hardneg, "CLUSTER", 8)
    rows = vectors(700, 8, seed)
    hot = rows[3][2]
    # one vector under a third of all rows, ties in every score, repeated rows and ids
    rows += [(1000 + i, i % 3, hot, i % 50 == 0) for i in range(350)]
    rows += [rows[20], rows[20], (20, 3, rows[21][2], True), (40, 1, rows[5][2], False)]
    rows += [(5000, 1, [0.0] * 8, True), (5001, None, hot, True), (5002, 1, None, True), (5003, 1, [None] + hot[1:], True),
             (5004, 1, [float("nan")] + hot[1:], True), (5005, 1, [float("inf")] + hot[1:], False),
             (None, 1, hot, True), (5006, 1, hot, None), (5007, 9, hot, True), (5008, 1, [], True),
             (5009, 2, hot[:5], True), (5010, 2, [*hot, 0.5, -0.25], True), (5011, 1, [-x for x in hot], True)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, positives=2, negatives=3, low=0, high=100) == brute(rows, 2, 3, 0, 100)


def test_large_components(spark):
    rnd = random.Random(4)
    rows = [(i, i % 2, [float(np.float32(rnd.uniform(-1, 1) * 10 ** rnd.choice([0, 4, 6]))) for _ in range(4)], i % 5 == 0)
            for i in range(60)]
    assert mined(spark, rows) == brute(rows)
    # lengths past a long take no part
    far = [*rows, (900, 0, [3e38] * 4, True), (901, 1, [1e30, 0.0, 0.0, 0.0], False)]
    assert mined(spark, far) == brute(rows)


def test_walk_ends_early_on_a_tight_cluster():
    """The certificate holds: of a long list only its head is read."""
    rnd = np.random.default_rng(0)
    near = np.zeros((500, 16), np.int64)
    near[:, 0] = 200
    near += rnd.integers(-8, 9, near.shape)
    far = rnd.integers(-8, 9, (20_000, 16))
    labels = np.zeros(20_500, np.int64)
    there = hardneg.Candidates(np.arange(20_500), labels, np.concatenate((far, near)))
    read = []
    row = {"ids": np.arange(30_000, 30_008), "labels": np.zeros(8, np.int64), "vectors": near[:8]}
    walk = there.walk
    there.walk = lambda v, need, keep: walk(v, need, lambda m, r, s: (read.append(len(r)), keep(m, r, s)))
    members, _, scores, ids = hardneg._positives(5)(there, row)
    assert sum(read) < 2000
    exact = there.vectors @ near[:8].T
    for m in range(8):
        best = sorted((-int(exact[c, m]), c) for c in range(20_500))[:5]
        assert sorted((-s, i) for k, s, i in zip(members, scores, ids) if k == m) == best


def test_no_anchors_and_empty_table(spark):
    assert mined(spark, [(1, 1, [0.5], False), (2, 1, [0.5], None)]) == []
    assert mined(spark, [(1, 1, [0.5], True)]) == []
    assert mined(spark, []) == []
