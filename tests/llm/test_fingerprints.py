"""Edited texts exactly, sketches against a plain computation, merging and containment."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tierwell.llm import fingerprints as fp


def edits(docs):
    order = sorted(docs, key=lambda d: d[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[i] = (len(t), t[:len(t) - half] + after[:half])
    return out


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(6)
    vocab = [f"wörd{k}" for k in range(60)] + ["𝒳", "a"]
    out = [(i * 3, " ".join(rnd.choices(vocab, k=rnd.randint(0, 200)))) for i in range(400)]
    out += [(1, None), (2, ""), (4, " \n"), (5, "one"), (7, "x" * 50001), (8, out[50][1]), (10, out[50][1])]
    return out


def test_edited_texts_and_likeness(spark, docs):
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, ghost int").repartition(7)
    rows = {r.doc_id: r for r in fp.digests(fp.compare_with_edits(df)).collect()}
    want = edits(docs)
    assert len(rows) == len(docs)
    for i, (n, edited) in want.items():
        assert (rows[i].n_chars, rows[i].edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    assert rows[8].fingerprint == rows[10].fingerprint and rows[8].near_next <= 1
    texts = dict(docs)
    long = [i for i, t in docs if len((t or "").split()) > 100]
    assert 0.3 < sum(rows[i].near_edited for i in long) / len(long) < 0.7
    assert sum(rows[i].near_next for i in long) / len(long) < 0.1
    same = fp.fingerprint(df).where("doc_id in (8, 10)").select("sketch").distinct().count()
    assert same == 1 and texts[8] == texts[10]


def test_ties_nulls_and_lone_rows(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    (r,) = fp.compare_with_edits(one).collect()
    assert r.edited == "abab" and r.near_next == 1.0
    assert fp.compare_with_edits(one.where("false")).collect() == []
    tied = spark.createDataFrame([(None, "zz")] * 3 + [(1, "ab cd")] * 4 + [(1, None)], "doc_id long, text string")
    got = fp.digests(fp.compare_with_edits(tied)).collect()
    assert len(got) == 8
    words = spark.createDataFrame([("b", "x y"), ("a", "z")], "doc_id string, text string")
    assert {r.doc_id: r.edited for r in fp.compare_with_edits(words).collect()} == {"a": "z", "b": "x z"}


def test_sketch_is_a_fixed_share_and_merges(spark):
    text = lambda a, b: " ".join(f"w{k}" for k in range(a, b))
    df = spark.createDataFrame([(text(0, 4000), text(1000, 1400), text(3000, 7000))], "a string, b string, c string")
    for c in "abc":
        df = fp.add_sketch(df, c, f"s{c}")
    r = df.select(F.size("sa"), fp.containment(F.col("sa"), F.col("sb")), fp.containment(F.col("sa"), F.col("sc")),
                  F.size(fp.merge(F.col("sa"), F.col("sc")))).head()
    assert 850 < r[0] < 1150 and r[1] > 0.97 and 0.2 < r[2] < 0.3 and 1550 < r[3] < 1950
