"""Near-duplicate components against brute force over all pairs."""

import random

import numpy as np
import pytest

from tierwell.llm import neardup


def brute(docs, shingle, percent):
    sets = {}
    for i, t in docs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")).encode().split()
        sets[i] = frozenset(tuple(w[k:k + shingle]) for k in range(len(w) - shingle + 1)) if len(w) >= shingle \
            else frozenset([tuple(w)] if w else [])
    ids = sorted(sets)
    comp = {i: i for i in ids}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    comp[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def make(seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    docs, i = [], 0
    for _ in range(40):
        base = rnd.choices(vocab, k=rnd.choice([1, 2, 3, 12, 60, 200]))
        for _ in range(rnd.choice([1, 2, 3, 25])):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 9))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            docs.append((i, rnd.choice([" ", "\n", "  "]).join(w)))
            i += 1
    # a chain: each like the one before, far from the first
    w = rnd.choices(vocab, k=150)
    for _ in range(30):
        w = list(w)
        for _ in range(4):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        docs.append((i, " ".join(w)))
        i += 1
    # a common passage in otherwise different texts
    shared = " ".join(rnd.choices(vocab, k=60))
    for _ in range(150):
        docs.append((i, shared + " " + " ".join(rnd.choices(vocab, k=rnd.randint(15, 40)))))
        i += 1
    docs += [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "\xa0"), (i + 4, "A a A a"), (i + 5, "a A a")]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("shingle", [2, 5])
def test_components_equal_brute_force(spark, shingle, monkeypatch):
    monkeypatch.setattr(neardup, "PIECE", 7)
    docs = make()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, comp string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in neardup.find_components(df, shingle, 80).collect()}
    assert got == brute(docs, shingle, 80)


def test_repeated_rows_and_nulls(spark):
    docs = [(3, "a b c d"), (3, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, None), (7, "z")] + [(9, "q r")] * 300
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.find_components(df, 2).collect()), key=str)
    assert got == sorted([(3, 1, False)] * 2 + [(1, 1, True), (7, 7, True)] + [(None, None, True)] * 2
                         + [(9, 9, True)] * 300, key=str)
    assert neardup.drop_near_duplicates(df, 2).count() == 304
    assert neardup.find_components(df.where("false"), 2).collect() == []


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "x y z"), ("a", "X Y Z")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in neardup.find_components(df, 2).collect()} == {"a": "a", "b": "a"}


def test_signature_estimates_jaccard():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate((a[:800], rnd.integers(0, 2**63, 200, dtype=np.uint64)))
    same = np.mean(neardup.signature(a, 1000) == neardup.signature(b, 1000))
    assert abs(same - 800 / 1200) < 0.06


def chain(n):
    """Texts each like the next only: 20 words, two further every time (18 of 22; then 16 of 24)."""
    return [" ".join(f"w{k}" for k in range(2 * i, 2 * i + 20)) for i in range(n)]


@pytest.mark.parametrize("texts, bands", [
    # centre 0; 2 joins by 1, so 3 (and then 4, 5) must meet what joined
    (chain(4), [[1], [1], [1], [1]]),
    (chain(6), [[1]] * 6),
    # the lone centre (3) of bucket 1 joins the component of 4 by bucket 3; 5 is like 4 only
    ([chain(9)[k] for k in (0, 8, 1, 2, 4, 5)] + [chain(9)[3]], [[9], [9], [2, 3], [1, 3], [1, 2], [1], [2, 3, 4]]),
    # two chains under one centre that is like neither
    (["z " * 3] + chain(3) + [t.replace("w", "v") for t in chain(3)], [[1]] * 7),
])
def test_every_pair_of_a_bucket_is_confirmed(spark, monkeypatch, texts, bands):
    from pyspark.sql import functions as F
    plain = neardup.document_sets
    table = spark.createDataFrame([(i, b) for i, b in enumerate(bands)], "doc_id long, bands array<long>")
    monkeypatch.setattr(neardup, "document_sets", lambda *a: plain(*a).drop("bands").join(table, "doc_id")
                        .select("doc_id", "n", "s1", "s2", F.col("bands")))
    docs = list(enumerate(texts))
    sets = [frozenset(t.split()) for t in texts]
    got = {r.doc_id: r.component_id for r in
           neardup.find_components(spark.createDataFrame(docs, "doc_id long, text string"), 1).collect()}
    whole = {i: v[1] for i, v in brute(docs, 1, 80).items()}
    for a, x in docs:
        for b, y in docs:
            if a < b and set(bands[a]) & set(bands[b]) and \
                    100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                assert got[a] == got[b], (a, b)
            if got[a] == got[b]:
                assert whole[a] == whole[b]


@pytest.mark.parametrize("words", [1, 2, 3, 4])
def test_block_of_fewer_words_than_a_shingle(spark, words):
    text = " ".join("abcd"[:words])
    alone = neardup.shingle_sets([text], 5)
    beside = neardup.shingle_sets(["q r s t u v w", text], 5)
    assert len(alone[0]) == 1 and alone[0].tolist() == beside[1].tolist()
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(r) for r in neardup.find_components(df, 5).collect()] == [(1, 1, 1, True)]


def test_dropping_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (2, "a b c", "y")], "doc_id long, text string, `__gone` string")
    kept = neardup.drop_near_duplicates(df, 2)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c", "x")]


def test_copies_of_a_salted_table_are_never_broadcast(spark):
    from tierwell.operators.lookup import planned_bytes
    from tierwell.session import materialize
    rows = spark.range(400).selectExpr("id % 7 as bucket", "id as cls")
    sizes = materialize(spark.range(6).selectExpr("id as bucket", "id + 1 as pieces"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before, limit = spark.conf.get(name), planned_bytes(sizes)
    try:
        for most, copies, broadcast in ((limit, False, True), (limit - 1, True, False)):
            spark.conf.set(name, str(most))
            out = neardup._salted(rows, sizes, "bucket")
            assert sorted((r.bucket, r.cls, r.pieces) for r in out.collect()) == sorted(
                (k % 7, k, k % 7 + 1) for k in range(400) if k % 7 < 6)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert (("explode" in plan), ("BroadcastHashJoin" in plan)) == (copies, broadcast)
    finally:
        spark.conf.set(name, before)
