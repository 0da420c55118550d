"""Substring dedup against brute force, and the FM-index by itself."""

import random

import numpy as np
import pytest

from tierwell.llm import substrings
from tierwell.llm.fmindex import FMIndex, WaveletMatrix


def brute(docs, window):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    key = lambda i, s: (i is not None, i if i is not None else 0, s)
    for i, w in words:
        for s in range(len(w) - window + 1):
            p = tuple(w[s:s + window])
            first[p] = min(first.get(p, key(i, s)), key(i, s))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < key(i, s):
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def make(seed):
    rnd = random.Random(seed)
    vocab = [f"v{k}" for k in range(40)] + ["é", "\xa0x"]
    passages = [rnd.choices(vocab, k=rnd.randint(4, 40)) for _ in range(8)]
    docs = []
    for i in range(160):
        w = []
        for _ in range(rnd.randint(0, 4)):
            w += rnd.choices(vocab, k=rnd.randint(0, 25))
            if rnd.random() < 0.6:
                p = rnd.choice(passages)
                a = rnd.randint(0, len(p) // 2)
                w += p[a:a + rnd.randint(3, 40)]
        docs.append((i * 7 % 160, rnd.choice([" ", "\n", "\t "]).join(w)))
    docs += [(500, docs[3][1]), (501, docs[3][1]), (502, "a " * 300), (503, "a b " * 100), (504, None), (505, ""),
             (None, docs[4][1]), (None, docs[4][1]), (7, docs[9][1]), (7, "z " + docs[9][1])]
    return docs


@pytest.mark.parametrize("frequent", [1000, 5])
def test_removed_words_equal_brute_force(spark, frequent, monkeypatch):
    monkeypatch.setattr(substrings, "FREQUENT", frequent)
    monkeypatch.setattr(substrings, "SEGMENT", 6)
    for seed in (1, 2):
        docs = make(seed)
        df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, block int").repartition(4)
        got = substrings.remove_repeats(df, window=8, block_chars=1500).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(docs, 8)
        assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_default_window_empty_and_string_ids(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = [("b", text), ("a", "x " + text + " y"), ("c", " ".join(text.split()[:19]))]
    df = spark.createDataFrame(docs, "doc_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df).collect()}
    assert got["b"] == (30, 30, "") and got["a"][1] == 0 and got["c"][1] == 0
    assert substrings.remove_repeats(df.where("false")).collect() == []


def test_wavelet_ranks_and_search():
    rnd = np.random.default_rng(3)
    values = rnd.integers(0, 23, 1000)
    tree = WaveletMatrix(values, 5)
    at, sym = rnd.integers(0, 1001, 300), rnd.integers(0, 23, 300).astype(np.uint32)
    assert tree.rank(sym, at).tolist() == [int((values[:a] == s).sum()) for a, s in zip(at, sym)]
    parts = [rnd.integers(1, 4, n).tolist() for n in (50, 3, 80, 40)]
    text = np.array([x for p in parts for x in [*p, 0]])
    index, depth = FMIndex(text, 5), 5
    ends = np.array([e for e in range(4, len(text)) if (text[e - 4:e + 1] > 0).all()])
    found, first = index.repeated(ends)
    seqs = [tuple(text[e - 4:e + 1]) for e in ends]
    want = {k: ends[seqs.index(s)] - depth + 1 for k, s in enumerate(seqs) if seqs.count(s) > 1}
    assert dict(zip(found.tolist(), first.tolist())) == want
