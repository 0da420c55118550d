"""Phrase and proximity search against brute force."""

import random
import re

import pytest

from tierwell.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")))


def brute(docs, items, window):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            for k in range(max(1, len(v) - window + 1) if v else 0):
                p = v[k:k + window]
                for at in range(len(w) - len(p) + 1):
                    if w[at:at + len(p)] == p:
                        hit.update(range(at, at + len(p)))
                        found.add(item)
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(2)
    pool = ["a", "B", "c", "É", "é", "d-e", "x_y", "7", "the", "of"]
    text = lambda n: " ".join(rnd.choices(pool, k=n))
    docs = [(k, text(rnd.randint(0, 60))) for k in range(150)]
    docs += [(900, None), (901, ""), (3, docs[3][1]), (None, "the of the of a"), (902, "the of " * 3000), (903, "..")]
    items = [(k, text(rnd.randint(1, 9))) for k in range(25)]
    items += [(50, None), (51, ""), (52, "--"), (10, items[10][1]), (None, "the of the"), (53, "7")]
    return docs, items


@pytest.mark.parametrize("piece", [decontam.PIECE_CHARS, 40])
def test_phrases_equal_brute_force(spark, data, piece, monkeypatch):
    monkeypatch.setattr(decontam, "PIECE_CHARS", piece)
    docs, items = data
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, terms string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.search(decontam.build_index(df, block_chars=900), bench, window=4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r.items)) for r in got), key=str) == brute(docs, items, 4)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in got)


def test_proximity(spark):
    df = spark.createDataFrame([(1, "alpha x beta x gamma"), (2, "alpha beta gamma"), (3, "alpha " + "x " * 9 + "beta gamma"),
                                (4, "alpha beta")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "gamma beta alpha")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, list(r.near_items)) for r in
           decontam.search(decontam.build_index(df), bench, window=10, slop=4).collect()}
    assert got == {1: (0, ["7"]), 2: (0, ["7"]), 3: (0, []), 4: (0, [])}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id string, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontam.search(decontam.build_index(none), bench).collect() == []
    (row,) = decontam.search(decontam.build_index(some), bench).collect()
    assert (row.doc_id, row.n_words, row.n_hit, list(row.items)) == (1, 2, 0, [])
