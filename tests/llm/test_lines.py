"""Line dedup against a brute-force version."""

import random
from collections import defaultdict

from tierwell.llm import lines

WS = " \t\n\x0b\x0c\r"


def brute(docs, min_chars, min_docs):
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            k = low(line.strip(WS))
            if len(k) >= min_chars and i is not None:
                held[k].add(i)
    out = []
    for i, t in docs:
        parts = (t or "").split("\n")
        keep = []
        for line in parts:
            h = held.get(low(line.strip(WS)), ())
            if not (len(h) >= min_docs and i is not None and i != max(h)):
                keep.append(line)
        out.append((i, "\n".join(keep), len(parts), len(parts) - len(keep)))
    return sorted(out, key=str)


def test_lines_equal_brute_force(spark):
    rnd = random.Random(1)
    pool = ["short", "É" * 12, "é" * 12, "A" * 12, "a" * 12, "\t" + "a" * 12 + "\x0b", "\xa0" + "a" * 12,
            "ééééé", "unique", "", "  ", "longer common line here", "Longer Common LINE here \r"]
    docs = [(i, "\n".join(rnd.choices(pool, k=rnd.randint(0, 6)))) for i in range(120)]
    docs += [(200, None), (None, "a" * 12), (None, "A" * 12), (5, "a" * 12), (5, docs[5][1]),
             (201, "\n".join(["a" * 12] * 5000))]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs],
                               "doc_id long, text string, h1 int, n_lines string")
    got = lines.dedup_lines(df, min_chars=11, min_docs=5)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, 11, 5)
    same = lines.dedup_lines(df, min_chars=11, min_docs=5, keep_columns=True)
    assert same.schema == df.schema and same.count() == len(docs)
    assert same.where("doc_id = 200").head().text is None


def test_columns_that_look_like_the_operators_own(spark):
    df = spark.createDataFrame([(i, "a" * 12, "x", "y") for i in range(6)],
                               "doc_id long, text string, `__gone` string, `__marked` string")
    kept = lines.dedup_lines(df, min_chars=11, keep_columns=True)
    assert kept.columns == df.columns and sorted(r.text for r in kept.collect()) == [""] * 5 + ["a" * 12]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedup_lines(df).collect() == []
