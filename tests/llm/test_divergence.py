"""Source divergence audit against a brute-force version in whole numbers."""

import random
import re
from collections import Counter, defaultdict

from tierwell.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def low(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(docs, min_docs=3, top=200):
    counts, found = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        words = TERM.findall(low(text or ""))
        counts[lang, source].update(words)
        found[lang].update(set(words))
    out = []
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in found[lang].items() if n >= min_docs]
        groups = {s: c for (g, s), c in counts.items() if g == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            size = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (size + len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        f = lambda x, y: (x - y) ** 2 // y
        for s in groups:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            term = [(-f(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(items, 1)]
    return sorted(out)


def check(spark, docs, **kw):
    df = spark.createDataFrame([(i, t, a, b, 7, "x") for i, (t, a, b) in enumerate(docs)],
                               "doc_id long, text string, lang string, source string, gid int, term string")
    got = divergence.audit(df, **kw)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, kw.get("min_docs", 3), kw.get("top_terms", 200))


def corpus(n, sources, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["alpha", "Beta", "BETA", "été", "ÉTÉ", "naïve", "x", "中文", "a1b", "co-op", "É"] + [
        f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    docs = [(" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 40))), rnd.choice(["en", "fr", None]),
             rnd.choice(sources)) for _ in range(n)]
    return docs


def test_equals_brute_force_with_nulls_ties_and_repeats(spark):
    docs = corpus(150, ["a", "b", "é", None, "Z"])
    docs += [docs[0]] * 4 + [(None, "en", "no text"), ("", "fr", "empty"), ("only here", "de", "one"),
                             ("123 !?", "xx", "p"), (None, "xx", "q"), ("word " * 60_000, "en", "long"),
                             ("tie tie other other", "en", "t"), ("tie other", "en", "u"), ("other tie", "en", "u")]
    check(spark, docs)
    check(spark, docs, min_docs=1, top_terms=5)


def test_many_cells(spark, monkeypatch):
    # sources and terms over several blocks of every axis; one source holds a third of all rows
    monkeypatch.setattr(divergence, "GROUP_BLOCK", 3)
    monkeypatch.setattr(divergence, "TERM_BLOCK", 16)
    monkeypatch.setattr(divergence, "FLUSH", 50)
    check(spark, corpus(240, [f"s{i}" for i in range(11)] + ["hot"] * 6))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(df).collect() == []
