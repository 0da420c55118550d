"""Language identification: held-out accuracy, batch independence, odd rows."""

import zlib

import numpy as np
import pytest

from tierwell.llm import langid


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs, per_language=200)


def test_held_out_accuracy(docs, model):
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows) and np.mean([r.rejected for r in rows]) < 0.01


def test_held_out_rows_are_never_sampled(spark, docs):
    bad = docs.withColumn("lang", langid.F.when(langid.held_out(), "xx").otherwise(langid.F.col("lang")))
    assert langid.fit(bad, per_language=50).langs == ["de", "en", "es", "fr"]


def test_logits_do_not_depend_on_the_batch(model, monkeypatch):
    texts = ["The thereof", "", "éèê aux " * 50, "a", "ÜBER " * 30, "12 34"]
    whole = model.logits(texts)
    monkeypatch.setattr(langid, "_STRETCH", 37)
    assert np.allclose(whole, model.logits(texts)) and np.allclose(whole[2:3], model.logits(texts[2:3]))
    bucket, n = langid.counts(texts[2])
    assert np.allclose(whole[2], (n / n.sum()) @ model.table[bucket] + model.bias, atol=1e-4)


def test_odd_rows(spark, model):
    rows = [(1, None, "en"), (2, "", None), (3, "123 !!", "x"), (None, "the of and the", None), (4, "the of " * 90000, "q"),
            (4, "the of", "q"), (4, "the of", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = langid.predict(df, model).collect()
    assert len(got) == 7
    assert [(r.lang_pred, r.score, r.rejected) for r in got if r.doc_id in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert all(r.lang_pred == "en" for r in got if r.doc_id not in (1, 2, 3))
    kept = langid.predict(df, model, keep_columns=True)
    assert kept.schema == df.schema and kept.count() == 4
    none = langid.predict(df, None).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.fit(df) is None
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.fit(empty) is None and langid.predict(empty, None).collect() == []


def test_left_out_languages_are_rejected_and_clean_texts_kept(spark, docs, model):
    """The two rates of the rejection: 0.9 of an unlearned language out, 0.99 of known texts in."""
    held = docs.where(langid.held_out() & langid.F.col("lang").isNotNull() & langid.F.col("text").isNotNull())
    kept = [not r.rejected for r in langid.predict(held, model).collect() if r.lang_pred != "und"]
    assert len(kept) > 200 and np.mean(kept) >= 0.99
    for lang in ("de", "fr"):
        # the label is taken away, so that the language is not learned
        rest = docs.withColumn("lang", langid.F.when(langid.F.col("lang") != lang, langid.F.col("lang")))
        partial = langid.fit(rest, per_language=200)
        assert lang not in partial.langs
        found = langid.predict(held, partial).join(held.select("doc_id", "lang"), "doc_id").collect()
        out = [r.rejected for r in found if r.lang == lang]
        known = [r.rejected for r in found if r.lang != lang and r.lang_pred != "und"]
        assert np.mean(out) >= 0.9 and np.mean(known) <= 0.01, (lang, np.mean(out), np.mean(known))


def test_foreign_shuffled_mixed_and_short_texts(docs, model):
    texts = [r.text for r in docs.where("lang = 'en' and length(text) > 400").limit(60).collect()]
    other = [r.text for r in docs.where("lang = 'fr' and length(text) > 400").limit(60).collect()]
    rejected = lambda xs: float(np.mean(model.predict(xs)[2]))
    assert rejected([langid.shuffled(t) for t in texts]) >= 0.9
    assert rejected(["правительство решило повысить налоги и люди недовольны " * 5] * 3) == 1
    assert rejected([a[:400] + " " + b[:400] for a, b in zip(texts, other)]) <= 0.02
    assert rejected([" ".join(t.split()[:4]) for t in texts]) <= 0.05
    assert sorted(langid.shuffled("ab, cd é!")) == sorted("ab, cd é!") and langid.shuffled("")  == ""


def test_many_labels_are_all_learned(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} " * 9, f"l{i % 300:03}") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(langid.fit(df).langs) == 300
