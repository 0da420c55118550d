"""The pipeline stage by stage against the brute-force versions of its operators."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as pipeline
from test_decontam import brute as phrases
from test_lines import brute as repeated_lines
from test_neardup import brute as near

from tierwell.llm import bpe, langid

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Documents with odd rows, as a folder of tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").head()
    more = [(5000, None, "en", "s", 0), (5001, "", None, None, None), (5002, "123 .", "en", "s", 5),
            (5003, docs.orderBy("doc_id").head().text, "en", "s", 1), (5004, f"the of and {leak.text} the of", "en", "s", 2)]
    docs.union(spark.createDataFrame(more, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, data)
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == COLUMNS
            out.write.parquet(f"{data}/{len(seen)}")
            out = spark.read.parquet(f"{data}/{len(seen)}")
        rows = out.collect()
        after = sorted((r.doc_id, r.text) for r in rows) if "text" in out.columns else rows
        seen[name] = (before, after)
        docs = out
    (lang, cut, dedup, clean, tokens) = seen.values()
    assert {i for i, _ in lang[0]} - {i for i, _ in lang[1]} >= {5000, 5001, 5002}
    assert len(lang[1]) >= 0.98 * (len(lang[0]) - 3)
    assert cut[1] == sorted((i, t) for i, t, _, _ in repeated_lines(cut[0], 40, 5))
    groups = near(dedup[0], 5, 80)
    assert {i for i, _ in dedup[1]} == {i for i, g in groups.items() if g[2]} and len(dedup[1]) < len(dedup[0])
    leaks = {i for i, _, hit, _ in phrases(clean[0], items, 10) if hit}
    assert 5004 in leaks and {i for i, _ in clean[1]} == {i for i, _ in clean[0]} - leaks
    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in tokens[0]:
        ids = library.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(t.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tokens[1]} == want


def test_run_equals_the_stages(spark, data):
    rows = pipeline.run(spark, data).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{data}/3").collect()}
    assert {r.doc_id for r in rows} == ids and len(rows) == len(ids)


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert langid.fit(docs) is None
    assert pipeline.run(spark, str(tmp_path)).collect() == []
