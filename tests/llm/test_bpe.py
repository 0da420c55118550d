"""Byte-level BPE against the public library and exact round trips."""

import random

import public_tokenizers as P
import pytest
import regex
import tiktoken

from tierwell.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def spans(texts):
    joined, _, starts, ends, begin = bpe.pretoken_spans(texts)
    return [[joined[s:e] for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(begin, begin[1:])]


def test_pretokens_equal_the_pattern():
    pattern = regex.compile(P.PATTERN)
    rnd = random.Random(7)
    pool = list("ab sdtmrevl''  \n\t\r1٣²é中😀.,!_\x00\x1c\x85\xa0 ​́")
    texts = ["", "'", "''s", " 's", "'re've 'll'l", "a'", "a'r", "\n's", "  x", "x  ", "don't've", "\n\n"]
    texts += ["".join(rnd.choices(pool, k=rnd.randint(0, 14))) for _ in range(20000)]
    assert spans(texts) == [pattern.findall(t) for t in texts]


def test_merges_equal_the_library():
    rnd = random.Random(3)
    for n in [1, 2, 5, 20, 95, 96, 97, 98, 130, 700]:
        for pool in ("ab", "the ing", "éèa", "0123456789", "-=", "中文字"):
            word = "".join(rnd.choices(pool, k=n)).encode()
            assert bpe.merge_word(word, RANKS) == LIBRARY._encode_single_piece(word), word


@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(5)
    return [(0, "Hello  world's   \n\n end "), (1, None), (2, ""), (2, ""), (None, "null id"),
            (3, "<|endoftext|> stays text"), (4, "x" * 30000), (5, " " * 5000 + "a"),
            (6, "".join(rnd.choices("abc é中\n'", k=60000))), (7, "0" * 999), (7, "same id")]


def test_encode_equals_library_and_decodes(spark, odd_texts):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in odd_texts],
                                 "doc_id long, text string, ids string, block int")
    out = bpe.decode(bpe.encode(docs, RANKS, block_chars=40000), RANKS).collect()
    got = sorted(((r.doc_id is None, r.doc_id, list(r.ids), bytes(r.decoded)) for r in out), key=str)
    want = sorted(((i is None, i, LIBRARY.encode_ordinary(t or ""), (t or "").encode())
                   for i, t in odd_texts), key=str)
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    out = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert out.collect() == [] and out.columns == ["doc_id", "ids", "decoded"]


def test_unknown_id_raises(spark):
    bad = spark.createDataFrame([(1, [999999])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="token-byte table"):
        bpe.decode(bad, RANKS).collect()
