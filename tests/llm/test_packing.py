"""Sequence packing: ids as the library's, every id in one piece, little padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierwell.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    t = Tokenizer.from_file(PATH)
    return [[*e.ids, 2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def padding(pieces, window):
    """Ids of padding: sequences are filled up to the window, but for powers of two."""
    used = {}
    for p in pieces:
        used[p["sequence_id"]] = used.get(p["sequence_id"], 0) + p["length"]
    return sum(0 if n & (n - 1) == 0 else window - n for n in used.values()), sum(used.values())


def check(docs, pieces, window):
    """docs: [(id, text)]; pieces: rows that carry their ids."""
    ids = library_ids([t for _, t in docs])
    # every document's ids, piece after piece; documents of one id are told apart by their ids alone
    got = {}
    for p in pieces:
        assert 0 < p["length"] <= window and len(p["ids"]) == p["length"]
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        got.setdefault(p["doc_id"], []).append(p)
    want = {}
    for (i, _), x in zip(docs, ids):
        want.setdefault(i, []).append(x)
    assert got.keys() == want.keys()
    for i, found in got.items():
        if len(want[i]) == 1:
            found.sort(key=lambda p: p["start"])
            assert [x for p in found for x in p["ids"]] == want[i][0]
            assert [p["start"] for p in found] == np.cumsum([0, *[p["length"] for p in found]])[:-1].tolist()
            assert {p["doc_tokens"] for p in found} == {len(want[i][0])}
        else:
            assert sum(p["length"] for p in found) == sum(map(len, want[i]))
            assert sorted(x for p in found for x in p["ids"]) == sorted(x for w in want[i] for x in w)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for found in by_sequence.values():
        found.sort(key=lambda p: p["offset"])
        sizes = [p["length"] for p in found]
        assert [p["offset"] for p in found] == np.cumsum([0, *sizes])[:-1].tolist() and sum(sizes) <= window
    return padding(pieces, window)


def test_ids_equal_the_library():
    rnd = random.Random(2)
    alphabet = ["a", "Z", "é", "É", "ß", "×", "ÿ", "Ÿ", "İ", "Σ", "ς", "é", "İ", "1", "²", "'s", "'LL", "’s",
                "<|endoftext|>", "<|", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "́", "中", "😀", "-", "_",
                "\x00", "\x7f", "ǆ", "K", "word", "The"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "\n", "don't CAN'T we'LL 've", "x" * 5000, "1234567890 " * 50]
    words = packing.WordIds(PATH, 2)
    for lo in range(0, len(texts), 500):
        ids, sizes = words.encode(texts[lo:lo + 500])
        at = np.concatenate(([0], np.cumsum(sizes)))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == library_ids(texts[lo:lo + 500])
    assert words.encode([])[1].tolist() == []


def test_signs_and_cases_of_words():
    # one part and one sign, in either case, among words whose lower case depends on what follows
    signs = [chr(c) for c in range(0x80)] + ["ß", "Σ", "İ"]
    texts = [f"{w}{s} ΑΣ{s}Α {w}ΑΣ" for w in ("Word", "x", "don'T", "naÏve") for s in signs] + [" ".join("Word" + s for s in signs)]
    words = packing.WordIds(PATH, 2)
    ids, sizes = words.encode(texts)
    at = np.concatenate(([0], np.cumsum(sizes)))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == library_ids(texts)
    # what is kept for a word is nothing that the garbage collector visits
    import gc
    assert not any(map(gc.is_tracked, words.parts.values()))


def test_room_of_a_block():
    # lists of words are held for a piece of a block, not for the whole of it
    import tracemalloc
    texts = ["two words " * 1000] * 400
    words = packing.WordIds(PATH, 2)
    want = words.encode(texts[:1])[0].tolist()
    tracemalloc.start()
    ids, sizes = words.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes.tolist() == [len(want)] * 400 and ids.tolist() == want * 400
    assert peak < 50e6, peak


@pytest.mark.parametrize("window", [16, 64, 512, 4096])
def test_plan_covers_every_rank_with_little_padding(window):
    rnd = np.random.default_rng(window)
    mixes = [np.zeros(0, int), np.array([1]), rnd.integers(1, window + 1, 3000),
             np.full(400, window // 2 + 1), np.minimum(window, 1 + rnd.exponential(window / 12, 3000).astype(int)),
             np.concatenate((np.full(1000, window // 3 + 1), rnd.integers(1, window, 30)))]
    for lengths in mixes:
        plan = packing.Plan(np.bincount(lengths, minlength=window + 1), window)
        rank, used, places = {}, {}, set()
        for n in lengths.tolist():
            k = rank[n] = rank.get(n, -1) + 1
            found = plan.pieces(n, k)
            assert [p[0] for p in found] == np.cumsum([0, *[p[1] for p in found]])[:-1].tolist()
            assert sum(p[1] for p in found) == n
            for _, size, sequence, place in found:
                used[sequence] = used.get(sequence, 0) + size
                assert (sequence, place) not in places
                places.add((sequence, place))
        assert sorted(used) == list(range(plan.sequences)) and max(used.values(), default=0) <= window
        lost = sum(0 if n & (n - 1) == 0 else window - n for n in used.values())
        assert lost <= 0.01 * max(1, sum(used.values())), (window, lost)


def test_combinations_and_counts():
    combos = packing.combinations(32)
    assert (combos.sum(axis=1) == 32).all() and len({tuple(sorted(c)) for c in combos.tolist()}) == len(combos)
    brute = {tuple(sorted((a, b, 32 - a - b))) for a in range(33) for b in range(33 - a)}
    assert {tuple(sorted(c)) for c in combos.tolist()} == brute
    have = np.zeros(33, np.int64)
    have[[20, 12, 10, 22, 8, 16]] = [100, 160, 50, 50, 40, 60]      # made of whole windows
    counts = packing.repeat_counts(combos, have)
    used = np.bincount(combos.ravel(), np.repeat(counts, 3), 33)[1:]
    assert (used <= have[1:]).all() and used.sum() >= 0.9 * have[1:].sum()


def test_pieces_of_documents(spark):
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choices(["word", "Straße", "naïve", "12", "x,y", "…"], k=rnd.randint(0, 60))))
            for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "long " * 3000), (None, "no id"), (None, "none either"),
             (7, docs[7][1]), (1003, docs[9][1])] + [(2000 + i, "the same text again") for i in range(150)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs],
                               "doc_id long, text string, block int, ids string").repartition(5)
    for window in (64, 512):
        pieces = packing.pack(df, PATH, window=window, with_ids=True, block_chars=500)
        lost, ids = check(docs, [r.asDict() for r in pieces.collect()], window)
        assert lost <= 0.02 * ids
    whole = packing.sequences(pieces).collect()
    assert len(whole) == pieces.agg({"sequence_id": "max"}).head()[0] + 1
    assert all(len(r.ids) <= 512 for r in whole)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, PATH).collect() == []
