"""The laws of sharding on odd tables."""

import zlib
from collections import defaultdict

import pytest

from tierwell.llm import sharding


def check(rows, docs, n=8):
    got = sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str)
    assert got == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=str)
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(n))
    total, most = sum(size.values()), max((r.size for r in rows), default=0)
    for k in range(n):
        assert abs(size[k] - total / n) <= 2 * most + 2 * sharding.GROUP_SHARE * total / n, (k, size)


CASES = {
    "plain": [(i, f"text {i} " + "x" * (i % 50)) for i in range(2000)],
    "hot text": [(i, "same" * 20 if i % 3 == 0 else f"t{i}é" * (i % 9)) for i in range(1500)],
    "one text": [(i, "same") for i in range(900)],
    "one row repeated": [(1, "a")] * 700,
    "nulls": [(None, None)] * 300 + [(None, "x")] * 300 + [(i, None) for i in range(300)],
    "long": [(i, "y" * 100000 if i in (5, 6) else "z" * (i % 700)) for i in range(1200)],
    "few": [(1, "a"), (2, "b")],
}


@pytest.mark.parametrize("case", CASES)
def test_shards(spark, case):
    docs = CASES[case]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, shard int").repartition(5)
    rows = sharding.shard(df).collect()
    check(rows, docs)
    if case == "plain":
        again = sharding.shard(df.repartition(3)).collect()
        assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_small_groups_stay_together(spark):
    docs = [(i, f"copy {i % 2000}") for i in range(6000)]
    rows = sharding.shard(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs)
    held = defaultdict(set)
    for r in rows:
        held[r.text_crc32].add(r.shard)
    assert all(len(v) == 1 for v in held.values())


def test_empty_and_written(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert sharding.shard(empty).collect() == []
    docs = spark.createDataFrame([(i, f"t{i}", i) for i in range(50)], "doc_id long, text string, extra int")
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {"text", "extra", "slot", "shard"} <= set(back.columns)


def test_written_shards_keep_columns_that_clash(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", i * 10, f"s{i}", -i, "c") for i in range(20)],
                                 "doc_id long, text string, size long, shard string, slot int, shard_size string")
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    assert {"shard_shard", "shard_slot", "shard_size_", "text_crc32"} <= set(back.columns)
    assert {r[0] for r in back.select("shard_shard").collect()} == {0, 1, 2}
