"""Semi join (J7) behind a Bloom filter of the smaller side's keys.

The filter is a table of at most ``words`` rows (word number, 64 bits), made
with map-side combining: each key sets ``BITS`` bits of one word. Its size is
fixed whatever the number of keys, so it is broadcast, and it drops
most rows of the larger side before that side is shuffled. The exact join
follows, so false positives cost a little work and change nothing; with far
more keys than the words can tell apart the filter merely lets everything pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 4
#: 2**18 words of 16 bytes: 4 MB, good for about two million keys.
WORDS = 1 << 18


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """(word, bits) of a key: the word from one hash, the bits from six binary digits each of another."""
    word = F.pmod(F.xxhash64(key), F.lit(words))
    digits = F.xxhash64(key, F.lit("bits"))
    bits = F.lit(0).cast("long")
    for i in range(BITS):
        at = F.shiftright(digits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return word, bits


def bloom_filter(keys: DataFrame, key: Column, words: int = WORDS) -> DataFrame:
    """(_word, _bits): at most ``words`` rows; null keys set nothing."""
    word, bits = _place(key, words)
    return (keys.where(key.isNotNull()).select(word.alias("_word"), bits.alias("_bits"))
            .groupBy("_word").agg(F.bit_or("_bits").alias("_bits")))


def maybe_in(rows: DataFrame, key: Column, bloom: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows whose key may be in the filter (none that is in it is lost); null keys are dropped."""
    word, bits = _place(key, words)
    marked = rows.select("*", word.alias("_w"), bits.alias("_b")).where(key.isNotNull())
    return (marked.join(F.broadcast(bloom), (F.col("_w") == F.col("_word"))
                        & (F.col("_bits").bitwiseAND(F.col("_b")) == F.col("_b")))
            .drop("_w", "_b", "_word", "_bits"))


def may_be_in(rows: DataFrame, key: Column, bloom: DataFrame, out: str, words: int = WORDS) -> DataFrame:
    """All rows, ``out`` tells whether the key may be in the filter (never for a null key); rows are not moved."""
    word, bits = _place(key, words)
    marked = rows.select("*", F.when(key.isNotNull(), word).alias("_w"), bits.alias("_b"))
    return (marked.join(F.broadcast(bloom), F.col("_w") == F.col("_word"), "left")
            .withColumn(out, F.coalesce(F.col("_bits").bitwiseAND(F.col("_b")) == F.col("_b"), F.lit(False)))
            .drop("_w", "_b", "_word", "_bits"))


def bloom_semi_join(rows: DataFrame, keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """``rows`` whose ``key`` occurs in ``keys``; ``keys`` is read twice and should be stored."""
    return maybe_in(rows, F.col(key), bloom_filter(keys, F.col(key), words), words).join(
        keys.select(key), key, "left_semi").select(*rows.columns)
