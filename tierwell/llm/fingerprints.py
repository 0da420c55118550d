"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range,
plus the smallest hash, so that no text with words has an empty sketch. A
sketch grows with its document, the sketch of two joined sets is the union of
the sketches (so they merge), and the share of the smaller sketch found in
the larger estimates containment even between very unequal documents.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .sharding import LEAST_RANGES, quantile_cuts, range_of

#: Words of a shingle; a hash is kept if it is in the lowest 1/KEEP of the range.
SHINGLE, KEEP = 5, 4
#: Bytes of text that one range of neighbouring documents holds about.
RANGE_BYTES = 32_000_000
_BLANK = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Runs of signs other than ASCII white space; empty for a text without any."""
    trimmed = F.btrim(text, F.lit(_BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


def shingle_hashes(word_array: Column, size: int = SHINGLE) -> Column:
    """Hashes of the runs of ``size`` words; fewer words are one run, no words none."""
    n = F.size(word_array)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))),
                       lambda i: F.xxhash64(F.slice(word_array, i, F.lit(size))))
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(runs)


def sketch_of(hashes: Column, keep: int = KEEP) -> Column:
    """The retained hashes, ascending and distinct."""
    limit = -(1 << 63) + (1 << 64) // keep
    kept = F.filter(hashes, lambda h: h < F.lit(limit))
    least = F.filter(F.array(F.array_min(hashes)), lambda h: h.isNotNull())
    return F.array_sort(F.array_distinct(F.concat(kept, least)))


def add_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the sketch of a text column, each step computed once."""
    return (df.withColumn("__words", words(F.col(text)))
            .withColumn("__hashes", shingle_hashes(F.col("__words"))).drop("__words")
            .withColumn(name, sketch_of(F.col("__hashes"))).drop("__hashes"))


def merge(a: Column, b: Column) -> Column:
    """Sketch of the union of two documents' shingles (nearly: both least hashes stay)."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller document's shingles that the larger has, 0 to 1.

    Two sketches without any hash (texts without words) are alike; one is like no other.
    """
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least) \
        .otherwise(F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0))


def as_text(sketch: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash, ascending."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, sketch)`` of every whole text; null and empty texts have an empty sketch."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return add_sketch(rows, "text", "sketch").drop("text")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Documents next to their successor by ascending id (after the last: the first).

    Returns (rows, window): the rows hold ``doc_id, text, ghost`` and lie in
    ranges of neighbouring ids; a ghost is a copy of the next range's first
    row and is to be dropped once successors are read. Ties of the id are
    ordered by the text's hash, then as they come; null ids come first.
    """
    keys = ["doc_id", "__hash", "__no"]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("__hash", F.xxhash64("text")).withColumn("__no", F.monotonically_increasing_id())
    kind = rows.schema["doc_id"].dataType.simpleString()
    types = [kind, "long", "long"]
    size = F.octet_length("text").cast("long") + 1
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).head()
    ranges = max(LEAST_RANGES, -(-total // RANGE_BYTES))
    draw = F.pmod(F.xxhash64(*keys, F.lit(17)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    share = size * (32 * ranges / max(1, total))
    drawn = [(tuple(r[k] for k in keys), max(1.0, r["share"])) for r in
             rows.select(*keys, share.alias("share")).where(draw < F.col("share")).where("doc_id is not null").collect()]
    cuts = quantile_cuts(drawn, ranges) if count else []
    key = F.struct(*keys)
    ranged = rows.withColumn("__range", range_of(key, cuts, keys, types))
    firsts = {r["__range"]: r["f"] for r in
              ranged.groupBy("__range").agg(F.min(key).alias("f")).collect()}
    used = sorted(firsts)
    before = {k: used[i - 1] for i, k in enumerate(used)}        # the first range follows the last
    # cells for ranges that hold nothing are never read
    first_key = F.get(F.array(*[F.struct(*[F.lit(firsts[k][n] if k in firsts else None).cast(t).alias(n)
                                           for n, t in zip(keys, types)])
                                for k in range(len(cuts) + 1)]), F.col("__range"))
    prior = F.get(F.array(*[F.lit(before.get(k, 0)) for k in range(len(cuts) + 1)]), F.col("__range"))
    own = F.struct(F.col("__range").alias("range"), F.lit(False).alias("ghost"))
    copy = F.struct(prior.alias("range"), F.lit(True).alias("ghost"))
    out = ranged.withColumn("__to", F.explode(F.when(key.eqNullSafe(first_key), F.array(own, copy))
                                              .otherwise(F.array(own)))) \
        .select(*keys, "text", F.col("__to.range").alias("__range"), F.col("__to.ghost").alias("ghost"))
    return out, Window.partitionBy("__range").orderBy("ghost", *keys)


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's sketch beside that of an edited text and of the next document.

    The edited text has the last half of the code points (rounded down)
    replaced by the first as many (or all) of the next document. Returns
    ``doc_id, n_chars, edited, sketch, edited_sketch, near_edited, near_next``.
    Repeated rows follow each other and give a row each; an empty table gives
    an empty result; a lone document is its own successor.
    A very long text is read whole, by one task; nothing is cut off.
    """
    rows, near = with_next(docs, id_col, text_col)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (rows.withColumn("__next", F.lead("text").over(near))
            .withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                           F.substring(F.coalesce("__next", F.lit("")), F.lit(1), half)))
            .drop("__next"))
    rows = add_sketch(rows, "text", "sketch").drop("text")
    rows = rows.withColumn("__next_sketch", F.lead("sketch").over(near)).where("not ghost")
    rows = add_sketch(rows, "edited", "edited_sketch")
    return rows.select("doc_id", "n_chars", "edited", "sketch", "edited_sketch",
                       containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       containment(F.col("sketch"), F.col("__next_sketch")).alias("near_next"))


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        as_text(F.col("sketch")).alias("fingerprint"),
                        as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")
