"""Source divergence audit over a three-dimensional cube of cells.

How far does each source's vocabulary lie from every other source of its
language, and by which terms does it stand out? Sources (groups) and kept terms
are numbered; a *cell* of the cube is (block of groups, block of groups, block
of terms). A task owns a cell: it receives the two groups' slices of that term
block, which are replicated along the other group axis only, computes every
partial divergence of its groups, and the partial sums are reduced along the
term axis. A cell holds at most ``2 * GROUP_BLOCK * TERM_BLOCK`` counts, however
many sources, terms or documents there are.

All arithmetic is in whole numbers. With ``n`` occurrences of a term in a
group, ``N`` occurrences of kept terms there and ``V`` kept terms of the
language, the smoothed share is ``p = 1 + floor(10**9 * (n + 1) / (N + V))``,
and a term's part of the divergence of ``p`` from ``q`` is
``floor((p - q)**2 / q)``. Shares are divided digit by digit, so they are exact
up to 9 * 10**15 occurrences.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..operators.merge import numbered
from ..session import materialize

GROUP_BLOCK, TERM_BLOCK = 32, 8192
#: Distinct (group, term) pairs that a task counts before it sends them on.
FLUSH = 400_000
#: Fixed value: a term is a maximal run of these bytes (ASCII letters and all of other characters).
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def _count_terms(flush: int):
    """(lang, source, term, n, n_docs) of a task's documents, combined as far as memory allows."""
    def emit(counts):
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            for lo in range(0, len(terms), 50_000):
                part = terms[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([n[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64())],
                    names=["lang", "source", "term", "n", "n_docs"])

    def run(batches):
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            # cut large Arrow batches before they become Python strings
            step = max(1, min(batch.num_rows, int(batch.num_rows * 4_000_000 / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                              part.column(2).cast(pa.binary()).to_pylist()):
                    words = TERM.findall(text.lower())       # bytes.lower touches A-Z only
                    n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
                    held -= len(n)
                    n.update(words)
                    docs.update(set(words))
                    held += len(n)
                    if held >= flush:
                        yield from emit(counts)
                        counts, held = {}, 0
        yield from emit(counts)
    return run


_COUNTS = T.StructType([T.StructField(c, T.StringType()) for c in ("lang", "source", "term")]
                       + [T.StructField(c, T.LongType()) for c in ("n", "n_docs")])


def term_counts(docs: DataFrame, lang_col="lang", source_col="source", text_col="text") -> DataFrame:
    """Occurrences and documents of each term in each (lang, source)."""
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in
                           ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return (filled.mapInArrow(_count_terms(FLUSH), _COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")))


def _share(n: str, size: str) -> Column:
    """``1 + floor(10**9 * (n + 1) / (size + n_terms))`` by long division in base 1000."""
    out, rest = F.lit(0).cast("long"), f"({n} + 1)"
    for _ in range(3):
        out = out * 1000 + F.expr(f"({rest} * 1000) div ({size} + n_terms)")
        rest = f"(({rest} * 1000) % ({size} + n_terms))"
    return out + 1


def _surprise(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


_PARTIAL = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "value")])


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of one cell, both ways between its two blocks of groups.

    Rows without a term are the groups' headers (share of an absent term,
    size of the term block).
    """
    c = {n: table.column(n) for n in table.column_names}
    term = c["t"].to_numpy()
    gid, p = c["gid"].to_numpy(), c["p"].to_numpy()
    side_a, side_b = c["ba"][0].as_py(), c["bb"][0].as_py()
    size = int(c["size"][0].as_py())
    head = term < 0
    groups, at = np.unique(gid[head], return_index=True)
    base, block = p[head][at], c["block"].to_numpy()[head][at]
    used, column = np.unique(term[~head], return_inverse=True)
    shares = np.repeat(base[:, None], len(used) + 1, axis=1)        # last: terms in no group here
    shares[np.searchsorted(groups, gid[~head]), column] = p[~head]
    weight = np.ones(len(used) + 1, dtype=np.int64)
    weight[-1] = size - len(used)
    left, right = np.flatnonzero(block == side_a), np.flatnonzero(block == side_b)
    out = []
    for i in left.tolist():
        x, y = shares[i][None, :], shares[right]
        d = (x - y) ** 2
        there, back = (d // y) @ weight, (d // x) @ weight
        for k, j in enumerate(right.tolist()):
            if i != j:
                out.append((groups[i], groups[j], there[k]))
                if side_a != side_b:
                    out.append((groups[j], groups[i], back[k]))
    a = np.array(out, dtype=np.int64).reshape(-1, 3)
    return pa.table([a[:, 0], a[:, 1], a[:, 2]], names=["a", "b", "value"])


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(a, b, value): divergence of every group from every other group of its language."""
    slices = kept.select("gid", "first", "n_groups", "p", "size", "tb",
                         (F.col("tid") % TERM_BLOCK).cast("long").alias("t"))
    block = F.expr(f"(gid - first) div {GROUP_BLOCK}")
    last = F.expr(f"greatest(1, (n_terms + {TERM_BLOCK - 1}) div {TERM_BLOCK}) - 1")
    head = groups.select("gid", "first", "n_groups", F.col("absent").alias("p"), "n_terms",
                         F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("tb"))
    head = head.select("gid", "first", "n_groups", "p",
                       F.least(F.lit(TERM_BLOCK).cast("long"),
                               F.col("n_terms") - F.col("tb") * TERM_BLOCK).alias("size"),
                       "tb", F.lit(-1).cast("long").alias("t"))
    other = F.explode(F.expr(f"sequence(0L, (n_groups - 1) div {GROUP_BLOCK})"))
    cells = (slices.unionByName(head).withColumn("block", block).withColumn("_x", other)
             .select("first", F.least("block", "_x").alias("ba"), F.greatest("block", "_x").alias("bb"),
                     "tb", "block", "gid", "t", "p", "size"))
    return (cells.groupBy("first", "ba", "bb", "tb").applyInArrow(_cell, _PARTIAL)
            .groupBy("a", "b").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, min_docs: int = 3, top_terms: int = 200, lang_col: str = "lang",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: two ranked lists per (lang, source).

    Part ``pair``: every other source of the language and the divergence from it,
    summed over the language's kept terms (those in at least ``min_docs`` of its
    documents). Part ``term``: the terms that the source uses more than its
    language does, with their part of the divergence from the language, up to
    rank ``top_terms``. Ranks go by value, ties by the item's bytes.

    Null columns count as ``''``; a source with no text or no kept term has
    the share of an absent term everywhere; a language without kept terms has
    divergences of 0 and no ``term`` rows. Repeated rows and ids are documents
    of their own. A text is read whole, by one task, whatever its length; an
    empty table gives an empty result. Other columns are not read.
    """
    counts = materialize(term_counts(docs, lang_col, source_col, text_col))
    totals = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("d"))
              .where(F.col("d") >= min_docs).drop("d"))
    terms = numbered(totals, ["lang", "term"], "no")
    langs = terms.groupBy("lang").agg(F.min("no").alias("first_term"), F.count(F.lit(1)).alias("n_terms"),
                                      F.sum("lang_n").alias("lang_size"))
    kept = materialize(counts.drop("n_docs").join(terms, ["lang", "term"]))
    found = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    named = numbered(found.join(sizes, ["lang", "source"], "left"), ["lang", "source"], "gid")
    spans = named.groupBy("lang").agg(F.min("gid").alias("first"), F.count(F.lit(1)).alias("n_groups"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = (named.join(spans, "lang").join(langs, "lang", "left")
              .select("lang", "source", "gid", "first", "n_groups", zero("size"), zero("n_terms"),
                      zero("lang_size"), zero("first_term")))
    # a language without terms has nothing to share out
    groups = materialize(groups.withColumn("absent", F.when(F.col("n_terms") == 0, F.lit(1).cast("long"))
                                           .otherwise(_share("0", "size"))))
    rows = (kept.join(groups.drop("absent"), ["lang", "source"])
            .withColumn("tid", F.col("no") - F.col("first_term"))
            .withColumn("p", _share("n", "size")))
    blocks = (rows.withColumn("tb", F.expr(f"tid div {TERM_BLOCK}"))
              .withColumn("size", F.least(F.lit(TERM_BLOCK).cast("long"),
                                          F.col("n_terms") - F.col("tb") * TERM_BLOCK)))
    names = groups.select("gid", "lang", "source")
    pair = (_pairs(groups, blocks).join(names.withColumnRenamed("gid", "a"), "a")
            .join(names.select(F.col("gid").alias("b"), F.col("source").alias("item")), "b")
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    term = (rows.withColumn("q", _share("lang_n", "lang_size")).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    _surprise("p", "q").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pair).unionByName(ranked(term).where(F.col("rank") <= top_terms))
