"""The corpus pipeline: five stages from raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result as
Parquet to the shared checkpoint folder and hands the rows read back to the
next stage, so a stage sees exactly what its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwell.llm import bpe, decontam, langid, lines, neardup
from tierwell.llm.queries import vocabulary_path
from tierwell.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised."""
    return langid.predict(docs, langid.fit(docs), keep_columns=True)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that many documents share; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs, keep_columns=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.char_length("text").cast(kind))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five-word shingles, 0.8)."""
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark phrase."""
    found = decontam.search(decontam.build_index(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    name = f"leak_{uuid.uuid4().hex}"
    leaks = found.where("n_hit > 0").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(leaks, docs["doc_id"] == leaks[name], "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the bytes they decode to, as digests per document."""
    ranks = bpe.load_ranks(vocabulary_path())
    return bpe.digests(bpe.decode(bpe.encode(docs, ranks), ranks))


STAGES = [
    ("language ID", language),
    ("line dedup", repeated_lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE encoding and decoding", tokens),
]

#: Language identification and BPE have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
