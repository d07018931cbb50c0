"""Corpus pipeline: documents to packed training sequences.

Stages, each over everything its predecessor kept: language ID, line dedup,
MinHash near-dedup, suffix-array dedup, best-fit packing.  All but the last
return the columns of ``documents``.  ``run`` writes each stage's rows as
Parquet in the shared folder that the session names in
``spark.checkpoint.dir`` and reads them again, so a lost executor costs one
stage's work at most; a stage's input is removed once its output is written.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harmonia.llm import langid, lines, minhash, packing, suffix
from harmonia.llm.common import fresh, table
from harmonia.session import checkpoint_dir


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, or whose language stays open at a very low score."""
    return langid.keep_identified(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later occurrences of three-line windows from the texts; every document stays."""
    return _sized(lines.dedup_lines(docs).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (the smallest id)."""
    name = fresh(docs, "_kept")
    kept = minhash.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias(name))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes bytes of repeated 100-byte strings from the texts; every document stays."""
    return _sized(suffix.remove_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts with their sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("passage_dedup", passage_dedup), ("packing", pack)]

#: Classifiers, connected components and tokenisation are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    root, before = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            _remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
