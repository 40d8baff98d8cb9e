"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs.  All stages but the last
return the columns of documents; the last returns token ids.  A stage works
on all rows that its predecessor kept.

Defined results: documents with a null or blank text fail the quality rules'
base rule; of repeated rows one stays after the near-duplicate stage; empty
tables pass through; other columns of documents are carried to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsift.llm import fmindex, pieces, pii, quality, registry, simhash
from voxsift.llm.common import table
from voxsift.session import scratch_path


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` after the text changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of the benchmark."""
    return _recount(fmindex.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by marks."""
    return _recount(pii.redact(docs, pii.learn(docs)))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and the text that they decode to."""
    extra = [c for c in ("lang", "source") if c in docs.columns]
    return pieces.encode(docs, registry.model_path(), extra=extra)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("sentencepiece", sentencepiece),
]

#: Learned rules, tokenization and message passing have no SQL form; the
#: stages are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents.  Tables between stages are written to the
    cluster's shared folder; each goes as soon as the next one is whole."""
    folder = scratch_path(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
