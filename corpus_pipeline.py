"""A training corpus from raw documents: language, quality, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on whatever its predecessor
kept. All but the last return the columns of ``documents``; what a stage
rejects is gone for the next. ``run`` writes each stage's result to the shared
folder and reads it again, so a lost executor costs one stage at most. The
stages set the session's Arrow batches to ``small_batches`` rows, for what
they return runs later.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from qlens.llm import decontaminate, language, packing, quality, simhash
from qlens.llm.common import small_batches
from qlens.storage import checkpoint_dir, join_path, scratch, tidied


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    small_batches(spark)
    return language.keep_identified(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely enough good, learned from the labels of this stage's documents."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    small_batches(spark)
    return simhash.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# No stage can be expressed in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What lies between them is deleted at the end, and what a stage itself
    writes down as soon as its result is written; one folder stays, that of the result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    result = join_path(checkpoint_dir(spark), f"corpus-{uuid.uuid4().hex}")
    *stages, (_, last) = STAGES
    with scratch(spark) as keep:
        for _, stage in stages:
            with tidied(spark):
                docs = keep(stage(spark, docs, sf_dir))
        with tidied(spark):
            last(spark, docs, sf_dir).write.parquet(result)
    return spark.read.parquet(result)


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
