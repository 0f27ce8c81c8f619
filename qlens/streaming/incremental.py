"""Incremental classification of a work list, restartable and bounded per step."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from qlens.config import DEFAULTS, KEYWORDS, SchemaConfig, Settings
from qlens.functions.fixed_values import CATEGORY_RULES
from qlens.operators.classify import Classifier, classify_questions, split_rejects
from qlens.operators.questions import skip_existing
from qlens.sources.sinks import store_keywords, write_rejects
from qlens.sources.tables import facts_of_other_loads
from qlens.storage import scratch

WORK_SCHEMA = "input_text string, total_count bigint, created_at date"


def write_work(questions: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Unique questions as files; files are what a step of the stream is measured in."""
    (
        questions.select("input_text", "total_count", F.to_date("created_at").alias("created_at"))
        .write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def one_per_pair(questions: DataFrame) -> DataFrame:
    """One row per (question, day). Work written twice is the same work, so the larger count is kept, not the sum."""
    return questions.groupBy("input_text", F.to_date("created_at").alias("created_at")).agg(
        F.max("total_count").alias("total_count")
    )


def classify_stream(
    spark: SparkSession,
    work: str,
    sink: str,
    checkpoint: str,
    categories: DataFrame,
    run: str,
    batch_created_at: datetime,
    classifier: Classifier | None = None,
    rules: Mapping[str, str] = CATEGORY_RULES,
    files_per_step: int = 100,
    skip_done: bool = True,
    rejects: str | None = None,
    parallelism: int | None = None,
    settings: Settings = DEFAULTS,
    cfg: SchemaConfig = SchemaConfig(),
    bytes_per_step: int | None = None,
) -> StreamingQuery:
    """Classifies the work files not yet done, a bounded number per step, and appends the rows.

    ``bytes_per_step`` bounds a step by the size of its files instead of their
    number (a file larger than that is a step of its own). ``sink`` is a fact
    folder or a catalog table, the same that batch runs append to, under the names that ``cfg`` gives. The rows of
    a step form a load of their own, ``<run>-<step>``, which replaces itself
    when the step is repeated, so one that failed half-way leaves no
    duplicates. The checkpoint remembers finished files. ``skip_done`` leaves
    out pairs stored by any other load; only the days of the step are read for
    that.
    """

    def step(questions: DataFrame, batch_id: int) -> None:
        session, load = questions.sparkSession, f"{run}-{batch_id}"
        with scratch(session) as keep:
            if cfg.collation:
                questions = questions.withColumn("input_text", F.collate("input_text", cfg.collation))
            asked = keep(one_per_pair(questions))
            if skip_done:
                first, last = asked.agg(F.min("created_at"), F.max("created_at")).first()
                stored = facts_of_other_loads(session, sink, cfg, load).filter(F.col("created_date").between(first, last))
                asked = skip_existing(asked, stored)
            facts = classify_questions(
                asked, categories, batch_created_at, classifier, rules, parallelism, settings
            ).select(*KEYWORDS)
            good, bad = split_rejects(keep(facts) if rejects else facts, settings)
            store_keywords(good, sink, cfg, mode="replace", load=load)
            if rejects:
                write_rejects(bad, rejects, load)

    bound = ("maxFilesPerTrigger", files_per_step) if bytes_per_step is None else ("maxBytesPerTrigger", bytes_per_step)
    return (
        spark.readStream.schema(WORK_SCHEMA)
        .option(*bound)
        .parquet(work)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
