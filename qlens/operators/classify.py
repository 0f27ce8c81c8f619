"""Questions to classified fact rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qlens.config import DEFAULTS, KEYWORDS, Settings, binary
from qlens.functions.fixed_values import CATEGORY_RULES
from qlens.functions.responses import parse_responses
from qlens.functions.text import (
    backfill_keyword,
    cap_by_question,
    fallback_classify,
    is_blank,
    strip,
    truncate_keyword,
)
from qlens.operators.lookup import resolve_category_ids
from qlens.period import timestamp
from qlens.storage import shuffle_partitions

Classifier = Callable[[str], Any]


def ask_classifier(texts: DataFrame, classifier: Classifier, text: str = "input_text") -> DataFrame:
    """Adds ``response`` by calling ``classifier`` once per row, in Arrow batches.

    A failed call leaves NULL, which the parser turns into the word rules.
    ``texts`` should hold distinct questions. The functions below are nested so
    that they travel to the executors, where this package need not be installed.
    """

    def as_response(answer: Any) -> str:
        """Response text; a bare list is wrapped like a tool call."""
        if isinstance(answer, str):
            return answer
        if isinstance(answer, list):
            call = {"function": {"arguments": {"keywords_with_categories": answer}}}
            answer = {"result": {"message": {"toolCalls": [call]}}}
        return json.dumps(answer, ensure_ascii=False)

    def answer(question: str) -> str | None:
        try:
            return as_response(classifier(question))
        except Exception:  # any failure of a user's classifier means "no answer"
            return None

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(response=[None if q is None else answer(q) for q in frame[text]])

    return texts.select(text).mapInPandas(batches, f"`{text}` string, response string")


def classify(
    questions: DataFrame,
    classifier: Classifier | None = None,
    rules: Mapping[str, str] = CATEGORY_RULES,
    parallelism: int | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Adds ``classification`` to every question.

    Without a classifier the word rules answer, as column expressions. A
    classifier sees each distinct question once for all days; its answers are
    joined back. ``parallelism`` sets how many tasks call it, by default as
    many as a shuffle has: a call may take seconds, and the few bytes of a
    list of questions would otherwise be merged into one task.
    """
    other = settings.default_category_name
    if classifier is None:
        return questions.withColumn("classification", fallback_classify("input_text", rules, other))
    texts = questions.select("input_text").filter(F.col("input_text").isNotNull()).distinct()
    # by a hash, because a repartition by the text itself is one with the de-duplication's shuffle and merged like it
    texts = texts.repartition(parallelism or shuffle_partitions(questions.sparkSession), F.xxhash64("input_text"))
    answers = parse_responses(ask_classifier(texts, classifier), rules=rules, other=other).select(
        "input_text", "classification"
    )
    return questions.join(answers, "input_text", "left")


def explode_classification(classified: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per question, keyword and category name.

    Blank keywords drop out; an over-long one gives way to the question, a
    blank or default one to the question's simple keyword. The outer form of
    explode keeps the optimizer from testing the classification itself, which
    would move that work below the de-duplication, to every raw message.
    """
    carried = [c for c in classified.columns if c != "classification"]
    items = (
        classified.select(*carried, F.explode_outer("classification").alias("item"))
        .select(*carried, strip("item.keyword").alias("keyword"), "item.categories")
        .filter(~is_blank("keyword"))
    )
    named = items.select(*carried, "keyword", F.explode_outer("categories").alias("category_name"))
    return named.filter(F.col("category_name").isNotNull()).withColumn(
        "keyword", backfill_keyword(cap_by_question("keyword", "input_text"), "input_text", settings.default_category_name)
    )


def to_facts(
    exploded: DataFrame, categories: DataFrame, batch_created_at: datetime | Column, settings: Settings = DEFAULTS
) -> DataFrame:
    """Fact rows (plus the category name) from exploded classifications."""
    loaded = batch_created_at if isinstance(batch_created_at, Column) else timestamp(batch_created_at)
    return resolve_category_ids(exploded, categories).select(
        F.col("input_text").alias("query_text"),
        truncate_keyword("keyword", settings.max_keyword_length).alias("keyword"),
        F.col("category_id").cast("int").alias("category_id"),
        F.col("total_count").cast("bigint").alias("query_count"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        loaded.cast("timestamp_ntz").alias("batch_created_at"),
        "category_name",
    )


def classify_questions(
    questions: DataFrame,
    categories: DataFrame,
    batch_created_at: datetime,
    classifier: Classifier | None = None,
    rules: Mapping[str, str] = CATEGORY_RULES,
    parallelism: int | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Unique questions (text, total_count, created_at) to fact rows, ready to append.

    Words are searched for in binary strings, whatever the questions' collation.
    """
    plain = questions.withColumn("input_text", binary("input_text"))
    answered = classify(plain, classifier, rules, parallelism, settings)
    return to_facts(explode_classification(answered, settings), categories, batch_created_at, settings)


def skipped_questions(questions: DataFrame, facts: DataFrame) -> DataFrame:
    """Questions of a day that produced no row."""
    done = facts.select(F.to_date("created_at").alias("_day"), F.col("query_text").alias("_text")).distinct()
    return questions.join(
        done, (F.col("input_text") == F.col("_text")) & (F.to_date("created_at") == F.col("_day")), "left_anti"
    )


def reject_reason(settings: Settings = DEFAULTS) -> Column:
    """Why a row cannot be stored; NULL when it can."""
    return (
        F.when(F.col("query_text").isNull(), "query_text is null")
        .when(F.col("keyword").isNull(), "keyword is null")
        .when(F.length("keyword") > settings.max_keyword_length, "keyword too long")
        .when(F.col("category_id").isNull(), "category_id is null")
        .when(F.col("query_count").isNull(), "query_count is null")
        .when(F.col("created_at").isNull(), "created_at is null")
    )


def split_rejects(facts: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(storable rows, rejected rows with a reason), decided before anything is written."""
    reason = reject_reason(settings)
    good = facts.filter(reason.isNull())
    bad = facts.withColumn("reject_reason", reason).filter("reject_reason IS NOT NULL")
    return good, bad


def reject_counts(facts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows per outcome: stored, or the reason they cannot be."""
    return facts.groupBy(F.coalesce(reject_reason(settings), F.lit("stored")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def category_distribution(facts: DataFrame) -> DataFrame:
    """Emitted rows per category name, most first."""
    return (
        facts.groupBy("category_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("row_count").desc(), "category_name")
    )


FACT_COLUMNS = list(KEYWORDS)
