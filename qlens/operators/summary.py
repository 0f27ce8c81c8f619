"""One classified row per question: first seen, first keyword, first real category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qlens.config import DEFAULTS, Settings
from qlens.operators.lookup import with_category_name
from qlens.period import Period, in_period

FACT_ORDER = ("created_at", "category_id", "keyword", "query_count")


def not_default(settings: Settings = DEFAULTS) -> Column:
    """True for a real category; NULL ids do not pass."""
    return F.col("category_id") != settings.default_category_id


def _first_fact() -> Column:
    return F.min(F.struct(*FACT_ORDER))


def first_occurrence(keywords: DataFrame, period: Period | None = None) -> DataFrame:
    """First classified row of each question: day and count."""
    return (
        in_period(keywords, period)
        .groupBy("query_text")
        .agg(_first_fact().alias("f"))
        .select("query_text", "f.created_at", "f.query_count")
    )


def earliest_keyword(keywords: DataFrame, period: Period | None = None) -> DataFrame:
    """Keyword of each question's first classified row."""
    return (
        in_period(keywords, period)
        .groupBy("query_text")
        .agg(_first_fact().alias("f"))
        .select("query_text", "f.keyword")
    )


def earliest_category(
    keywords: DataFrame, period: Period | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """First real category of each question, by its earliest day, then its id."""
    first = (
        in_period(keywords, period)
        .filter(not_default(settings))
        .groupBy("query_text", "category_id")
        .agg(F.min("created_at").alias("first_day"))
    )
    w = Window.partitionBy("query_text").orderBy("first_day", "category_id")
    return (
        first.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("query_text", "category_id")
    )


def _all_default(settings: Settings) -> Column:
    same = F.col("category_id") == settings.default_category_id
    return F.bool_and(F.coalesce(same, F.lit(False)))


def all_default_flag(
    keywords: DataFrame, period: Period | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Whether every classified row of a question has the default category."""
    return (
        in_period(keywords, period)
        .groupBy("query_text")
        .agg(_all_default(settings).alias("all_default"))
    )


def classify_summary(
    keywords: DataFrame,
    categories: DataFrame,
    period: Period | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row per question with its first day, count, keyword and category name.

    The category is the first real one, the default when all rows are default,
    and unknown when the rest have none. A single aggregate by question: one
    shuffle of map-side combined rows.
    """
    real = F.struct("created_at", "category_id")
    summary = (
        in_period(keywords, period)
        .filter(F.col("query_text").isNotNull())
        .groupBy("query_text")
        .agg(
            _first_fact().alias("f"),
            F.min(F.when(not_default(settings), real)).alias("c"),
            _all_default(settings).alias("all_default"),
        )
        .select(
            "query_text",
            "f.keyword",
            "f.created_at",
            "f.query_count",
            F.when(F.col("all_default"), settings.default_category_id)
            .otherwise(F.col("c.category_id"))
            .cast("int")
            .alias("category_id"),
        )
    )
    return with_category_name(summary, categories).select(
        "category_name", "query_text", "keyword", "created_at", "query_count"
    )


def classified_rows(keywords: DataFrame, categories: DataFrame, period: Period | None = None) -> DataFrame:
    """Every classified row of the period with its category name."""
    return with_category_name(in_period(keywords, period), categories).select(
        "category_name", "query_text", "keyword", "created_at", "query_count"
    )
