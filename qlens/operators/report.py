"""Report rows and the statistics drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qlens.config import DEFAULTS, Settings
from qlens.functions.fixed_values import NO_DATA, OVERVIEW_ITEMS, SHEET_TITLES
from qlens.functions.text import ellipsis
from qlens.operators.lookup import with_category_name
from qlens.operators.summary import FACT_ORDER
from qlens.period import Period, day, in_period


def report_rows(
    keywords: DataFrame,
    categories: DataFrame,
    period: Period | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row per (day, question): its most frequent real category and that category's first row.

    The default category counts only when there is no other; ties go to the
    lowest name; a question with only unknown categories keeps a NULL one.
    Two aggregates, both combining map-side: the first leaves at most one row
    per category of a pair, so the second never meets a large group.
    """
    name = F.col("category_name")
    facts = in_period(keywords, period).filter(F.col("query_text").isNotNull() & F.col("created_at").isNotNull())
    per_name = (
        with_category_name(facts, categories)
        .groupBy(day("created_at").alias("date"), "query_text", "category_name")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*FACT_ORDER)).alias("f"))
    )
    # Lowest rank wins: named real category, then unknown, then the default.
    rank = (
        F.when(name.isNull(), 1).when(name == settings.default_category_name, 2).otherwise(0)
    )
    best = F.min(F.struct(rank.alias("rank"), (-F.col("n")).alias("n"), name, F.col("f"))).alias("b")
    return (
        per_name.groupBy("date", "query_text")
        .agg(best)
        .select(
            "date",
            "query_text",
            "b.category_name",
            "b.f.query_count",
            "b.f.keyword",
            "b.f.created_at",
        )
    )


def report_overview(rows: DataFrame, period: Period) -> DataFrame:
    """Period, rows, distinct questions, distinct keywords, total count."""
    return rows.agg(
        F.lit(period.label).alias("period"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("query_text").alias("unique_questions"),
        F.count_distinct("keyword").alias("unique_keywords"),
        F.coalesce(F.sum("query_count"), F.lit(0)).alias("total_query_count"),
    )


def _sum_counts() -> Column:
    return F.coalesce(F.sum("query_count"), F.lit(0)).alias("total_queries")


def report_by_category(rows: DataFrame) -> DataFrame:
    """Per category, unknown ones together as NULL, most rows first."""
    return (
        rows.groupBy("category_name")
        .agg(
            F.count("query_text").alias("record_count"),
            _sum_counts(),
            F.count_distinct("keyword").alias("unique_keywords"),
        )
        .orderBy(F.col("record_count").desc(), "category_name")
    )


def report_by_day(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("date")
        .agg(
            F.count("query_text").alias("record_count"),
            F.count_distinct("query_text").alias("unique_questions"),
            _sum_counts(),
            F.count_distinct("keyword").alias("unique_keywords"),
        )
        .orderBy("date")
    )


def report_top_keywords(rows: DataFrame, n: int = 10) -> DataFrame:
    return (
        rows.filter(F.col("keyword").isNotNull())
        .groupBy("keyword")
        .agg(F.count("query_text").alias("record_count"), _sum_counts())
        .orderBy(F.col("record_count").desc(), "keyword")
        .limit(n)
    )


def report_top_questions(rows: DataFrame, n: int = 10, keywords: int = 3) -> DataFrame:
    """Questions by the count of their first day, with their first distinct keywords.

    The ``n`` questions are picked first; keywords are gathered for those only,
    so ``rows`` is read more than once and is best materialized before.
    """
    known = F.when(F.col("query_count").isNotNull(), F.col("date"))
    top = (
        rows.groupBy("query_text")
        .agg(F.min_by("query_count", known).alias("query_count"))
        .orderBy(F.col("query_count").desc_nulls_last(), "query_text")
        .limit(n)
    )
    first_use = (
        rows.join(F.broadcast(top.select("query_text")), "query_text", "left_semi")
        .filter(F.col("keyword").isNotNull())
        .groupBy("query_text", "keyword")
        .agg(F.min("date").alias("first_day"))
        .groupBy("query_text")
        .agg(F.array_sort(F.collect_list(F.struct("first_day", "keyword"))).alias("used"))
        .select(
            "query_text",
            F.array_join(F.slice(F.col("used")["keyword"], 1, keywords), ", ").alias("keywords"),
        )
    )
    return (
        top.join(first_use, "query_text", "left")
        .select("query_text", "query_count", F.coalesce("keywords", F.lit("")).alias("keywords"))
        .orderBy(F.col("query_count").desc_nulls_last(), "query_text")
    )


def titled(df: DataFrame, sheet: str) -> DataFrame:
    """The columns of a sheet under their printed titles."""
    return df.toDF(*SHEET_TITLES[sheet][1])


def main_sheet(rows: DataFrame) -> DataFrame:
    cols = ("query_text", "keyword", "category_name", "query_count", "created_at")
    return titled(rows.select(*cols), "main")


def top_questions_sheet(top: DataFrame) -> DataFrame:
    return titled(top.withColumn("query_text", ellipsis("query_text", 100)), "top_questions")


def overview_sheet(overview: DataFrame) -> DataFrame:
    """Overview as label and value rows, in print order."""
    cols = ("period", "total_records", "unique_questions", "unique_keywords", "total_query_count")
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("item"), F.col(c).cast("string").alias("value"))
            for label, c in zip(OVERVIEW_ITEMS, cols)
        ]
    )
    return titled(overview.select(F.explode(pairs).alias("p")).select("p.item", "p.value"), "overview")


def with_placeholder(df: DataFrame, row: list[Column]) -> DataFrame:
    """``df``, or the one given row when ``df`` is empty."""
    filler = (
        df.limit(1)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n = 0")
        .select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(row, df.schema.fields)])
    )
    return df.unionByName(filler)


def main_sheet_or_placeholder(rows: DataFrame, period: Period) -> DataFrame:
    sheet = main_sheet(rows)
    return with_placeholder(
        sheet, [F.lit(NO_DATA), F.lit(""), F.lit(""), F.lit(0), F.lit(str(period.start))]
    )


def report_sheets(rows: DataFrame, period: Period) -> dict[str, DataFrame]:
    """The six sheets, keyed by their printed names. Materialize ``rows`` first: all six read it."""
    built = {
        "main": main_sheet_or_placeholder(rows, period),
        "by_category": titled(report_by_category(rows), "by_category"),
        "by_day": titled(report_by_day(rows), "by_day"),
        "top_keywords": titled(report_top_keywords(rows), "top_keywords"),
        "top_questions": top_questions_sheet(report_top_questions(rows)),
        "overview": overview_sheet(report_overview(rows, period)),
    }
    return {SHEET_TITLES[k][0]: df for k, df in built.items()}
