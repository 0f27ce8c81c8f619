"""Daily bookkeeping: volumes, reconciliation, run results and run-log counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qlens.functions.fixed_values import LOG_API_FAILED, LOG_API_OK, LOG_FAILED_PATTERN, LOG_FINISHED_PATTERN
from qlens.operators.summary import classify_summary
from qlens.period import Period, day, day_spine, in_period, loaded_on

PIECE = 1 << 16


def daily_totals(chats: DataFrame, period: Period | None = None) -> DataFrame:
    """Distinct questions and messages per day."""
    return (
        in_period(chats, period)
        .groupBy(day("created_at").alias("date"))
        .agg(
            F.count_distinct("input_text").alias("unique_questions"),
            F.count(F.lit(1)).alias("total_messages"),
        )
        .orderBy("date")
    )


def keyword_daily(keywords: DataFrame, period: Period | None = None, loaded: date | str | None = None) -> DataFrame:
    """Distinct questions and rows classified per day; optionally only rows loaded on one day."""
    facts = keywords if loaded is None else loaded_on(keywords, loaded)
    return (
        in_period(facts, period)
        .groupBy(day("created_at").alias("date"))
        .agg(
            F.count_distinct("query_text").alias("unique_queries"),
            F.count(F.lit(1)).alias("total_records"),
        )
        .orderBy("date")
    )


def keyword_volume(keywords: DataFrame, period: Period | None = None) -> DataFrame:
    """Distinct questions and summed counts per day."""
    return (
        in_period(keywords, period)
        .groupBy(day("created_at").alias("date"))
        .agg(
            F.count_distinct("query_text").alias("unique_queries"),
            F.sum("query_count").alias("total_count"),
        )
        .orderBy("date")
    )


def daily_reconciliation(
    chats: DataFrame, keywords: DataFrame, categories: DataFrame, period: Period | None = None
) -> DataFrame:
    """Source against classification per day, over the days of either side."""
    source = daily_totals(chats, period).select("date", F.col("unique_questions").alias("source_questions"))
    classified = (
        classify_summary(keywords, categories, period)
        .groupBy(day("created_at").alias("date"))
        .agg(
            F.count_distinct("query_text").alias("classified_questions"),
            F.count("query_text").alias("classified_records"),
            F.sum("query_count").alias("classified_total"),
        )
    )
    numbers = ("source_questions", "classified_questions", "classified_records", "classified_total")
    return (
        source.join(classified, "date", "full")
        .select("date", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers])
        .withColumn("difference", F.col("source_questions") - F.col("classified_questions"))
        .orderBy("date")
    )


def run_ledger(
    questions: DataFrame, facts: DataFrame, period: Period, rejected: DataFrame | None = None
) -> DataFrame:
    """Per day of the period: questions, rows written, questions skipped, status and error.

    A day without questions succeeds. A day fails when rows were produced but
    none could be stored.
    """
    spark = questions.sparkSession
    zero = F.lit(0).cast("bigint")
    done = facts.groupBy(
        F.to_date("created_at").alias("_day"), F.col("query_text").alias("_text")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    per_question = questions.join(
        done, (F.to_date("created_at") == F.col("_day")) & (F.col("input_text") == F.col("_text")), "left"
    )
    per_day = per_question.groupBy(F.to_date("created_at").alias("date")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum("_rows"), zero).alias("processed"),
        F.count_if(F.col("_rows").isNull()).alias("skipped"),
    )
    spine = day_spine(spark, period).join(per_day, "date", "left")
    if rejected is None:
        spine = spine.withColumn("rejected", zero)
    else:
        bad = rejected.groupBy(F.to_date("created_at").alias("date")).agg(F.count(F.lit(1)).alias("rejected"))
        spine = spine.join(bad, "date", "left")
    counts = ("total_rows", "processed", "skipped", "rejected")
    failed = (F.col("rejected") > 0) & (F.col("processed") == 0)
    return (
        spine.select("date", *[F.coalesce(c, zero).alias(c) for c in counts])
        .withColumn("status", F.when(failed, "FAILED").otherwise("SUCCESS"))
        .withColumn("error", F.when(failed, F.lit("no row could be stored")))
        .orderBy("date")
    )


def run_totals(ledger: DataFrame) -> DataFrame:
    """Sums over the days, failed days, and SUCCESS or PARTIAL_SUCCESS.

    Several days that all fail are still a partial success; one failed day alone is a failure.
    """
    failed_days = F.array_sort(F.collect_list(F.when(F.col("status") == "FAILED", F.col("date").cast("string"))))
    return (
        ledger.agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("total_rows").alias("total_rows"),
            F.sum("processed").alias("processed_count"),
            F.sum("skipped").alias("skipped_count"),
            F.array_join(failed_days, ", ").alias("failed_dates"),
        )
        .withColumn(
            "status",
            F.when(F.col("failed_dates") == "", "SUCCESS")
            .when(F.col("days") == 1, "FAILED")
            .otherwise("PARTIAL_SUCCESS"),
        )
    )


def result_diff(left: DataFrame, right: DataFrame, distinct: bool = False) -> DataFrame:
    """Rows only in one of two results, tagged ``left`` or ``right``; empty when they agree.

    Each side is read once: rows count +1 or -1, and one aggregate over both
    leaves what doesn't cancel out, with as many copies as it is short of.
    """
    columns = [F.col(f"`{c}`") for c in left.columns]
    both = left.select(*columns, F.lit(1).alias("_sign")).union(right.select(*columns, F.lit(-1)))
    if distinct:
        surplus = F.max("_sign") + F.min("_sign")  # 0 where both have the row
        count = F.when(surplus > 0, 1).when(surplus < 0, -1).otherwise(0)
    else:
        count = F.sum("_sign")
    counted = both.groupBy(*columns).agg(count.cast("bigint").alias("_sign")).filter("_sign <> 0")
    side = F.when(F.col("_sign") > 0, "left").otherwise("right").alias("side")
    # a row's copies are written out in pieces, so that no array grows with them
    pieces = counted.select("*", F.explode(F.expr(f"sequence(0L, (abs(_sign) - 1) div {PIECE})")).alias("_piece"))
    copies = F.explode(F.expr(f"sequence(1L, least({PIECE}L, abs(_sign) - _piece * {PIECE}))"))
    return pieces.select(*columns, side, copies.alias("_copy")).drop("_copy")


def same_result(left: DataFrame, right: DataFrame) -> bool:
    return result_diff(left, right).isEmpty()


def log_counts(lines: DataFrame) -> DataFrame:
    """Run-log lines per day and level, with finished and failed jobs and model calls."""

    def having(pattern: str, name: str):
        return F.count_if(F.col("message").rlike(pattern)).alias(name)

    return lines.groupBy(F.to_date("logged_at").alias("date"), "level").agg(
        F.count(F.lit(1)).alias("lines"),
        having(LOG_FINISHED_PATTERN, "finished"),
        having(LOG_FAILED_PATTERN, "failed"),
        having(LOG_API_OK, "api_success"),
        having(LOG_API_FAILED, "api_failure"),
    )
