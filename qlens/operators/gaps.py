"""Which (question, day) pairs were never classified, and how far a period is covered.

Three meanings of "missing" exist side by side and are kept apart:

``first_day``  the day is not the day of the question's first classified row
``per_day``    the question has no classified row on that day
``ever``       the question has no classified row on any day of the period

Messages are reduced to one row per (day, question) before any join, so a
question asked by a third of all users is one row per day from there on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qlens.operators.summary import classify_summary
from qlens.operators.questions import first_in_order
from qlens.period import Period, data_day_spine, day, day_spine, in_period, loaded_on, loaded_since

MODES = ("first_day", "per_day", "ever")
PAIRS = {"missing_date", "input_text", "missing_count", "first_seen"}


def asked_pairs(chats: DataFrame, period: Period | None = None) -> DataFrame:
    """One row per (day, question): messages and first time seen.

    Wherever messages are taken, this result of theirs for the same period may
    be given instead, so that a run reads the messages once.
    """
    if PAIRS <= set(chats.columns):
        return chats
    return (
        in_period(chats, period)
        .groupBy(day("created_at").alias("missing_date"), "input_text")
        .agg(F.count(F.lit(1)).alias("missing_count"), F.min("created_at").alias("first_seen"))
    )


def classified_pairs(keywords: DataFrame, period: Period | None, mode: str) -> DataFrame:
    """What counts as classified under ``mode``: (day, text) pairs, or texts for ``ever``.

    NULL questions match nothing and are left out. The day comes first, like in
    ``asked_pairs``, so that both sides are partitioned alike for the join.
    """
    facts = in_period(keywords, period).filter(F.col("query_text").isNotNull() & F.col("created_at").isNotNull())
    text, known_day = F.col("query_text").alias("_text"), day("created_at").alias("_day")
    if mode == "first_day":
        return facts.groupBy(text).agg(day(F.min("created_at")).alias("_day"))
    if mode == "per_day":
        return facts.select(known_day, text).filter(F.col("_day").isNotNull()).distinct()
    if mode == "ever":
        return facts.select(text).distinct()
    raise ValueError(f"mode must be one of {MODES}")


def without(pairs: DataFrame, classified: DataFrame) -> DataFrame:
    """Asked pairs not among the classified ones; NULL questions always remain."""
    same = F.col("input_text") == F.col("_text")
    if "_day" in classified.columns:
        same = (F.col("missing_date") == F.col("_day")) & same
    return pairs.join(classified, same, "left_anti")


def missing_detail(
    chats: DataFrame,
    keywords: DataFrame,
    period: Period | None = None,
    mode: str = "first_day",
    since: date | str | None = None,
) -> DataFrame:
    """Missing pairs with messages and first time seen.

    ``since`` believes only classified rows loaded on or after that day.
    """
    facts = keywords if since is None else loaded_since(keywords, since)
    return without(asked_pairs(chats, period), classified_pairs(facts, period, mode))


def missing_work(
    chats: DataFrame,
    keywords: DataFrame,
    period: Period | None = None,
    mode: str = "first_day",
    limit: int | None = None,
) -> DataFrame:
    """Work list (day, question, messages); ``limit`` takes the first in day and text order."""
    work = missing_detail(chats, keywords, period, mode).drop("first_seen")
    return work if limit is None else first_in_order(work, limit, [F.col("missing_date"), F.col("input_text")])


def missing_pairs(
    chats: DataFrame,
    keywords: DataFrame,
    period: Period | None = None,
    mode: str = "first_day",
    since: date | str | None = None,
) -> DataFrame:
    """Missing (question, day) pairs."""
    return missing_detail(chats, keywords, period, mode, since).select("input_text", "missing_date")


def missing_status(
    chats: DataFrame, keywords: DataFrame, period: Period | None = None, mode: str = "first_day"
) -> DataFrame:
    """Messages missing per day."""
    return (
        missing_detail(chats, keywords, period, mode)
        .groupBy("missing_date")
        .agg(F.sum("missing_count").alias("missing_total"))
        .orderBy("missing_date")
    )


def missing_pairs_per_day(
    chats: DataFrame, keywords: DataFrame, period: Period | None = None, mode: str = "per_day"
) -> DataFrame:
    """Missing pairs per day, NULL questions included."""
    return (
        missing_detail(chats, keywords, period, mode)
        .groupBy("missing_date")
        .agg(F.count(F.lit(1)).alias("total_missing_count"))
        .orderBy("missing_date")
    )


def verify_remaining(
    chats: DataFrame, keywords: DataFrame, period: Period | None = None, since: date | str | None = None
) -> DataFrame:
    """Distinct questions still missing per day; a pair is unique, so counting texts is enough."""
    return (
        missing_detail(chats, keywords, period, "per_day", since)
        .groupBy("missing_date")
        .agg(F.count("input_text").alias("remaining_missing_count"))
        .orderBy("missing_date")
    )


def verify_verdict(remaining: DataFrame) -> DataFrame:
    """Total still missing and whether the repair succeeded."""
    total = F.coalesce(F.sum("remaining_missing_count"), F.lit(0))
    return remaining.agg(
        total.alias("remaining_missing_count"), (total == 0).alias("verification_success")
    )


def final_missing(
    chats: DataFrame, keywords: DataFrame, period: Period | None, since: date | str
) -> DataFrame:
    """Distinct questions missing when only rows loaded since a day count."""
    return missing_detail(chats, keywords, period, "per_day", since).agg(
        F.count_distinct("input_text").alias("final_missing_count")
    )


def union_classified(
    keywords: DataFrame, categories: DataFrame, period: Period | None, since: date | str
) -> DataFrame:
    """(question, day) from the classification summary together with rows loaded since a day."""
    pair = (day("created_at").alias("dt"), F.col("query_text"))
    summary = classify_summary(keywords, categories, period).select(*pair)
    loaded = loaded_since(keywords, since).select(*pair)
    return summary.union(loaded).distinct()


def final_missing_union(
    chats: DataFrame, keywords: DataFrame, categories: DataFrame, period: Period | None, since: date | str
) -> DataFrame:
    """``final_missing`` against summary and loaded rows together."""
    pairs = union_classified(keywords, categories, period, since).select(
        F.col("dt").alias("_day"), F.col("query_text").alias("_text")
    )
    return without(asked_pairs(chats, period), pairs).agg(
        F.count_distinct("input_text").alias("final_missing_count")
    )


def _spine(chats: DataFrame, period: Period | None) -> DataFrame:
    if period is not None:
        return day_spine(chats.sparkSession, period)
    return data_day_spine(chats, "missing_date" if PAIRS <= set(chats.columns) else "created_at")


def coverage_by_day(chats: DataFrame, keywords: DataFrame, period: Period | None = None) -> DataFrame:
    """Per day of the period: questions, messages, questions first processed, questions missing.

    Messages and facts are read once: each (day, question) row carries the
    question's first classified day, if any, and the same first days are counted.
    """
    first_days = classified_pairs(keywords, period, "first_day")
    asked = asked_pairs(chats, period).join(first_days, F.col("input_text") == F.col("_text"), "left")
    per_day = asked.groupBy(F.col("missing_date").alias("date")).agg(
        F.count("input_text").alias("unique_questions"),
        F.sum("missing_count").alias("total_messages"),
        F.count_if(F.col("_day").isNull()).alias("missing_questions"),
    )
    processed = first_days.groupBy(F.col("_day").alias("date")).agg(
        F.count(F.lit(1)).alias("processed_questions")
    )
    counts = ("unique_questions", "total_messages", "processed_questions", "missing_questions")
    return (
        _spine(chats, period)
        .join(per_day, "date", "left")
        .join(processed, "date", "left")
        .select("date", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts])
        .orderBy("date")
    )


def percent(part, whole):
    """Percentage to one decimal, half to even; 0 when there is nothing to divide by."""
    return F.when(whole > 0, F.bround(part / whole * 100, 1)).otherwise(F.lit(0.0))


def coverage_totals(by_day: DataFrame) -> DataFrame:
    """Sums of ``coverage_by_day`` and the processing rate."""
    return by_day.agg(
        F.coalesce(F.sum("unique_questions"), F.lit(0)).alias("total_unique_questions"),
        F.coalesce(F.sum("processed_questions"), F.lit(0)).alias("total_processed_questions"),
        F.coalesce(F.sum("missing_questions"), F.lit(0)).alias("total_missing_questions"),
    ).withColumn("processing_rate", percent(F.col("total_processed_questions"), F.col("total_unique_questions")))


def load_verdict(
    chats: DataFrame, keywords: DataFrame, period: Period | None, on: date | str
) -> DataFrame:
    """Was everything loaded? Per-day distinct counts summed, and a verdict.

    ``loaded``: nothing missing and rows arrived on the day; ``nothing_loaded``:
    nothing missing and no new rows; ``missing``: questions remain.
    """

    known = classified_pairs(keywords, period, "per_day").withColumn("_known", F.lit(True))
    asked = asked_pairs(chats, period).join(
        known, (F.col("missing_date") == F.col("_day")) & (F.col("input_text") == F.col("_text")), "left"
    )
    zero = F.lit(0).cast("bigint")
    parts = (
        asked.select(
            F.count("input_text").alias("total_questions"),
            zero.alias("processed_questions"),
            zero.alias("loaded_questions"),
            F.count_if(F.col("_known").isNull() & F.col("input_text").isNotNull()).alias("missing_questions"),
        )
        .unionByName(
            known.select(
                zero.alias("total_questions"),
                F.count("_text").alias("processed_questions"),
                zero.alias("loaded_questions"),
                zero.alias("missing_questions"),
            )
        )
        .unionByName(
            classified_pairs(loaded_on(keywords, on), period, "per_day").select(
                zero.alias("total_questions"),
                zero.alias("processed_questions"),
                F.count("_text").alias("loaded_questions"),
                zero.alias("missing_questions"),
            )
        )
    )
    counts = ("total_questions", "processed_questions", "loaded_questions", "missing_questions")
    left = parts.agg(*[F.sum(c).alias(c) for c in counts])
    return left.withColumn(
        "processing_rate", percent(F.col("processed_questions"), F.col("total_questions"))
    ).withColumn(
        "verdict",
        F.when(F.col("missing_questions") > 0, "missing")
        .when(F.col("loaded_questions") > 0, "loaded")
        .otherwise("nothing_loaded"),
    )
