"""Unique questions, repeat counts and work ordering over the raw messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qlens.functions.text import question_key
from qlens.period import Period, day, in_period
from qlens.storage import shuffle_partitions, stable

# Rows of a top-k that one task may gather.
AT_ONCE = 100_000


def unique_questions(chats: DataFrame, period: Period | None = None, ordered: bool = True) -> DataFrame:
    """Each question of the whole range: repeat count and last day asked.

    One aggregate: counts combine map-side, so a very hot question costs one
    row per input partition.
    """
    out = (
        in_period(chats, period)
        .groupBy("input_text")
        .agg(F.count(F.lit(1)).alias("total_count"), F.max("created_at").alias("last_seen"))
        .select("input_text", "total_count", day("last_seen").alias("created_at"))
    )
    return out.orderBy(*work_order()) if ordered else out


def work_order() -> list:
    """Total order in which unique questions are worked off."""
    return [F.col("total_count").desc(), F.col("created_at").asc(), F.col("input_text").asc()]


def unique_questions_per_day(chats: DataFrame, period: Period | None = None) -> DataFrame:
    """Each question of each day with its count on that day."""
    return (
        in_period(chats, period)
        .groupBy(day("created_at").alias("created_at"), "input_text")
        .agg(F.count(F.lit(1)).alias("total_count"))
        .select("input_text", "total_count", "created_at")
    )


def distinct_questions(chats: DataFrame, period: Period | None = None) -> DataFrame:
    """Distinct (question, day), sorted."""
    return (
        in_period(chats, period)
        .select("input_text", day("created_at").alias("date"))
        .distinct()
        .orderBy("date", "input_text")
    )


def with_repeat_count(chats: DataFrame, key: str = "input_text", spread: str = "chatting_pk") -> DataFrame:
    """Every row plus the number of rows sharing its key.

    A plain window would sort all rows of a hot key in one task. Rows are
    counted per (key, slice) instead, the few slice counts of a key are summed,
    and the join back runs on (key, slice), so a hot key stays spread out.
    """
    slices = shuffle_partitions(chats.sparkSession)
    sliced = chats.withColumn("_slice", F.pmod(F.xxhash64(spread), F.lit(slices)).cast("int"))
    per_slice = sliced.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    totals = per_slice.select(
        "_key", "_s", F.sum("_n").over(Window.partitionBy("_key")).alias("total_count")
    )
    return sliced.join(
        totals, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_s"))
    ).select(*chats.columns, "total_count")


def latest_per_question(chats: DataFrame, key: str = "input_text") -> DataFrame:
    """The whole latest row of each question; ties go to the higher key.

    The rank filter is applied before the shuffle too, so each task sends at
    most one row per question.
    """
    w = Window.partitionBy(key).orderBy(F.col("created_at").desc(), F.col("chatting_pk").desc())
    return chats.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def existing_keys(keywords: DataFrame, period: Period | None = None) -> DataFrame:
    """Distinct ``question|day`` keys already classified."""
    return (
        in_period(keywords, period)
        .select(question_key("query_text", "created_at").alias("unique_key"))
        .distinct()
    )


def skip_existing(questions: DataFrame, keywords: DataFrame, period: Period | None = None) -> DataFrame:
    """Unique questions of a day without a classified row on that day."""
    done = (
        in_period(keywords, period)
        .select(day("created_at").alias("_day"), F.col("query_text").alias("_text"))
        .distinct()
    )
    return questions.join(
        done, (F.col("input_text") == F.col("_text")) & (F.to_date("created_at") == F.col("_day")), "left_anti"
    )


def resume_offset(questions: DataFrame, start_index: int, order: list | None = None) -> DataFrame:
    """Questions from position ``start_index`` of the work order on."""
    return positioned(questions, order or work_order()).filter(F.col("_at") >= start_index).drop("_at")


def first_in_order(rows: DataFrame, limit: int, order: list, at_once: int = AT_ONCE) -> DataFrame:
    """The first ``limit`` rows in the given order, sorted.

    A limit of up to ``at_once`` is a top-k: each task hands on its first rows
    to one. A larger one would gather all it asks for in that task, so the
    rows are numbered instead.
    """
    if limit <= at_once:
        return rows.orderBy(*order).limit(limit)
    return positioned(rows, order).filter(F.col("_at") < limit).drop("_at")


def positioned(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` sorted, with ``_at``, their position from 0.

    ``DataFrame.offset`` or a window over all would move every row through one task. The sorted rows
    are kept (reliable checkpoint), counted per partition, and numbered from
    the partition totals, which are as few as the partitions.
    """
    ordered = stable(rows.orderBy(*order))
    placed = ordered.withColumn("_part", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("_at", F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )
