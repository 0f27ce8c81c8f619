"""Run logs: ``time - logger - level - message`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qlens.functions.fixed_values import LOG_LINE_PATTERN


def parse_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Columns logged_at, logger, level, message.

    A line in another layout (a continuation) keeps its text as the message.
    """
    line = F.col(col)
    fits = line.rlike(LOG_LINE_PATTERN)

    def part(i: int):
        return F.when(fits, F.regexp_extract(line, LOG_LINE_PATTERN, i))

    return lines.select(
        part(1).try_cast("timestamp_ntz").alias("logged_at"),
        part(2).alias("logger"),
        part(3).alias("level"),
        F.coalesce(part(4), line).alias("message"),
    )


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_lines(spark.read.text(path))
