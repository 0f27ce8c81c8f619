"""Joins with the category dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qlens.functions.text import strip

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def bounded_dimension(
    dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``dim`` marked for broadcast when its rows and bytes are within the bounds.

    The check stops reading just past the row bound. A larger table is returned
    unmarked and joins by shuffle, with the runtime free to re-plan.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in dim.columns), F.lit(0)
    )
    size = dim.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    small = size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes
    return F.broadcast(dim) if small else dim


def with_category_name(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Adds ``category_name``; rows with an unknown or NULL id keep a NULL name."""
    return df.join(categories.select("category_id", "category_name"), "category_id", "left")


def category_ids(categories: DataFrame) -> DataFrame:
    """One usable id per name: the highest of duplicates, never 0 or NULL."""
    return (
        categories.filter(F.col("category_id") != 0)
        .groupBy(F.col("category_name").alias("_name"))
        .agg(F.max("category_id").alias("category_id"))
    )


def resolve_category_ids(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Replaces category names by ids; rows with an unmatched name drop out."""
    return df.join(category_ids(categories), strip("category_name") == F.col("_name")).drop("_name")
