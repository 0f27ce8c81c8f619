"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
BATCH_ROWS = 2_000


def travels(module: str) -> None:
    """Functions of ``module`` go to the executors by value, where this package need not be installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def text_or_empty(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def id_remainder(mod: int, name: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def whole_row(docs: DataFrame, alias: str = "row") -> Column:
    """All columns as one struct, so that helper columns beside it can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(alias)


def lowest(h: Column, wanted: int, of: int) -> Column:
    """True for the lowest of ``of`` evenly spread 64-bit hashes, about ``wanted`` of them; for all, where there are no more.

    Put before a sort with a limit, it keeps each task from handing on that many rows of its own.
    """
    return F.lit(True) if of <= wanted else h < F.lit(-(1 << 63) + int(wanted / of * 2**64))


def per_worker(key: Hashable, make: Callable[[], T]) -> T:
    """An object kept by the Python worker from task to task; only for what doesn't alter results.

    The one used last stays, so that a worker that serves many stages doesn't
    gather what all of them have made.
    """
    held = sys.__dict__.setdefault("_qlens_held", {})
    if key not in held:
        held.clear()
        give_back()
        held[key] = make()
    return held[key]


def give_back() -> None:
    """Returns memory that the worker's allocators hold free, which an executor with several idle workers would miss."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """For an application, before it calls these operators: Arrow batches of at most ``rows`` rows in this session.

    Spark's own 10,000 rows of whole texts would take the memory of several
    tasks, in the JVM and again in Python.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


travels(__name__)
