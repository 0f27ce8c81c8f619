"""Mixing sources to target weights by entropy balancing.

Of all document rates that give each source its target in words, those nearest
to one copy of everything in relative entropy are exp(lambda * size), capped:
the gradient of a convex dual in one lambda for each source. Newton's method
finds the root; an iteration is one Spark aggregate over how many documents of
a source have each size, since those share a rate. Rates are rounded into
copies by carrying what a size class is short of, or has too much, on to the
next smaller size, so that a source's words end within a short document of
its target. Which documents of a class get one copy more is decided by a hash of the id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from qlens.llm.common import text_or_empty, travels
from qlens.storage import kept, scratch

# The weights of sources in order, repeating; and the most copies of a document.
WEIGHTS = (5, 2, 1)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 100
TOLERANCE = 1e-7
# Documents of one source and size are numbered in so many slices of their ids' hash, each in a task of its own.
SLICES = 256
# Rows of one id, source and size that one row stands for are written out in pieces of so many.
PIECE = 1 << 16


def sizes(docs: DataFrame) -> DataFrame:
    """(key, source, size, doc_id, n): how many documents have each id, source and size; ``key`` is the source, never null."""
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("bigint").alias("size"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
    )
    return rows.groupBy("key", "size", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def numbered(sources: DataFrame, keep) -> DataFrame:
    """``sources`` with ``no``, their place from 0 by code point, null last; sorted by range and numbered from partition counts."""
    order = [F.col("key") == "", F.col("key")]
    placed = keep(
        sources.orderBy(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "part").withColumn("no", F.col("start") + F.col("at")).drop("part", "at", "start")


def with_targets(sources: DataFrame, most: int) -> DataFrame:
    """``sources`` (words, weight) with ``target``: all words by weight, at most ``most`` times a source's own, the excess reshared.

    Targets are min(most * words, level * weight). The level that makes them
    add up only rises while it is looked for, so that a source once at its
    most stays there.
    """
    total, weight = sources.agg(F.sum("words"), F.sum("weight")).first()
    full, level = -1, float(total or 0) / float(weight or 1)
    while True:
        held = F.col("words") * most < F.lit(level) * F.col("weight")
        count, words, weight = sources.agg(
            F.count_if(held), F.coalesce(F.sum(F.when(held, F.col("words") * most)), F.lit(0)), F.sum(F.when(~held, F.col("weight")))
        ).first()
        if count == full or not weight:
            return sources.withColumn("target", F.least((F.col("words") * most).cast("double"), F.lit(level) * F.col("weight")))
        full, level = count, float(total - words) / float(weight)


# --- the dual ----------------------------------------------------------------


def rate(most: int) -> str:
    """SQL of the rate of documents of ``size`` at ``tilt``; the exponent is cut first, so it can't overflow."""
    return f"IF(tilt * size >= {math.log(most)!r}D, {float(most)}D, exp(tilt * size))"


def tilts(classes: DataFrame, sources: DataFrame, most: int, keep, rounds: int = ROUNDS) -> DataFrame:
    """``sources`` (key, words, target, docs, shortest) with ``tilt``, the root of the dual's gradient.

    ``classes`` (key, size, n) are the documents. Each round sums words at the
    present rates, and the slope of that, over all classes; a Newton step on
    the logarithm of the words follows, halving the bracket where the step
    would leave it. Sums are decimal, so that they don't depend on the order of
    addition and reruns agree.
    """
    limit = f"{math.log(most)!r}D"
    state = sources.selectExpr(
        "key",
        "target",
        "least(0D, ln(target / words)) / shortest AS low",
        f"{limit} / shortest AS high",
        # where every document is needed as often as can be, the upper end is the root
        f"target >= {most * (1 - 1e-12)!r}D * words AS done",
        f"IF(target >= {most * (1 - 1e-12)!r}D * words, {limit} / shortest, ln(target / words) * docs / words) AS tilt",
    ).selectExpr("key", "target", "low", "high", "least(greatest(tilt, low), high) AS tilt", "done")
    for _ in range(rounds):
        # counted while it is written
        seen = Observation()
        state = keep(state.observe(seen, F.count_if(~F.col("done")).alias("open")))
        if not seen.get["open"]:
            break
        sums = (
            classes.join(state.filter("NOT done").select("key", "tilt"), "key")
            .selectExpr("key", f"n * size * {rate(most)} AS words", f"IF(tilt * size < {limit}, size, 0) AS by")
            .groupBy("key")
            .agg(
                F.expr("double(sum(CAST(words AS DECIMAL(38, 6)))) AS words"),
                F.expr("double(sum(CAST(words * by AS DECIMAL(38, 6)))) AS slope"),
            )
        )
        state = (
            state.join(sums, "key", "left")
            .selectExpr(
                "key",
                "target",
                "tilt",
                f"done OR abs(words - target) <= {TOLERANCE!r}D * target AS stays",
                "IF(words < target, tilt, low) AS low",
                "IF(words > target, tilt, high) AS high",
                "tilt + IF(slope > 0, words / slope * ln(target / words), NULL) AS step",
            )
            .selectExpr("*", "(low + high) / 2 AS middle")
            .selectExpr(
                "key",
                "target",
                "low",
                "high",
                "CASE WHEN stays THEN tilt WHEN step > low AND step < high THEN step ELSE middle END AS tilt",
                "stays OR middle <= low OR middle >= high AS done",
            )
        )
    return sources.join(state.select("key", "tilt"), "key", "left")


def copies(rates: pd.DataFrame, most: int) -> np.ndarray:
    """Copies of each class of one source (size, n, rate; falling sizes): whole numbers whose words follow the rates'."""
    out = np.zeros(len(rates), dtype=np.int64)
    carry = 0.0
    for k, (size, n, r) in enumerate(zip(rates["size"].tolist(), rates["n"].tolist(), rates["rate"].tolist())):
        wanted = carry + n * r * size
        out[k] = min(most * n, max(0, math.floor(wanted / size + 0.5)))
        carry = wanted - float(out[k]) * size
    return out


# --- the operator ------------------------------------------------------------


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row: the words of the text, of its source, the source's target, and what the mix takes.

    ``taken`` is ``size`` times the document's copies, 0 to ``most``. Null and
    empty texts have size 0 and are taken as such; a null source is one of
    its own, after all others. Rows of the same id, source and size are alike: each has
    its row in the result, and which of them has a copy more means nothing. An
    empty table gives no rows, one without words targets of 0.
    """
    spark = docs.sparkSession
    with scratch(spark) as keep:
        rows = keep(sizes(docs))
        classes = keep(rows.groupBy("key", "size").agg(F.sum("n").alias("n")))
        words = F.sum(F.col("size") * F.col("n"))
        sources = numbered(
            classes.groupBy("key").agg(
                words.alias("words"),
                F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("docs"),
                F.min(F.when(F.col("size") > 0, F.col("size"))).alias("shortest"),
            ),
            keep,
        )
        weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int"))
        sources = keep(with_targets(keep(sources.withColumn("weight", weight)), most))
        tilted = tilts(classes.filter("size > 0"), sources.filter("words > 0"), most, keep)
        rated = classes.filter("size > 0").join(tilted.select("key", "tilt"), "key").select("key", "size", "n", F.expr(f"round({rate(most)}, 9) AS rate"))

        def whole(frame: pd.DataFrame) -> pd.DataFrame:
            # a source of w words has at most sqrt(2 w) sizes
            frame = frame.sort_values("size", ascending=False)
            return frame[["key", "size"]].assign(copies=copies(frame, most))

        counts = rated.groupBy("key").applyInPandas(whole, "key string, size bigint, copies bigint")
        taken = keep(
            classes.join(counts, ["key", "size"], "left")
            .join(sources, "key")
            .select("key", "size", "n", F.coalesce("copies", F.lit(0)).alias("copies"), F.col("words").alias("source_size"), "target")
        )
        return kept(assigned(rows, taken))


def assigned(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """The copies of each class of ``taken`` (key, size, n, copies) given to its documents, as even as can be.

    Documents of a class are ordered by a hash of the id, of which the first
    bits are the slice; the first so many have one copy more than the others.
    """
    h = F.xxhash64("doc_id")
    rows = rows.select("key", "size", "doc_id", "n", h.alias("h"), F.shiftrightunsigned(h, 64 - SLICES.bit_length() + 1).alias("slice"))
    by_class = Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("key", "size", "slice").agg(F.sum("n").alias("in_slice"))
    slices = slices.withColumn("before", F.coalesce(F.sum("in_slice").over(by_class), F.lit(0))).drop("in_slice")
    slices = slices.join(taken.withColumnRenamed("n", "in_class"), ["key", "size"])
    within = Window.partitionBy("key", "size", "slice").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(slices, ["key", "size", "slice"]).withColumn("first", F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    each = F.expr("copies div in_class")
    more = F.least(F.greatest(F.col("copies") % F.col("in_class") - F.col("first"), F.lit(0)), F.col("n"))
    placed = placed.select("doc_id", "size", "source_size", "target", "n", each.alias("each"), more.alias("more"))
    pieces = placed.withColumn("piece", F.explode(F.expr(f"sequence(0L, (n - 1) div {PIECE})")))
    if (rows.agg(F.max("n")).first()[0] or 0) > PIECE:
        pieces = pieces.repartition(F.col("doc_id"), F.col("piece"))
    one = F.explode(F.expr(f"sequence(piece * {PIECE}, least(n, (piece + 1) * {PIECE}) - 1)"))
    return pieces.withColumn("place", one).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("each") + (F.col("place") < F.col("more")).cast("bigint"))).alias("taken"),
    )


travels(__name__)
