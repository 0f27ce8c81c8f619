"""Hard-negative mining by integer matrix products.

Anchors are a query set against all rows. They go out in blocks of bounded
size; a task multiplies its rows with a block, tile by tile, by Strassen's
recursion on int64: tiles are padded with zeros to a multiple of a power of
two, seven products of half the size replace eight, and the additions are
exact, for integers that wrap around still give the right sum once the result
itself fits. Scores never leave the task. It keeps a heap of the best positives
of each anchor, and in a second pass a heap of the best negatives of each
positive's window; heaps of different tasks merge by rank.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qlens.llm.common import travels
from qlens.storage import checkpoint_dir, join_path, scratch

POSITIVES, NEGATIVES = 5, 3
# A negative's score is at least and at most so many hundredths of the positive's.
LOW, HIGH = 50, 95
# Bytes of vectors in an anchor block; it is broadcast, and each task holds its heaps beside it.
BLOCK_BYTES = 16 << 20
TILE = 512
# Products whose smallest side is no longer than this are multiplied outright.
LEAF = 32


# --- products ----------------------------------------------------------------


def strassen(a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """a @ b by ``depth`` levels of seven half-size products; every side is a multiple of 2**depth."""
    if not depth:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, depth - 1)
    p2 = strassen(a21 + a22, b11, depth - 1)
    p3 = strassen(a11, b12 - b22, depth - 1)
    p4 = strassen(a22, b21 - b11, depth - 1)
    p5 = strassen(a11 + a12, b22, depth - 1)
    p6 = strassen(a21 - a11, b11 + b12, depth - 1)
    p7 = strassen(a12 - a22, b21 + b22, depth - 1)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    np.add(p3, p5, out=out[:m, n:])
    np.add(p2, p4, out=out[m:, :n])
    p7 += p1
    p7 += p4
    np.subtract(p7, p5, out=out[:m, :n])
    p6 += p1
    p6 += p3
    np.subtract(p6, p2, out=out[m:, n:])
    return out


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b.T of int64 tiles, padded with zeros for the recursion; exact where the results fit 64 bits."""
    m, k, n = a.shape[0], a.shape[1], b.shape[0]
    depth = 0
    while min(m, k, n) >> depth > leaf:
        depth += 1
    unit = (1 << depth) - 1
    a = np.pad(a, ((0, -m & unit), (0, -k & unit)))
    b = np.pad(b, ((0, -n & unit), (0, -k & unit)))
    return strassen(a, b.T, depth)[:m, :n]


# --- heaps -------------------------------------------------------------------


class Heaps:
    """For each group the first ``keep`` distinct (score, id), higher scores and then smaller ids first."""

    def __init__(self, floors: np.ndarray, keep: int):
        self.keep = keep
        self.least = floors.copy()  # what a score must reach to get in
        self.scores = np.zeros((len(floors), keep), dtype=np.int64)
        self.ids = np.zeros((len(floors), keep), dtype=np.int64)
        self.filled = np.zeros(len(floors), dtype=np.int64)

    def offer(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        full = self.filled[groups] == self.keep
        better = (scores > self.least[groups]) | ((scores == self.least[groups]) & (~full | (ids < self.ids[groups, -1])))
        groups, scores, ids = groups[better], scores[better], ids[better]
        if not len(groups):
            return
        touched = np.unique(groups)
        own = np.arange(self.keep)[None, :] < self.filled[touched][:, None]
        groups = np.concatenate((np.repeat(touched, self.filled[touched]), groups))
        scores = np.concatenate((self.scores[touched][own], scores))
        ids = np.concatenate((self.ids[touched][own], ids))
        order = np.lexsort((ids, ~scores, groups))
        groups, scores, ids = groups[order], scores[order], ids[order]
        new = np.ones(len(groups), dtype=bool)
        new[1:] = (groups[1:] != groups[:-1]) | (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
        groups, scores, ids = groups[new], scores[new], ids[new]
        starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        rank = np.arange(len(groups)) - np.repeat(starts, np.diff([*starts, len(groups)]))
        first = rank < self.keep
        self.scores[groups[first], rank[first]] = scores[first]
        self.ids[groups[first], rank[first]] = ids[first]
        self.filled[touched] = np.minimum(np.diff([*starts, len(groups)]), self.keep)
        full = touched[self.filled[touched] == self.keep]
        self.least[full] = self.scores[full, -1]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, score, id) of all that is kept."""
        groups = np.repeat(np.arange(len(self.filled)), self.filled)
        own = np.arange(self.keep)[None, :] < self.filled[:, None]
        return groups, self.scores[own], self.ids[own]


# --- on Spark ----------------------------------------------------------------


def matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones padded with zeros, which alters no product."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def tiles(batches: Iterator[pa.RecordBatch], block: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first anchor, scores, same label, same id, ids) of every anchor tile and row tile."""
    vectors, labels, ids = block["vectors"], block["labels"], block["ids"]
    for whole in batches:
        for at in range(0, whole.num_rows, TILE):
            batch = whole.slice(at, TILE)
            own = matrix(batch.column("vector"), vectors.shape[1])
            own_labels, own_ids = batch.column("label").to_numpy(), batch.column("vec_id").to_numpy()
            for k in range(0, len(vectors), TILE):
                scores = product(vectors[k : k + TILE], own)
                same = labels[k : k + TILE, None] == own_labels[None, :]
                yield k, scores, same, ids[k : k + TILE, None] == own_ids[None, :], own_ids


def best_positives(rows: DataFrame, block: dict, keep: int) -> DataFrame:
    """(anchor, score, id): the first rows of each anchor's label, of all tasks' heaps."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        heaps = Heaps(np.full(len(anchors["ids"]), np.iinfo(np.int64).min), keep)
        for k, scores, same, itself, ids in tiles(batches, anchors):
            a, c = np.nonzero(same & ~itself & (scores >= heaps.least[k : k + TILE, None]))
            heaps.offer(k + a, scores[a, c], ids[c])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in heaps.entries()], ["anchor", "score", "id"])

    found = rows.mapInArrow(run, "anchor bigint, score bigint, id bigint")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.dense_rank().over(order)).filter(F.col("place") <= keep).distinct()


def best_negatives(rows: DataFrame, block: dict, keep: int) -> DataFrame:
    """(pair, place, score, id): the first rows of other labels in each pair's window, of all tasks' heaps.

    ``block`` also has the pairs: ``anchor`` (ascending, an index into the block), ``low`` and ``high``.
    """
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        heaps = Heaps(anchors["low"], keep)
        high = anchors["high"]
        starts = np.searchsorted(anchors["anchor"], np.arange(len(anchors["ids"]) + 1))
        most = int(np.diff(starts).max(initial=0))
        for k, scores, same, itself, ids in tiles(batches, anchors):
            begin, end = starts[k : k + len(scores)], starts[k + 1 : k + 1 + len(scores)]
            for j in range(most):
                pair = np.minimum(begin + j, len(high) - 1)
                least = np.where(begin + j < end, heaps.least[pair], np.iinfo(np.int64).max)
                a, c = np.nonzero((scores >= least[:, None]) & (scores <= high[pair][:, None]) & ~same & ~itself)
                heaps.offer(pair[a], scores[a, c], ids[c])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in heaps.entries()], ["pair", "score", "id"])

    found = rows.mapInArrow(run, "pair bigint, score bigint, id bigint")
    order = Window.partitionBy("pair").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.dense_rank().over(order)).filter(F.col("place") <= keep).distinct()


SCHEMA = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label (longs) and vector (array of longs); ``anchors``
    says which rows are anchors. Scores are inner products, higher first, ties
    by smaller id. An anchor's positives are the first ``positives`` other rows
    of its label; a positive's negatives the first ``negatives`` rows of other
    labels whose score is ``low`` to ``high`` hundredths of its own. Rows with
    a null id, label or vector take no part, nor do null components. Shorter vectors count as padded with
    zeros. Rows alike in id and score count once, and so do repeated anchors;
    rows with an anchor's id are not its others. An empty table and anchors
    without positives give no rows. Raises ValueError where a product could
    leave 63 bits.
    """
    spark = rows.sparkSession
    rows = rows.select(*[F.col(c).cast("bigint").alias(c) for c in ("vec_id", "label")], F.col("vector").cast("array<bigint>").alias("vector"))
    whole = F.forall("vector", lambda c: c.isNotNull())
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    result = join_path(checkpoint_dir(spark), f"kept-{uuid.uuid4().hex}")
    spark.createDataFrame([], SCHEMA).write.parquet(result)
    with scratch(spark) as keep:
        found = keep(rows.filter(anchors).distinct().withColumn("no", F.monotonically_increasing_id()))
        n = found.count()
        largest = F.max(F.greatest(F.array_max("vector"), -F.array_min("vector")))
        width, top = rows.agg(F.max(F.size("vector")), largest).first()
        if 100 * (width or 0) * (top or 0) ** 2 >= 1 << 63:
            raise ValueError("vectors are too large for exact products in 64 bits")
        blocks = -(-n * 8 * max(1, width or 0) // block_bytes)
        for b in range(blocks):
            own = found.filter(F.pmod(F.xxhash64("no"), F.lit(blocks)) == b).toArrow()  # about block_bytes
            block = {
                "ids": own.column("vec_id").to_numpy(),
                "labels": own.column("label").to_numpy(),
                "vectors": matrix(own.column("vector").combine_chunks(), width),
            }
            pairs = best_positives(rows, block, positives).toArrow().sort_by([("anchor", "ascending"), ("place", "ascending")])
            at, ids, scores = (pairs.column(c).to_numpy() for c in ("anchor", "id", "score"))
            block |= {"anchor": at, "low": -(-low * scores // 100), "high": high * scores // 100}
            if len(pairs):
                write_pairs(best_negatives(rows, block, negatives), block["ids"][at], ids, scores, result)
    return spark.read.schema(SCHEMA).parquet(result)


def write_pairs(found: DataFrame, anchor_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, path: str) -> None:
    """Appends ``found`` with what its pair numbers stand for."""
    shared = found.sparkSession.sparkContext.broadcast((anchor_ids, ids, scores))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_ids, ids, scores = shared.value
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor_ids[pair]),
                    pa.array(ids[pair]),
                    batch.column("place").cast(pa.int32()),
                    batch.column("id"),
                    pa.array(scores[pair]),
                    batch.column("score"),
                ],
                [f.split()[0] for f in SCHEMA.split(", ")],
            )

    found.select("pair", "place", "id", "score").mapInArrow(name, SCHEMA).write.mode("append").parquet(path)


# --- the query's table -------------------------------------------------------


def finite(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector for ``mine``: components times 256, rounded down; the label of every seventh id moved on by one.

    Rows with a null label, a null vector, or a null or non-finite component are left out.
    """
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vector = F.transform("embedding", lambda c: F.floor(c.cast("double") * 256))
    kept_rows = embeddings.filter(F.col("label").isNotNull() & finite("embedding"))
    return kept_rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), moved.alias("label"), vector.alias("vector"))


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every row whose id is divisible by 50."""
    return mine(quantised(embeddings), F.col("vec_id") % 50 == 0)


travels(__name__)
