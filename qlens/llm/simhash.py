"""SimHash near-duplicates through vantage-point trees.

Distinct fingerprints are dealt out by a vantage-point tree: a node keeps the
fingerprints nearer to its vantage point than a radius on one side, the others
on the other. Two fingerprints at most ``max_bits`` apart have a fingerprint
half-way between them, at most ``reach`` = ceil(max_bits / 2) from both. So a
fingerprint goes to every shard that the triangle inequality can't rule out
for the ball of that radius around it, and both meet in the half-way point's
shard. Inside a shard the same rule prunes until few are left, which are
compared outright. A shard returns a forest of its links; components are
found by large-star and small-star rounds over those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from qlens.llm.common import give_back, lowest, text_or_empty, travels, whole_row
from qlens.storage import kept, scratch

SHINGLE = 3
MAX_BITS = 2
SEED = 42

# The tree is fitted on a bounded sample of fingerprints and so has a bounded number of shards.
SHARD_ROWS = 8_192
SAMPLE_PER_SHARD = 16
MAX_SHARDS = 1 << 17
# A shard with more rows than this is worked off in pairs of blocks, each in a task of its own.
BLOCK_ROWS = 100_000
# Fewer fingerprints than this are compared outright.
OUTRIGHT = 1_024


# --- fingerprints ------------------------------------------------------------


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles; zero without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: exactly A-Z and ASCII white space
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    hashes = np.fromiter(
        (xxh64_intdigest(joined[i:j], SEED) for i, j in zip(starts[:n].tolist(), ends[last:].tolist())), dtype="<u8", count=n
    )
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, beside: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id and ``bits``, the fingerprint as a signed long; a null text counts as empty. ``beside`` are further longs to carry along."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *beside, text_or_empty().alias("text"))
    names = [*rows.columns[:-1], "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([simhash(t, shingle) for t in batch.column("text").to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bits.view("<i8"))], names)
            give_back()

    return rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


# --- vantage-point tree ------------------------------------------------------


def distances(prints: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ point).astype(np.int16)


def sides(prints: np.ndarray, point: np.uint64, radius: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Which prints have a ball of ``reach`` that may hold something within ``radius`` of ``point``, or something beyond."""
    d = distances(prints, point)
    return d - reach <= radius, d + reach > radius


def choose(prints: np.ndarray, reach: int, tries: int = 8) -> tuple[np.uint64, int, int]:
    """Vantage point and radius under which the fuller side is smallest, and how many that side has."""
    best = None
    for point in prints[np.linspace(0, len(prints) - 1, min(tries, len(prints))).astype(int)]:
        below = np.cumsum(np.bincount(distances(prints, point), minlength=65))
        radii = np.arange(64)
        near = below[np.minimum(radii + reach, 64)]
        far = len(prints) - np.where(radii >= reach, below[np.maximum(radii - reach, 0)], 0)
        fuller = np.maximum(near, far)
        r = int(np.argmin(fuller))
        if best is None or fuller[r] < best[2]:
            best = (point, r, int(fuller[r]))
    return best


def grow(sample: np.ndarray, shards: int, reach: int) -> dict[str, np.ndarray]:
    """A tree of about ``shards`` leaves: vantage point and radius of each node, its children, and -1-shard for a leaf.

    The node with the most sampled prints is split next, unless no split helps it.
    """
    import heapq

    points, radii, near, far = [], [], [], []
    root: list = [None]
    heap = [(-len(sample), 0, sample, root, 0)]
    leaves, n, order = [], 1, 0
    while heap:
        size, _, own, parent, side = heapq.heappop(heap)
        best = choose(own, reach) if n < shards and -size > 1 else None
        if best is None or best[2] > 0.95 * -size:
            leaves.append((parent, side))
            continue
        point, radius, _ = best
        node = [None, None]
        k = len(points)
        points.append(point)
        radii.append(radius)
        near.append(node)
        far.append(node)
        parent[side] = k
        for s, part in enumerate(sides(own, point, radius, reach)):
            order += 1
            heapq.heappush(heap, (-int(part.sum()), order, own[part], node, s))
        n += 1
    for shard, (parent, side) in enumerate(leaves):
        parent[side] = -1 - shard
    return {
        "points": np.array(points, dtype=np.uint64),
        "radii": np.array(radii, dtype=np.int16),
        "children": np.array([[x[0], x[1]] for x in near], dtype=np.int64).reshape(-1, 2),
        "root": root[0],
    }


def shards_of(tree: dict, prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of every shard that a print's ball may touch."""
    rows, shards = [], []
    stack = [(tree["root"], np.arange(len(prints)))]
    while stack:
        node, own = stack.pop()
        if not len(own):
            continue
        if node < 0:
            rows.append(own)
            shards.append(np.full(len(own), -1 - node, dtype=np.int32))
            continue
        for child, part in zip(tree["children"][node], sides(prints[own], tree["points"][node], tree["radii"][node], reach)):
            stack.append((int(child), own[part]))
    if not rows:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)
    return np.concatenate(rows), np.concatenate(shards)


# --- links within a shard ----------------------------------------------------


def unite(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a[i] and b[i]; ``roots`` gives each element's smallest member and stays flat."""
    while True:
        x, y = roots[a], roots[b]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(roots, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(up := roots[roots], roots):
            roots[:] = up


def link(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """For each print the index of a representative; equal if and only if a chain of links within the shard joins them."""
    reach = math.ceil(max_bits / 2)
    roots = np.arange(len(prints))
    stack = [np.arange(len(prints))]
    while stack:
        own = stack.pop()
        best = choose(prints[own], reach) if len(own) > OUTRIGHT else None
        if best is not None and best[2] <= 0.9 * len(own):
            stack.extend(own[part] for part in sides(prints[own], best[0], best[1], reach))
            continue
        for k in range(0, len(own), 256):
            some, later = own[k : k + 256], own[k:]
            a, b = np.nonzero(np.bitwise_count(prints[some][:, None] ^ prints[later][None, :]) <= max_bits)
            unite(roots, some[a], later[b])
    return roots


def links(distinct: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS, max_shards: int = MAX_SHARDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b), a != b, between the ``bits`` of ``distinct`` that make the same components as all pairs at most ``max_bits`` apart."""
    spark = distinct.sparkSession
    reach = math.ceil(max_bits / 2)
    rows = distinct.count()
    shards = min(max_shards, math.ceil(rows / shard_rows) * 4)
    wanted, order = shards * SAMPLE_PER_SHARD, F.xxhash64("bits")
    few = distinct.select("bits").filter(lowest(order, 2 * wanted, rows))
    sample = few.orderBy(order).limit(wanted).toArrow().column("bits").to_numpy()
    tree = spark.sparkContext.broadcast(grow(sample.view(np.uint64), shards, reach))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy()
            at, shard = shards_of(tree.value, bits.view(np.uint64), reach)
            yield pa.RecordBatch.from_arrays([pa.array(bits[at]), pa.array(shard)], ["bits", "shard"])

    dealt = distinct.select("bits").mapInArrow(deal, "bits bigint, shard int")
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    large = F.broadcast(sizes.filter("blocks > 1"))  # at most max_shards rows
    block = F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int")
    others = F.expr("transform(sequence(0, blocks - 1), j -> named_struct('i', least(j, block), 'j', greatest(j, block)))")
    cells = (
        dealt.join(large, "shard", "left")
        .withColumn("block", block)
        .withColumn("cell", F.explode(F.coalesce(others, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))))
    )

    def near(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.sort(frame["bits"].to_numpy())
        roots = link(bits.view(np.uint64), max_bits)
        linked = np.flatnonzero(roots != np.arange(len(bits)))
        return pd.DataFrame({"a": bits[linked], "b": bits[roots[linked]]})

    return cells.select("shard", "cell", "bits").groupBy("shard", "cell").applyInPandas(near, "a bigint, b bigint").distinct()


# --- components --------------------------------------------------------------


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node of its component.

    Large-star hangs each node's larger neighbours on its smallest one,
    small-star the smaller ones; both aggregate before they shuffle, and a
    hub's edges are a skewed join that adaptive execution splits. A round is
    written to the shared folder; only the last one's result stays. Stops when a round changes nothing.
    """
    with scratch(edges.sparkSession) as keep:
        now = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
        state = None
        for _ in range(max_rounds):
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            large = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            least = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            now = keep(small.select("e.a", "e.b").filter("a <> b").distinct())
            seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if seen == state:
                return kept(now.select(F.col("a").alias("node"), F.col("b").alias("root")))
            state = seen
    raise RuntimeError("components did not settle")


# --- the operator ------------------------------------------------------------


def rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` with the ``root`` of each of its ``bits``, equal within a group of near-duplicates."""
    roots = components(links(distinct, max_bits))
    return distinct.join(roots, distinct["bits"] == roots["node"], "left").select(*distinct.columns, F.coalesce("root", "bits").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id linked, by whatever chain) of every row.

    Null and empty texts have fingerprint zero and are linked like any other;
    repeated rows stay, each with the same result; null ids never become a
    component_id unless no linked row has an id.
    """
    prints = kept(fingerprints(docs, shingle))
    groups = rooted(kept(prints.groupBy("bits").agg(F.min("doc_id").alias("first"))), max_bits)
    lowest = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    found = groups.join(lowest, "root").select("bits", "component_id")
    return prints.join(found, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def ordered(kind: DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, StructType):
        return all(ordered(f.dataType) for f in kind.fields)
    return ordered(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with all columns, one row for each group of near-duplicates: the one with the smallest doc_id.

    A row without an id stays only if its whole group has none. Rows of a group
    that share the id, or have none, are ordered by a hash of their texts, those
    of the same text by their columns, and the first stays.
    """
    # 128 bits, for among rows without an id nothing else tells texts apart
    hashes = (F.xxhash64(text_or_empty()).alias("h"), F.xxhash64(F.lit(SEED), text_or_empty()).alias("h2"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "h2")).alias("first")
    groups = rooted(kept(fingerprints(docs, shingle, hashes).groupBy("bits").agg(first)), max_bits)
    # as text a null id has a key of its own
    key = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("")).alias("key")
    stays = groups.groupBy("root").agg(F.min("first").alias("first")).select("first.*").select(key, "h", "h2")
    # rows of the same id and text are one before the shuffle, and its partitions serve the join
    # columns that have no order, such as maps, are ordered as JSON
    lowest_row = F.min("row") if ordered(docs.schema) else F.min_by("row", F.to_json("row"))
    rows = docs.select(whole_row(docs), key, *hashes).groupBy("key", "h", "h2").agg(lowest_row.alias("row"))
    return rows.join(stays, ["key", "h", "h2"], "left_semi").select("row.*")


travels(__name__)
