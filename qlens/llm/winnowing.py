"""Document fingerprints by winnowing.

Every run of ``k`` code points has a rolling hash; of each ``window`` hashes in
a row the smallest is chosen, the rightmost of equals, and kept with its place.
Two texts that share ``k + window - 1`` code points in a row share a choice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qlens.llm.common import lowest, per_worker, text_or_empty, travels
from qlens.storage import shuffle_partitions

K = 16
WINDOW = 48
# Hashes keep 40 bits, so that a place within a segment fits beside one in 64.
PLACE_BITS = 24
SEGMENT = 1 << 22
# Ranges of ids and hashes that one task sorts, and their cuts' bounded sample.
RANGE_ROWS = 2_000
MAX_RANGES = 1 << 18
SAMPLE_PER_RANGE = 8
PLACE = [("has", "i1"), ("id", "i8"), ("h", "i8")]
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
BASE = 0x9E3779B97F4A7C15 | 1
MIX = 0xD6E8FEB86659FD93


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers 0, 1, ... (at least ``n`` of them) modulo 2**64, and their inverses."""
    size = 1 << max(12, (n - 1).bit_length())
    tables = per_worker("winnowing powers", dict)
    if size not in tables:
        ups, downs = np.full(size, BASE, dtype=np.uint64), np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        ups[0] = downs[0] = 1
        tables[size] = (np.cumprod(ups), np.cumprod(downs))
    return tables[size]


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Rolling polynomial hash of every k code points, mixed; of the whole text if it is shorter."""
    n = len(codes)
    up, down = powers(n + 1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((codes + np.uint64(1)) * up[:n], dtype=np.uint64)))
    k = min(k, n)
    hashes = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(MIX)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of 40 bits, places) of the chosen k-grams in text order; none for an empty text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    found_hashes, found_places = [], []
    step = SEGMENT - window - k + 2
    for at in range(0, max(1, len(codes) - k - window + 2), step):
        own = codes[at : at + SEGMENT]
        if not len(own):
            break
        hashes = gram_hashes(own, k) >> np.uint64(PLACE_BITS)
        n = len(hashes)
        # the smallest key is the smallest hash, and of equals the rightmost
        keys = hashes << np.uint64(PLACE_BITS) | (np.uint64((1 << PLACE_BITS) - 1) - np.arange(n, dtype=np.uint64))
        width, reach = min(window, n), 1
        while reach < width:
            step_by = min(reach, width - reach)
            keys = np.minimum(keys[:-step_by], keys[step_by:])
            reach += step_by
        chosen = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
        found_hashes.append(chosen >> np.uint64(PLACE_BITS))
        found_places.append(at + (1 << PLACE_BITS) - 1 - (chosen & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64))
    if not found_hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    places, first = np.unique(np.concatenate(found_places), return_index=True)
    return np.concatenate(found_hashes)[first], places


def as_text(print_: tuple[np.ndarray, np.ndarray]) -> str:
    """The fingerprint as text: place:hash pairs, in hexadecimal, with blanks between."""
    return " ".join([f"{p:x}:{h:x}" for h, p in zip(print_[0].tolist(), print_[1].tolist())])


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Shared part of the distinct hashes of two fingerprints, wherever they stand; two empty ones are alike."""
    x, y = np.unique(a[0]), np.unique(b[0])
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


# --- on Spark ----------------------------------------------------------------


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes, places of every row; null texts count as empty and choose nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(t, k, window) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0].astype(np.int64) for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "hashes", "places"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, hashes array<bigint>, places array<bigint>"
    )


def places_of(batch: pa.RecordBatch) -> np.ndarray:
    """Where rows stand in ascending order: rows without an id first, then by id, then by the hash of the text."""
    out = np.empty(batch.num_rows, dtype=PLACE)
    for name, _ in PLACE:
        out[name] = batch.column(name).to_numpy(zero_copy_only=False)
    return out


def in_id_order(docs: DataFrame, range_rows: int = RANGE_ROWS, max_ranges: int = MAX_RANGES) -> DataFrame:
    """(bucket, extra, has, id, h, text) sorted within partitions, a bucket whole in one partition, so that each row stands before its next.

    Next means descending doc_id, and the first row after the last. Buckets
    are ranges of (id, hash of the text), cut at a bounded sample, so that the
    rows of one id, or of none, are dealt out over several; the first row of a bucket
    also goes to the bucket above it, marked ``extra``, and the very first to
    the last bucket. That takes one shuffle of the texts. Null ids come last;
    rows of the same id follow one another in the order of hashes of their texts.
    """
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(doc_id.isNotNull().alias("has"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.xxhash64(text_or_empty()).alias("h"), text_or_empty().alias("text"))
    keys = rows.select("has", "id", "h")
    n = keys.count()
    ranges = min(max_ranges, -(-n // range_rows))
    order = F.xxhash64("has", "id", "h")
    sample = keys.filter(lowest(order, ranges * SAMPLE_PER_RANGE, n)).orderBy(order, "has", "id", "h")
    taken = sample.limit(2 * ranges * SAMPLE_PER_RANGE).toArrow().combine_chunks().to_batches()
    drawn = np.sort(places_of(taken[0])) if taken else np.empty(0, dtype=PLACE)
    cuts = np.unique(drawn[[len(drawn) * k // ranges for k in range(1, ranges)]]) if len(drawn) else drawn

    def bucket_of(own: np.ndarray) -> np.ndarray:
        return len(cuts) - np.searchsorted(cuts, own, side="right")  # bucket 0 holds the largest ids

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(places_of(batch))), *batch.columns], ["bucket", "has", "id", "h"])

    top_of = keys.mapInArrow(number, "bucket bigint, has boolean, id bigint, h bigint").groupBy("bucket").agg(F.max(F.struct("has", "id", "h")).alias("top"))
    tops = top_of.select("bucket", "top.*").orderBy("bucket").toArrow().combine_chunks().to_batches()  # at most max_ranges rows
    filled, top = (tops[0].column("bucket").to_numpy(), places_of(tops[0])) if tops else (np.empty(0, dtype=np.int64), drawn)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "extra", "has", "id", "h", "text"]
        for batch in batches:
            own = places_of(batch)
            bucket = bucket_of(own)
            at = np.searchsorted(filled, bucket)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.zeros(len(own), bool)), *batch.columns], names)
            first = np.flatnonzero(top[at] == own)
            if len(first):  # of rows alike, one will do
                first = first[np.unique(bucket[first], return_index=True)[1]]
                to = filled[at[first] - 1]  # the bucket above; before the first stands the last
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.ones(len(first), bool)), *[c.take(pa.array(first)) for c in batch.columns]], names)

    dealt = rows.mapInArrow(deal, "bucket bigint, extra boolean, has boolean, id bigint, h bigint, text string")
    return dealt.repartition(max(shuffle_partitions(spark), ranges // 4), "bucket").sortWithinPartitions(
        "bucket", "extra", F.col("has").desc(), F.col("id").desc(), F.col("h").desc(), "text"
    )


def compare_with_next(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    The edited text has its last half replaced by the start of the next
    document, in descending doc_id. Null texts count as empty: their
    fingerprint is empty and alike only to another empty one. Repeated rows
    stay; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        def result(here: tuple, after: tuple) -> tuple:
            _, _, has, doc_id, _, text, own = here
            half = len(text) // 2
            edited = text[: len(text) - half] + after[5][:half]
            other = winnow(edited, k, window)
            digest = sha256(edited.encode()).hexdigest()
            return (
                doc_id if has else None, len(text), digest, as_text(own), as_text(other), likeness(own, other), likeness(own, after[6]),
            )

        here = None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                out = []
                for row in zip(*[c.to_pylist() for c in whole.slice(at, 1000).columns]):
                    after = (*row, winnow(row[5], k, window))
                    if here is not None and here[0] == after[0] and not here[1]:
                        out.append(result(here, after))
                    here = after
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], NAMES)

    return in_id_order(docs).mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


travels(__name__)
