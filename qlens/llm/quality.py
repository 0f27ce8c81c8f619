"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Each document is a sparse vector: its words' frequencies, hashed and scaled to
unit length, and one indicator for the bin of each statistic. All pairs of
features interact through vectors of ``RANK`` numbers; half the square of the
sum minus the sum of squares gives the sum over all pairs in linear time.
Fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qlens.llm.common import give_back, id_remainder, lowest, per_worker, text_or_empty, travels, whole_row
from qlens.storage import scratch

# At most so many labelled documents are fitted on, the first in hash order, and of those as many as have this many
# bytes of text together; a text of more than a sixteenth of that is scored like any other, but not learned from.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 160 << 20
WORD_BUCKETS = 1 << 16
BINS = 16
RANK = 8
EPOCHS = 6
LEAST_STEPS = 300
BATCH = 128
RATE = 0.1
SHRINK = 1e-4
THRESHOLD = 0.7

STATISTICS = (
    "characters",
    "declared_length",
    "word_length",
    "upper",
    "symbols",
    "digits",
    "distinct_words",
    "top_word",
    "letterless_words",
    "distinct_lines",
    "line_length",
    "non_ascii",
)
N_FEATURES = WORD_BUCKETS + BINS * len(STATISTICS)


def statistics(text: str, data: bytes, words: list[str], counts: Counter, declared: float | None) -> list[int]:
    """The bin, 0 to ``BINS`` - 1, of each of ``STATISTICS``; ``declared`` is the metadata column n_chars."""
    kinds = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size, n = max(1, len(data)), max(1, len(words))
    upper, lower, digits = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    blanks, beyond = kinds[32] + kinds[9:14].sum(), kinds[128:].sum()
    lines = text.split("\n")
    letterless = sum(c for w, c in counts.items() if not any(map(str.isalpha, w)))

    def magnitude(x: float) -> int:
        return min(BINS - 1, int(x).bit_length())

    def share(x: float) -> int:
        return min(BINS - 1, int(np.sqrt(max(0.0, x)) * BINS))

    return [
        magnitude(len(text)),
        0 if declared is None or declared != declared or declared < 0 else magnitude(declared),
        min(BINS - 1, int(len(text) / n)),
        share(upper / size),
        share((size - upper - lower - digits - blanks - beyond) / size),
        share(digits / size),
        share(len(counts) / n),
        share(max(counts.values(), default=0) / n),
        share(letterless / n),
        share(len(set(lines)) / len(lines)),
        magnitude(len(text) / len(lines)),
        share(beyond / size),
    ]


def features(text: str | None, declared: float | None, hashed: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values of a document; ``hashed`` remembers words' buckets. A null text counts as empty."""
    text = text or ""
    data = text.encode()
    words = text.split()
    counts = Counter(words)
    ids = []
    for w in counts:
        k = hashed.get(w)
        if k is None:
            if len(hashed) > 100_000:
                hashed.clear()
            k = hashed[w] = crc32(w.encode()) % WORD_BUCKETS
        ids.append(k)
    values = np.fromiter(counts.values(), dtype=np.float32, count=len(counts))
    values /= max(1.0, float(np.sqrt((values * values).sum())))
    bins = [WORD_BUCKETS + BINS * k + b for k, b in enumerate(statistics(text, data, words, counts, declared))]
    return np.array(ids + bins, dtype=np.int32), np.concatenate((values, np.ones(len(bins), dtype=np.float32)))


# --- the model ---------------------------------------------------------------


def margins(model: dict, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds of each document, and what the gradient needs: value-scaled vectors and their sums."""
    scaled = model["v"][ids] * values[:, None]
    sums = np.add.reduceat(scaled, starts)
    pairs = 0.5 * ((sums * sums).sum(axis=1) - np.add.reduceat((scaled * scaled).sum(axis=1), starts))
    return model["w0"] + np.add.reduceat(model["w"][ids] * values, starts) + pairs, scaled, sums


def fit_model(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> dict:
    """AdaGrad on the logistic loss over shuffled mini-batches."""
    rng = np.random.default_rng(seed)
    share = min(0.99, max(0.01, float(labels.mean()))) if len(labels) else 0.5
    model = {
        "rows": len(rows),
        "w0": np.log(share / (1 - share)),
        "w": np.zeros(N_FEATURES, dtype=np.float32),
        "v": rng.normal(0, 0.01, (N_FEATURES, RANK)).astype(np.float32),
    }
    seen_w = np.full(N_FEATURES, 1e-2, dtype=np.float32)
    seen_v = np.full((N_FEATURES, RANK), 1e-2, dtype=np.float32)
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // max(len(rows), BATCH)))  # more of them where rows are few
    for _ in range(epochs if rows else 0):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            own = order[k : k + BATCH]
            ids = np.concatenate([rows[i][0] for i in own])
            values = np.concatenate([rows[i][1] for i in own])
            lengths = np.array([len(rows[i][0]) for i in own])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            odds, scaled, sums = margins(model, ids, values, starts)
            error = np.repeat(1 / (1 + np.exp(-odds)) - labels[own], lengths).astype(np.float32) / len(own)
            used, at = np.unique(ids, return_inverse=True)
            slope_w = np.bincount(at, weights=error * values, minlength=len(used)).astype(np.float32) + SHRINK * model["w"][used]
            each = (error * values)[:, None] * (np.repeat(sums, lengths, axis=0) - scaled)
            slope_v = SHRINK * model["v"][used]
            for f in range(RANK):
                slope_v[:, f] += np.bincount(at, weights=each[:, f], minlength=len(used))
            seen_w[used] += slope_w**2
            seen_v[used] += slope_v**2
            model["w"][used] -= RATE * slope_w / np.sqrt(seen_w[used])
            model["v"][used] -= RATE * slope_v / np.sqrt(seen_v[used])
    return model


def learned_from(docs: DataFrame, labels: DataFrame, learn: Column | None, sample_rows: int, sample_bytes: int, keep) -> DataFrame:
    """(doc_id, quality, h): at most ``sample_rows`` labels of documents that are there, with the hash of the text to learn from.

    Labels of other ids don't count towards the bound. Only ids, hashes and
    lengths are shuffled.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).filter(F.lit(True) if learn is None else learn)
    rows = inputs(docs).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.octet_length("text").cast("bigint").alias("n"))
    rows = rows.filter((F.col("n") <= sample_bytes // 16) & F.col("id").isNotNull())
    there = rows.groupBy("id").agg(F.min(F.struct("h", "n")).alias("first"))
    found = keep(known.join(there, F.col("id") == F.col("doc_id")).select("doc_id", "quality", "first.*", F.xxhash64("doc_id").alias("order")))
    few = found.filter(lowest(F.col("order"), 2 * sample_rows, found.count()))
    sample = few.orderBy("order", "doc_id", "quality").limit(sample_rows)
    total = F.sum("n").over(Window.orderBy("order", "doc_id", "quality"))  # over the bounded sample
    return sample.withColumn("total", total).filter(F.col("total") <= sample_bytes).select("doc_id", "quality", "h")


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> dict:
    """The model of a bounded sample of the labelled documents for which ``learn`` (over the labels' doc_id) holds.

    Of rows that share an id one is learned from, the first by a hash of its text.
    Rows without a label or an id are left out; without any row the model
    gives every document the same even score, and its ``rows`` is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed: dict[str, int] = {}
        for batch in batches:
            found = [features(t, n, hashed) for t, n in zip(batch.column("text").to_pylist(), batch.column("declared").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("quality"),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.list_(pa.float32())),
                ],
                ["doc_id", "quality", "ids", "vals"],
            )

    schema = "doc_id bigint, quality double, ids array<int>, vals array<float>"
    own = inputs(docs).select(F.col("doc_id").alias("id"), "text", "declared", F.xxhash64("text").alias("own"))
    with scratch(docs.sparkSession) as keep:
        sample = keep(learned_from(docs, labels, learn, sample_rows, sample_bytes, keep))
        chosen = sample.select(F.col("doc_id").alias("id"), F.col("h").alias("own")).distinct()
        found = own.join(F.broadcast(chosen), ["id", "own"], "left_semi")
        texts = found.groupBy("id").agg(F.min(F.struct("text", "declared")).alias("first"))
        rows = texts.join(F.broadcast(sample), F.col("id") == F.col("doc_id")).select("doc_id", "quality", "first.text", "first.declared")
        taken = rows.mapInArrow(run, schema).toArrow().sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    found = [
        (np.asarray(i.values.to_numpy(zero_copy_only=False)), np.asarray(v.values.to_numpy(zero_copy_only=False)))
        for i, v in zip(taken.column("ids"), taken.column("vals"))
    ]
    return fit_model(found, (taken.column("quality").to_numpy() > 0).astype(np.float32))


def inputs(docs: DataFrame) -> DataFrame:
    """What a score may use: the text and, as metadata, the declared length where the table has one."""
    declared = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), declared.alias("declared"))


def scorer(spark, model: dict):
    """A column function: (text, declared length) to the score, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashed = per_worker(key, dict)
        for texts, declared in batches:
            out = np.empty(len(texts))
            for k in range(0, len(texts), 256):
                found = [features(t, n, hashed) for t, n in zip(texts.iloc[k : k + 256], declared.iloc[k : k + 256])]
                starts = np.concatenate(([0], np.cumsum([len(f[0]) for f in found])[:-1]))
                odds, _, _ = margins(shared.value, np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), starts)
                out[k : k + 256] = 1 / (1 + np.exp(-odds.astype(np.float64)))
            yield pd.Series(out, index=texts.index)
            give_back()

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Learned from labels whose id's crc32 modulo 4 is not 2; the others are
    held out. Null and empty texts are scored like any other; repeated rows
    give repeated results.
    """
    score = scorer(docs.sparkSession, fit(docs, labels, id_remainder(4) != 2))
    scored = inputs(docs).select("doc_id", (id_remainder(4) == 2).alias("held_out"), score("text", "declared").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with all columns, without the rows that score below ``THRESHOLD``.

    Learned from all labels of ``docs``. Without one nothing is known against
    any row, so all stay. Null and empty texts are scored like
    any other; repeated rows stay or go together; an empty table stays empty.
    """
    model = fit(docs, labels)
    if not model["rows"]:
        return docs
    score = scorer(docs.sparkSession, model)
    declared = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    rows = docs.select(whole_row(docs), score(text_or_empty(), declared).alias("s"))
    return rows.filter(F.col("s") >= THRESHOLD).select("row.*")


travels(__name__)
