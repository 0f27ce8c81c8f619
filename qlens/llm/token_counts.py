"""Token counts through a digest cache.

The cache holds a count for each (digest of normalised content, digest of the
tokenizer's version). Contents that it lacks are encoded once each, whatever
number of documents holds them, and appended.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qlens.llm.common import per_worker, text_or_empty, travels
from qlens.storage import kept, scratch, shuffle_partitions

CACHE = "content binary, n_tokens bigint, tokenizer string"
# Bits of the filter that leaves known texts out of the shuffle: 4 MB.
FILTER_BITS = 25


def library(path: str) -> str:
    return "sentencepiece" if path.endswith(".model") else "tokenizers"


def tokenizer_digest(path: str) -> str:
    """Digest of the vocabulary file and of the library version that reads it."""
    version = f"{library(path)} {importlib.metadata.version(library(path))}\n"
    return hashlib.sha256(version.encode() + Path(path).read_bytes()).hexdigest()


class Counter:
    """Counts a list of texts; the library's defaults, without added begin, end or special tokens."""

    def __init__(self, path: str):
        if library(path) == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.count = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def cached(spark, cache_path: str, version: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer version; each content once, even if two runs appended it."""
    rows = spark.read.schema(CACHE).parquet(cache_path).filter(F.col("tokenizer") == version)
    return rows.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def place(content: str = "content") -> Column:
    """The first ``FILTER_BITS`` bits of a digest."""
    return F.conv(F.substring(F.hex(content), 1, 8), 16, 10).cast("bigint").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` whose content may be one of ``wanted``: all that are, and those of the others that share a bit with one.

    The filter is a bitmap of at most 2**FILTER_BITS bits, sent to all
    executors in strips of 4 KB, so its size doesn't grow with either side.
    """
    bit = place()
    strips = wanted.select(F.bitmap_bucket_number(bit).alias("strip"), F.bitmap_bit_position(bit).alias("bit"))
    strips = strips.groupBy("strip").agg(F.bitmap_construct_agg("bit").alias("bits"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1
    found = rows.withColumn("strip", F.bitmap_bucket_number(bit)).join(F.broadcast(strips), "strip")
    return found.filter(hit).select(*rows.columns)


def fill_cache(contents: DataFrame, tokenizer_path: str, cache_path: str, digests: DataFrame | None = None) -> None:
    """Appends the counts of those ``contents`` (content, text) that the cache lacks for this tokenizer version.

    Which digests are missing is found out without the texts (from ``digests``,
    if they are at hand). A filter of bounded size then keeps known texts from
    being shuffled, and of the others copies are reduced to one first, so that a text which a third
    of all rows share is one row of each task.
    """
    spark = contents.sparkSession
    version = tokenizer_digest(tokenizer_path)
    # an empty append makes the folder, so that a new cache reads as an empty one
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    known = cached(spark, cache_path, version).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(("token counter", tokenizer_path, version), lambda: Counter(tokenizer_path))
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                counts = counter.count(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    with scratch(spark) as keep:
        digests = contents if digests is None else digests
        missing = keep(digests.select("content").distinct().join(known, "content", "left_anti"))
        if missing.isEmpty():
            return
        wanted = among(contents.select("content", "text"), missing).groupBy("content").agg(F.first("text").alias("text"))
        # what the filter let through by chance
        wanted = wanted.join(known, "content", "left_anti")
        counted = wanted.select("content", "text").mapInArrow(run, "content binary, n_tokens bigint")
        counted.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache_path)


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, normalise=lambda text: text, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; null texts count as empty, with no tokens.

    ``normalise`` is a column function on the text before it is digested and
    counted; by default the text stays as it is, so that counts are exactly
    the library's. Repeated rows stay; an empty table appends nothing. Counts
    are joined on (digest, slice of the ids), so that rows of one content are
    dealt out over as many tasks as a shuffle has.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("raw"))
    rows = rows.withColumn("text", normalise(F.col("raw"))).withColumn("content", content_digest(F.col("text")))
    slice_ = F.pmod(F.xxhash64("doc_id"), F.lit(shuffle_partitions(spark))).cast("int").alias("slice")
    # digested once for all that needs only digests
    narrow = kept(rows.select("doc_id", F.octet_length("raw").cast("bigint").alias("n_bytes"), "content", slice_))
    fill_cache(rows.select("content", "text"), tokenizer_path, cache_path, narrow)
    counts = cached(spark, cache_path, tokenizer_digest(tokenizer_path))
    sliced = narrow.select("content", "slice").distinct().join(counts, "content")
    return narrow.join(sliced, ["content", "slice"]).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


travels(__name__)
