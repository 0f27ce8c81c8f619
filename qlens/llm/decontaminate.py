"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k edits is split into k + 1 pieces: wherever
it occurs with at most k edits, one piece is untouched. All pieces of a block
of items are found at once by an Aho-Corasick automaton; a hit names a window
of the text, and Myers' bit-parallel distance decides. Before that, a count of
shared 4-grams, each edit of which can spoil at most four, drops windows that
can't be within the budget.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qlens.llm.common import give_back, per_worker, text_or_empty, travels, whole_row
from qlens.storage import kept

ERROR_RATE = 0.1
# Items are sent to the executors in blocks of about so many characters.
BLOCK_CHARACTERS = 4_000_000
GRAM = 4


def normal(text: str) -> str:
    """Lower case, one blank for any white space, none at the ends."""
    return " ".join(text.lower().split())


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(length * rate)


def split(item: str, pieces: int) -> list[tuple[int, str]]:
    """(offset, piece): ``pieces`` parts whose lengths differ by one at most."""
    cuts = [len(item) * k // pieces for k in range(pieces + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(item: str) -> dict[str, int]:
    """For each character the bits of its places in the item."""
    out: dict[str, int] = {}
    for k, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << k
    return out


def closest(places: dict[str, int], length: int, window: str) -> tuple[int, int]:
    """(edits, end) of the part of ``window`` nearest to the item; Myers' columns as whole integers."""
    full = (1 << length) - 1
    top = 1 << (length - 1)
    rises, falls, edits = full, 0, length
    best, end = length, 0
    for at, c in enumerate(window, 1):
        same = places.get(c, 0)
        x = same | falls
        d = (((same & rises) + rises) ^ rises) | same
        up = falls | (full & ~(d | rises))
        down = rises & d
        if up & top:
            edits += 1
        elif down & top:
            edits -= 1
            if edits < best:
                best, end = edits, at
        up = (up << 1) & full
        rises = ((down << 1) & full) | (full & ~(x | up))
        falls = up & x
    return best, end


class Matcher:
    """All items of a block: (item_id, edits, end) of those that occur in a text within their budget."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normal(text)
            if not item:
                continue
            k = budget(len(item), rate)
            for offset, piece in split(item, k + 1):
                places.setdefault(piece, []).append((len(self.items), offset + len(piece)))
            grams = {item[i : i + GRAM] for i in range(len(item) - GRAM + 1)}
            self.items.append((item_id, len(item), k, masks(item), grams))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, tuple(found))
        if places:
            self.automaton.make_automaton()

    def possible(self, item: tuple, window: str) -> bool:
        """False only if too few of the window's 4-grams are the item's: an occurrence keeps all but four for each edit."""
        _, length, k, _, grams = item
        need = length - k - GRAM + 1 - GRAM * k
        return need <= 0 or sum(window[i : i + GRAM] in grams for i in range(len(window) - GRAM + 1)) >= need

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        if not self.items:
            return []
        own = normal(text)
        starts: dict[int, set[int]] = {}
        for end, found in self.automaton.iter(own):
            for n, within in found:
                starts.setdefault(n, set()).add(end + 1 - within)
        out = []
        for n, begins in starts.items():
            item = self.items[n]
            item_id, length, k, places, _ = item
            best = (k + 1, 0)
            for a, b in merged(begins, k, length, len(own)):
                if self.possible(item, own[a:b]):
                    edits, end = closest(places, length, own[a:b])
                    best = min(best, (edits, a + end))
            if best[0] <= k:
                out.append((item_id, *best))
        return out


def merged(begins: set[int], k: int, length: int, size: int) -> Iterator[tuple[int, int]]:
    """Windows that hold the item wherever it may begin, up to k away from a hit; those that overlap by most are joined."""
    first = last = None
    for b in sorted(begins):
        if last is not None and b - last <= 2 * k:
            last = b
            continue
        if last is not None:
            yield max(0, first - k), min(size, last + length + k)
        first = last = b
    if last is not None:
        yield max(0, first - k), min(size, last + length + k)


# --- on Spark ----------------------------------------------------------------


def blocks(benchmark: DataFrame, block_characters: int = BLOCK_CHARACTERS) -> Iterator[tuple[list[tuple[int, str]], int]]:
    """The benchmark's distinct items as (item_id, text), in blocks of about ``block_characters``, each with the number of blocks."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text")).filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // block_characters))
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r.item_id, r.text) for r in own.orderBy("item_id", "text").collect()], n


def matcher(shared: Broadcast, rate: float) -> Callable[[], Matcher]:
    """For tasks: the matcher of a block, made once by each Python worker from the broadcast items."""
    key = uuid.uuid4().hex
    return lambda: per_worker(key, lambda: Matcher(shared.value, rate))


def one_by_one(spark: SparkSession, benchmark: DataFrame, rate: float, block_characters: int, work: Callable) -> list[DataFrame]:
    """``work(matcher, results so far)`` for each block.

    A single block's result is lazy. Of several, each is written to the shared
    folder and its broadcast withdrawn before the next goes out, so that
    executors never hold more than one.
    """
    found: list[DataFrame] = []
    for items, n in blocks(benchmark, block_characters):
        shared = spark.sparkContext.broadcast(items)
        result = work(matcher(shared, rate), found)
        found.append(result if n == 1 else kept(result))
        if n > 1:
            shared.destroy()
    return found


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """doc_id, item_id, edits, end: every document and item that occurs in it, its fewest edits and where that ends.

    An item occurs if a part of the normalised text is at most
    floor(rate x item length) edits away; ``end`` counts characters of the
    normalised text. Items of under ten characters have no budget: they are found as they are, inside
    words too. Null texts hold nothing and null or blank items occur
    nowhere; repeated rows give repeated results, repeated items one; an empty table of either kind gives none.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))

    def found_in(block: Callable[[], Matcher], _: list[DataFrame]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            match = block()
            for batch in batches:
                rows = [(k, *m) for k, t in enumerate(batch.column("text").to_pylist()) for m in match(t)]
                place, item, edits, end = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(place, pa.int64())),
                        pa.array(item, pa.int64()),
                        pa.array(edits, pa.int32()),
                        pa.array(end, pa.int64()),
                    ],
                    ["doc_id", "item_id", "edits", "end"],
                )

        return texts.mapInArrow(run, "doc_id bigint, item_id bigint, edits int, end bigint")

    return reduce(DataFrame.unionByName, one_by_one(docs.sparkSession, benchmark, rate, block_characters, found_in))


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """``docs`` with all columns, without the rows that hold an item of ``benchmark``.

    Null and empty texts stay, as they hold nothing; repeated rows stay or go
    together; without items everything stays.
    """

    def without(block: Callable[[], Matcher], before: list[DataFrame]) -> DataFrame:
        rows = before[-1] if before else docs

        @F.pandas_udf("boolean")
        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            match = block()
            for texts in batches:
                yield texts.map(lambda t: not match(t)).astype(bool)
                give_back()

        return rows.select(whole_row(rows), clean(text_or_empty()).alias("ok")).filter("ok").select("row.*")

    return one_by_one(docs.sparkSession, benchmark, rate, block_characters, without)[-1]


travels(__name__)
