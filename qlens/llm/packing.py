"""Best-fit packing by minimum bin slack.

A sequence is filled by its longest remaining piece and the combination of
other lengths that leaves the least room free, found by a subset-sum search
over bitsets. Only how many pieces have each length matters for that, so the
plan is made from a histogram of at most ``capacity`` rows, whatever the size
of the input; a combination is repeated for as long as its lengths last. Spark
then numbers the pieces of each length and looks up their places.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qlens.llm.common import give_back, per_worker, text_or_empty, travels
from qlens.storage import kept

CAPACITY = 4096
CACHED_WORDS = 300_000
CACHED_IDS = 1 << 21
LONG_WORD = 64
SLICE = 3_500_000
# Letters that lower-casing and composition keep letters, and punctuation that stays one token group behind
# them (so no apostrophe).
LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
MARKS = "".join(map(chr, [*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


# --- pieces ------------------------------------------------------------------


class WordEncoder:
    """Token ids of texts, encoding each word once.

    For tokenizers that split at white space and drop it: a text's ids are
    those of its parts between blanks and line feeds. Arrow reduces the parts
    of a slice to the distinct ones, and those to lower-case words and the
    marks behind them, so that what is left for Python is one look-up for each
    distinct word. Plain words are encoded many to a
    call and told apart by the vocabulary's word-end mark, past the steps that
    find words; this is tried out first and left alone where it doesn't give
    the same ids. Anything else is a call of its own. Ids lie in one array, a
    word's at the number it has in ``slots``; all is dropped when it is full.
    """

    def __init__(self, path: str, end_id: int = 1):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.words = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.whole.get_vocab()
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        trial = "a the word tokenizer ärger naïve éèêëçñößü x unbelievably zzzzq".split()
        self.by_words = bool(suffix) and self.plain(trial) == self.direct(trial)
        self.end_id = end_id
        self.forget()

    def direct(self, parts: list[str], at_once: int = 500) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(parts), at_once):
            found = self.whole.encode_batch_fast(parts[k : k + at_once], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in found]
        return out

    def plain(self, words: list[str], at_once: int = 500) -> list[bytes]:
        """Ids of lower-case words of letters only; each ends at the first token with the word-end mark."""
        out: list[bytes] = []
        for k in range(0, len(words), at_once):
            own = words[k : k + at_once]
            ids = np.array(self.words.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip([0, *stops], stops)]
        return out

    def forget(self) -> None:
        """Slot 0 has no ids, slot 1 the end id."""
        self.slots: dict[str, int] = {"": 0}
        self.ids = np.array([self.end_id], dtype="<u4")
        self.stops = np.array([0, 0, 1], dtype=np.int32)  # a slot's ids end where the next one's begin

    def find(self, parts: list[str], encode) -> np.ndarray:
        """The slots of distinct parts; those not known are encoded."""
        found = list(map(self.slots.get, parts))
        new = [k for k, slot in enumerate(found) if slot is None]
        if new:
            first, ids = len(self.stops) - 1, encode([parts[k] for k in new])
            sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) // 4
            self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(ids), dtype="<u4")))
            self.stops = np.concatenate((self.stops, self.stops[-1] + np.cumsum(sizes, dtype=np.int32)))
            for slot, k in enumerate(new, first):
                found[k] = slot
                if len(parts[k]) <= LONG_WORD:
                    self.slots[parts[k]] = slot
        return np.array(found, dtype=np.int32)

    def slots_of(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Two slots for each distinct part: its word and the marks behind it, or all of it and nothing."""
        first, second = np.zeros(len(parts), dtype=np.int32), np.zeros(len(parts), dtype=np.int32)
        words = pc.utf8_rtrim(parts, MARKS)
        split = pc.match_substring_regex(words, f"^[{LETTERS}]+$") if self.by_words else pa.array(np.zeros(len(parts), bool))
        at = split.to_numpy(zero_copy_only=False)
        for out, where, own, encode in (
            (first, at, pc.utf8_lower(words.filter(split)), self.plain),
            (second, at, pc.utf8_ltrim(parts.filter(split), LETTERS), self.direct),
            (first, ~at, parts.filter(pc.invert(split)), self.direct),
        ):
            named = own.dictionary_encode()
            out[where] = self.find(named.dictionary.to_pylist(), encode)[named.indices.to_numpy()]
        return first, second

    def __call__(self, texts: pa.Array, ended: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's end); if ``ended``, the end id stands behind each text's."""
        if len(self.slots) > CACHED_WORDS or len(self.ids) > CACHED_IDS:
            self.forget()
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        places = parts.flatten().dictionary_encode()
        pairs = np.stack((*self.slots_of(places.dictionary),), axis=1).ravel()
        halves = pa.ListArray.from_arrays(pa.array(self.stops), pa.array(self.ids)).take(pa.array(np.append(pairs, (0, 0, 1, 0))))
        each = pa.ListArray.from_arrays(pa.array(halves.offsets.to_numpy()[::2]), halves.flatten())
        last = parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()
        # an empty part or the end id behind each text
        found = each.take(pa.array(np.insert(places.indices.to_numpy(), last, len(each) - (1 if ended else 2))))
        return found.flatten().to_numpy(), found.offsets.to_numpy()[last + np.arange(1, len(last) + 1)].astype(np.int64)


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Runs of texts, (first, count), of about ``size`` bytes each."""
    run = np.cumsum(pc.binary_length(texts).to_numpy()) // size
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.empty(0, int)
    yield from zip(starts.tolist(), np.diff([*starts, len(run)]).tolist())


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Documents as token pieces: doc_id, piece, start, length, ids (bytes of little-endian uint32).

    Each document's ids are followed by ``end_id``; only documents longer than
    ``capacity`` are cut. A null or empty text is the one piece (end_id);
    repeated rows give repeated pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker(("words", tokenizer_path, end_id), lambda: WordEncoder(tokenizer_path, end_id))
        for batch in batches:
            for at, n in slices(batch.column("text"), SLICE):
                ids, ends = encode(batch.column("text").slice(at, n), ended=True)
                starts = np.concatenate(([0], ends[:-1]))
                lengths = ends - starts
                count = -(-lengths // capacity)
                place = np.repeat(np.arange(n), count)
                piece = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, lengths[place] - start)
                begin = starts[place] + start
                raw = memoryview(ids).cast("B")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, n).take(pa.array(place)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([raw[4 * b : 4 * (b + m)] for b, m in zip(begin.tolist(), length.tolist())], pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )
            ids = raw = None
            give_back()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    )


# --- the plan ----------------------------------------------------------------


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, uses) of a combination of the available lengths that leaves the least of ``room`` free.

    Bit s of ``sums`` says that some combination of the lengths seen so far is
    s long. Long lengths come first, so that they are also used first.
    """
    sums, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        steps.append((length, sums))
        left, step = min(counts[length], room // length), 1
        while left > 0:
            sums |= (sums << (min(step, left) * length)) & mask
            left, step = left - step, step * 2
        if sums >> room & 1:
            break
    total, uses = sums.bit_length() - 1, []
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total, n = total - length, n + 1
        if n:
            uses.append((length, n))
    return uses[::-1]


def fill_plan(histogram: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(repeats, [(length, uses)])]: the combinations in the order they are removed."""
    counts = {length: n for length, n in histogram if n > 0}
    plan = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        rest = {length: n for length, n in counts.items() if n > 0}
        counts[longest] += 1
        uses = dict(fullest(rest, capacity - longest))
        uses[longest] = uses.get(longest, 0) + 1
        repeats = min(counts[length] // n for length, n in uses.items())
        for length, n in uses.items():
            counts[length] -= n * repeats
            if not counts[length]:
                del counts[length]
        plan.append((repeats, sorted(uses.items(), reverse=True)))
    return plan


def places(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each length, which of its pieces (numbered from 0) go to which sequences and offsets."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for repeats, uses in plan:
        offset = 0
        for length, n in uses:
            rows.append((length, taken.get(length, 0), n, sequence, offset))
            taken[length] = taken.get(length, 0) + n * repeats
            offset += length * n
        sequence += repeats
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "uses", "sequence", "offset"), columns))


# --- packing -----------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Every row gets its place, repeated rows too; an empty table stays empty.
    Rows are numbered among those of their length that the same task wrote to
    the shared folder; a small table of counts turns that into numbers over
    all rows, so a length that many rows have is never gathered in one task. Columns of
    the input named like the results or the helpers are dropped.
    """
    spark = pieces.sparkSession
    helpers = {"sequence_id", "offset", "_part", "_rank", "_base"}
    payload = [c for c in pieces.columns if c not in helpers]
    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in payload)

    numbered = kept(pieces.select(*[F.col(f"`{c}`") for c in payload], F.spark_partition_id().alias("_part")))
    counts = numbered.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most capacity rows
    shared = spark.sparkContext.broadcast(places(fill_plan(((r.length, r.n) for r in histogram), capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        shift = np.int64(1) << 48
        keys = table["length"] * shift + table["first"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            turn, slot = np.divmod(rank - table["first"][at], table["uses"][at])
            out = [*batch.columns[: len(payload)], pa.array(table["sequence"][at] + turn), pa.array(table["offset"][at] + slot * length)]
            yield pa.RecordBatch.from_arrays(out, [*payload, "sequence_id", "offset"])

    order = Window.partitionBy("_part", "length").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in payload]))
    ranked = numbered.withColumn("_rank", F.row_number().over(order)).join(bases, ["_part", "length"]).select(
        *[F.col(f"`{c}`") for c in payload], (F.col("_base") + F.col("_rank") - 1).alias("_rank")
    )
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Every token piece of the documents with its digest and place; the ids themselves come from ``token_pieces``."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


travels(__name__)
