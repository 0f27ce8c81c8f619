import itertools
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from qlens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    " ",
    "plain words, and a stop.",
    "a\x1cb c d",
    "it's we'll 'S <|endoftext|> x<|startoftext|>y",
    "ÀÉ ß Ünï-cödé İstanbul ΑΣ ΣΑΣ ﬁ ́x é ½ ² 12345 1a2b",
    "wait... what?! no!!! :) ;; A.B.C",
    "x" * 3000 + " tail",
    "\n\n\tq\r\nz  ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def encoded(encode, texts):
    ids, ends = encode(pa.array(["skipped", *texts]).slice(1))
    return [own.tolist() for own in np.split(ids, ends[:-1])]


def test_words_encode_like_whole_texts(tokenizer, documents):
    texts = ODD + [r.text for r in documents.limit(60).collect()]
    encode = packing.WordEncoder(PATH)
    for _ in range(2):  # the second time from the cache
        assert encoded(encode, texts) == [ids_of(tokenizer, t)[:-1] for t in texts]


def test_cache_may_be_emptied_at_any_time(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    encode = packing.WordEncoder(PATH)
    for text in ODD * 2:
        assert encoded(encode, [text]) == [ids_of(tokenizer, text)[:-1]]


def test_other_tokenizers_are_not_taken_apart():
    assert not packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json")).by_words
    assert packing.WordEncoder(PATH).by_words


def test_slices():
    texts = pa.array(["", "abc", "d" * 50, "", "e", "f" * 7])
    for size in (1, 5, 1000):
        found = list(packing.slices(texts, size))
        assert [k for a, n in found for k in range(a, a + n)] == list(range(6))
    assert list(packing.slices(pa.array([], pa.string()), 5)) == []


def test_fullest_against_all_combinations():
    rng = random.Random(1)
    for _ in range(200):
        counts = Counter(rng.choices(range(1, 15), k=rng.randint(1, 8)))
        room = rng.randint(0, 30)
        best = max(
            sum(k * n for k, n in zip(counts, uses))
            for uses in itertools.product(*[range(n + 1) for n in counts.values()])
            if sum(k * n for k, n in zip(counts, uses)) <= room
        )
        uses = packing.fullest(dict(counts), room)
        assert sum(k * n for k, n in uses) == best
        assert all(n <= counts[k] for k, n in uses)


def test_plan_uses_every_piece_once():
    rng = random.Random(2)
    for _ in range(50):
        counts = Counter(rng.choices(range(1, 21), k=rng.randint(1, 60)))
        plan = packing.fill_plan(counts.items(), 20)
        used = Counter()
        for repeats, uses in plan:
            assert sum(k * n for k, n in uses) <= 20
            for k, n in uses:
                used[k] += n * repeats
        assert used == counts
    assert packing.fill_plan([], 20) == []


def packed_well(out, capacity):
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_documents(tokenizer, make_docs):
    texts = [*ODD, None, "word " * 9000, "same", "same"]
    docs = make_docs(*enumerate(texts), (len(texts) - 1, "same"), (None, "no id"), extra="ids length sequence_id _part row")
    out = packing.pack_documents(docs, PATH).collect()
    expected = Counter()
    for doc_id, text in [*enumerate(texts), (len(texts) - 1, "same"), (None, "no id")]:
        ids = ids_of(tokenizer, text)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            own = ids[start : start + 4096]
            expected[doc_id, piece, start, len(own), zlib.crc32(array("I", own).tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
    packed_well(out, 4096)


def test_as_few_as_the_tokens_allow(documents):
    out = packing.pack_documents(documents, PATH).collect()
    assert packed_well(out, 4096) <= -(-sum(r.length for r in out) // 4096) + 1


def test_one_length_over_many_tasks(spark):
    pieces = spark.range(1000, numPartitions=7).selectExpr("id", "if(id % 3 = 0, 5L, id % 7 + 1) AS length", "'x' AS offset")
    out = packing.pack(pieces, 10).collect()
    assert sorted(r.id for r in out) == list(range(1000))
    assert packed_well(out, 10) == -(-sum(r.length for r in out) // 10)


def test_empty_table(make_docs):
    assert packing.pack_documents(make_docs(), PATH).collect() == []
