import hashlib
import random

import pytest

from qlens.llm import winnowing as w


def brute(text, k, window):
    codes = [ord(c) + 1 for c in text]
    if not codes:
        return []
    k = min(k, len(codes))
    hashes = []
    for i in range(len(codes) - k + 1):
        h = sum(codes[i + j] * pow(w.BASE, j, 1 << 64) for j in range(k)) % (1 << 64)
        h ^= h >> 32
        h = h * w.MIX % (1 << 64)
        hashes.append((h ^ h >> 32) >> w.PLACE_BITS)
    window = min(window, len(hashes))
    out = set()
    for i in range(len(hashes) - window + 1):
        least = min(hashes[i : i + window])
        out.add((max(j for j in range(i, i + window) if hashes[j] == least), least))
    return sorted(out)


def pairs(found):
    return list(zip(found[1].tolist(), found[0].tolist()))


@pytest.mark.parametrize("segment", [1 << 22, 60])
def test_against_definition(monkeypatch, segment):
    monkeypatch.setattr(w, "SEGMENT", segment)
    rng = random.Random(1)
    for k, window in ((3, 4), (5, 7), (16, 20)):
        for _ in range(60):
            text = "".join(rng.choices("ab\U0001f600é", k=rng.randint(0, 300)))
            assert pairs(w.winnow(text, k, window)) == brute(text, k, window)
        assert pairs(w.winnow("a" * 200, k, window)) == brute("a" * 200, k, window)  # all ties


def test_guarantee():
    rng = random.Random(2)
    for _ in range(50):
        a, b, shared = ("".join(rng.choices("abcdefgh ", k=n)) for n in (rng.randint(0, 200), rng.randint(0, 200), w.K + w.WINDOW - 1))
        x, y = w.winnow(a + shared + b), w.winnow(b + shared + a)
        assert set(x[0].tolist()) & set(y[0].tolist())


def test_likeness():
    empty, some = w.winnow(""), w.winnow("some text that is long enough " * 9)
    assert w.likeness(empty, empty) == 1 and w.likeness(some, some) == 1 and w.likeness(some, empty) == 0


def expected(texts):
    """{doc_id: result} of (doc_id, text) pairs with different ids."""
    order = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (k, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other = w.winnow(text), w.winnow(edited)
        out[k] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), w.as_text(own), w.as_text(other), w.likeness(own, other), w.likeness(own, w.winnow(after)))
    return out


@pytest.mark.parametrize("range_rows", [1, 7, 5000])
def test_next_document(make_docs, documents, monkeypatch, range_rows):
    texts = [(r.doc_id * 7 % 1009, r.text) for r in documents.limit(70).collect()]
    texts += [(2000, ""), (2001, "x"), (None, "no id at all"), (-3, "negative"), (2002, "long text " * 30000)]
    docs = make_docs(*texts, (2003, None), extra="id bucket extra fingerprint near_next")
    monkeypatch.setattr(w.in_id_order, "__defaults__", (range_rows, w.MAX_RANGES))
    out = w.compare_with_next(docs).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == expected([*texts, (2003, "")])
    assert len(out) == len(texts) + 1


def test_few_and_repeated_rows(make_docs):
    assert w.compare_with_next(make_docs()).collect() == []
    one = w.compare_with_next(make_docs((5, "only text"))).collect()
    assert [tuple(r)[:2] for r in one] == [(5, 9)] and one[0].near_next == 1
    same = w.compare_with_next(make_docs((5, "b" * 90), (5, "a" * 90), (5, "a" * 90), (1, "c" * 90))).collect()
    assert sorted(r.doc_id for r in same) == [1, 5, 5, 5]
    assert len({r.fingerprint for r in same if r.doc_id == 5}) == 2


def test_fingerprints_of_a_table(make_docs):
    out = {r.doc_id: (r.hashes, r.places) for r in w.fingerprints(make_docs((1, "text " * 40), (2, None))).collect()}
    own = w.winnow("text " * 40)
    assert out == {1: (own[0].tolist(), own[1].tolist()), 2: ([], [])}


def test_rows_of_one_id_are_spread(make_docs, documents):
    """A third of all rows with one id, a third without any: no range holds more than a few times its rows."""
    texts = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text number {k} of its kind") for k in range(1500)]
    dealt = w.in_id_order(make_docs(*texts), 50, w.MAX_RANGES)
    counts = sorted(r["count"] for r in dealt.groupBy("bucket").count().collect())
    assert sum(counts) == 1500 + len(counts) and len(counts) > 15 and counts[-1] < 300
    out = w.compare_with_next(make_docs(*texts)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((i is None, i or 0) for i, _ in texts)


def test_smallest_id_and_no_id_differ(make_docs):
    lowest = -(1 << 63)
    out = {r.doc_id: tuple(r)[1:] for r in w.compare_with_next(make_docs((lowest, "a" * 70), (None, "b" * 70), (1, "c" * 70))).collect()}
    assert out == expected([(lowest, "a" * 70), (None, "b" * 70), (1, "c" * 70)])
