import random

from llm_helpers import rows

from qlens.llm import decontaminate as d


def edits_within(item, text):
    """Fewest edits between the item and any part of the text."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, x in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != x)))
        before = now
    return min(before)


def changed(rng, text, n):
    own = list(text)
    for _ in range(n):
        k = rng.randrange(len(own))
        kind = rng.randrange(3)
        own[k : k + 1] = [[], ["z"], [own[k], "q"]][kind]
    return "".join(own)


def words(rng, n, pool=40):
    return " ".join("".join(random.Random(rng.randrange(pool)).choices("abcdefgh", k=5)) for _ in range(n))


def test_closest_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        item = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 30)))
        edits, end = d.closest(d.masks(item), len(item), text)
        assert edits == edits_within(item, text)
        assert edits == edits_within(item, text[:end]) if end else edits == len(item)


def test_pieces():
    for n in range(1, 40):
        for k in range(1, n + 1):
            parts = d.split("x" * n, k)
            assert len(parts) == k and sum(len(p) for _, p in parts) == n and min(len(p) for _, p in parts) >= 1
            assert [a for a, _ in parts] == [sum(len(p) for _, p in parts[:j]) for j in range(k)]


def test_every_occurrence_within_budget_is_found(spark, make_docs):
    rng = random.Random(2)
    items = [(k, words(rng, rng.randint(3, 12))) for k in range(12)] + [(50, None), (51, " \n"), (52, "a"), (3, "other text of id three here")]
    texts = []
    for k in range(80):
        body = words(rng, rng.randint(0, 30))
        if k % 3:
            item = items[rng.randrange(12)][1]
            body += " " + changed(rng, item, rng.randint(0, d.budget(len(item)) + 2)).upper() + "\n" + words(rng, 3)
        texts.append((k, body))
    texts += [(200, None), (201, ""), (202, (words(rng, 2000) + " " + items[0][1])), (1, texts[1][1]), (None, items[1][1])]
    docs = make_docs(*texts, extra="item_id edits end ok row")
    benchmark = spark.createDataFrame(items + items[:2], "item_id bigint, text string")
    expected = set()
    for doc_id, text in texts:
        own = d.normal(text or "")
        for item_id, item in items:
            item = d.normal(item or "")
            if item and (e := edits_within(item, own)) <= d.budget(len(item)):
                expected.add((doc_id, item_id, e))
    assert len(expected) > 40
    for block in (d.BLOCK_CHARACTERS, 100):  # one block, and several
        found = d.matches(docs, benchmark, block_characters=block)
        assert {tuple(r)[:3] for r in found.collect()} == expected
        kept = d.keep_clean(docs, benchmark, block_characters=block)
        assert kept.columns == docs.columns
        leaks = {k for k, _, _ in expected}
        assert rows(kept.select("doc_id", "text")) == sorted(((k, t) for k, t in texts if k not in leaks), key=repr)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = make_docs((1, "a b"), (2, None))
    assert d.matches(docs, none).collect() == []
    assert rows(d.keep_clean(docs, none)) == rows(docs)
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert d.matches(make_docs(), some).collect() == []
    assert d.keep_clean(make_docs(), some).collect() == []
