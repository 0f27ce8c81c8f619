import random

import numpy as np
import xxhash

from qlens.llm import simhash


def brute_print(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=2):
    """{print: smallest member} by comparing all pairs."""
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    own = sorted(parent)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {p: find(p) for p in own}


def near_prints(rng, groups, size):
    out = set()
    for _ in range(groups):
        at = rng.getrandbits(64)
        for _ in range(size):
            out.add(at)
            at ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))  # a chain of links
    return sorted(out)


def test_fingerprint_bits():
    texts = ["", None, "one", "One TWO", "a b c", "a b c a b c d", "É é É é\x1cx", "x " * 500, "q r s t u"]
    texts += [" ".join(random.Random(k).choices("abcdefgh", k=k)) for k in (3, 17, 400)]
    for t in texts:
        assert simhash.simhash(t or "") == brute_print(t)
    assert simhash.simhash("") == 0


def test_near_texts_share_a_shard():
    rng = random.Random(3)
    prints = np.array(near_prints(rng, 300, 4), dtype=np.uint64)
    tree = simhash.grow(prints[::3], 40, 1)
    at, shards = simhash.shards_of(tree, prints, 1)
    homes = {}
    for k, s in zip(at.tolist(), shards.tolist()):
        homes.setdefault(k, set()).add(s)
    assert len(set(shards.tolist())) > 10
    for i in range(len(prints)):
        assert homes[i]
        for j in range(i):
            if (int(prints[i]) ^ int(prints[j])).bit_count() <= 2:
                assert homes[i] & homes[j]


def test_links_within_a_shard(monkeypatch):
    monkeypatch.setattr(simhash, "OUTRIGHT", 16)
    prints = near_prints(random.Random(4), 60, 6)
    roots = simhash.link(np.array(prints, dtype=np.uint64), 2)
    expected = brute_components(prints)
    assert [prints[r] for r in roots] == [expected[p] for p in prints]


def linked(spark, prints, **options):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.components(simhash.links(spark.createDataFrame(signed, "bits bigint"), **options))
    return {r.node: r.root for r in found.collect()}


def same_partition(found, prints):
    expected = brute_components(prints)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    groups = {}
    for p in prints:
        groups.setdefault(expected[p], set()).add(found.get(signed[p], signed[p]))
    assert all(len(g) == 1 for g in groups.values())
    assert len({g.pop() for g in groups.values()}) == len(groups)


def test_links_over_shards_and_blocks(spark):
    prints = near_prints(random.Random(5), 50, 8)
    same_partition(linked(spark, prints, shard_rows=40), prints)
    dense = [1 << k for k in range(64)] + [1 << j | 1 << k for j in range(12) for k in range(j)] + prints[:40]
    same_partition(linked(spark, sorted(set(dense)), shard_rows=20, block_rows=15), sorted(set(dense)))


def test_components_of_a_long_chain(spark):
    n = 200
    order = random.Random(6).sample(range(n), n)
    found = simhash.components(spark.createDataFrame(list(zip(order, order[1:])), "a bigint, b bigint")).collect()
    assert sorted(r.node for r in found) == list(range(1, n))
    assert {r.root for r in found} == {0}
    assert simhash.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents(documents, make_docs):
    for docs in (
        documents,
        make_docs((5, None), (3, ""), (4, " \n"), (9, "a b c d"), (9, "a b c d"), (7, "A b\tc d"), (None, "a b c d"), (None, "alone here"), extra="bits root component_id row id"),
    ):
        source = docs.select("doc_id", "text").collect()
        prints = [brute_print(r.text) for r in source]
        groups = brute_components(prints)
        lowest = {}
        for r, p in zip(source, prints):
            if r.doc_id is not None:
                lowest[groups[p]] = min(lowest.get(groups[p], r.doc_id), r.doc_id)
        expected = sorted(((r.doc_id, f"{p:016x}", lowest.get(groups[p])) for r, p in zip(source, prints)), key=repr)
        assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == expected
        kept = simhash.one_per_group(docs)
        assert kept.columns == docs.columns
        stay = {g for g in lowest.values()} | ({None} if any(r.doc_id is None and groups[p] not in lowest for r, p in zip(source, prints)) else set())
        assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(stay, key=repr)


def test_kept_texts_by_group(make_docs):
    far = ["one two three four", "five six seven eight", "nine ten eleven twelve"]
    docs = make_docs(
        (None, "a b c d"), (7, "A b\tc d"), (9, "a b c d"),  # a group with ids
        (None, "alone here"), (None, far[0]), (None, far[0]), (None, far[0].upper()),  # two groups without
        (4, far[1]), (4, far[2]), (4, far[2]),  # one id on two unrelated texts
        (None, None), (None, ""), (11, " "),
        extra="h h2 key row first root bits",
    )
    kept = sorted(((r.doc_id, (r.text or "").lower()) for r in simhash.one_per_group(docs).collect()), key=repr)
    assert kept == sorted([(7, "a b\tc d"), (None, "alone here"), (None, far[0]), (4, far[1]), (4, far[2]), (11, " ")], key=repr)


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs()).collect() == []
    assert simhash.one_per_group(make_docs()).collect() == []


def test_group_rows_with_columns_that_have_no_order(spark, make_docs):
    docs = make_docs((1, "a b c d e"), (2, "a b c d e"), (3, "x y z u v"), (3, "x y z u v"), (None, "p q r s t"))
    mapped = docs.selectExpr("*", "map('k', doc_id) AS extra", "array(map('a', text)) AS more", "parse_json('[1]') AS v")
    kept = simhash.one_per_group(mapped)
    assert kept.columns == mapped.columns
    assert sorted((r.doc_id or 0, r.extra["k"]) for r in kept.collect()) == [(0, None), (1, 1), (3, 3)]


def test_tree_sample_is_thinned_before_it_is_sorted(spark):
    prints = spark.range(0, 60_000, 1, 6).selectExpr("xxhash64(id) AS bits")
    rows_, wanted = prints.count(), 1_000
    few = prints.filter(simhash.lowest(simhash.F.xxhash64("bits"), 2 * wanted, rows_))
    assert wanted < few.count() < 3 * wanted
    order = simhash.F.xxhash64("bits")
    assert few.orderBy(order).limit(wanted).collect() == prints.orderBy(order).limit(wanted).collect()
    assert prints.filter(simhash.lowest(order, 10, 5)).count() == rows_
