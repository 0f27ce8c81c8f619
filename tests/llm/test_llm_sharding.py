import hashlib
import re

import pytest
from llm_helpers import rows

from qlens.llm import sharding

NAMES = ("a", "b", "c", "d", "e")


def brute_table(shards, slots):
    """Turn by turn over explicit preference lists."""
    lists = {}
    for s in shards:
        offset, step = sharding.preference(s, slots)
        order = [(offset + k * step) % slots for k in range(slots)]
        assert sorted(order) == list(range(slots))
        lists[s] = iter(order)
    table = {}
    while len(table) < slots:
        for s in sorted(shards):
            if len(table) < slots:
                table[next(x for x in lists[s] if x not in table)] = s
    return [table[k] for k in range(slots)]


def test_table_against_turns():
    for slots in (7, 53, 257):
        for shards in (NAMES, NAMES[:1], NAMES[::-1]):
            assert [shards[k] for k in sharding.lookup_table(shards, slots)] == brute_table(shards, slots)


def test_even_and_stable():
    before = sharding.lookup_table()
    shares = [before.count(k) for k in range(len(sharding.SHARDS))]
    assert max(shares) - min(shares) <= 1
    after = sharding.lookup_table(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(before, after) if a != len(sharding.SHARDS) - 1)
    assert moved / sharding.SLOTS < 0.1


def test_wrong_tables():
    for shards, slots in (((), 7), (("a", "a"), 7), (("a",), 8), (("a",), 1)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def slot(key, slots=sharding.SLOTS):
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % slots


def test_placement(make_docs):
    docs = make_docs((1, "x"), (1, "x"), (2, None), (None, ""), (-5, "y" * 100000), extra="slot shard row owner")
    out = sharding.place(docs)
    table = sharding.lookup_table()
    for r in out.collect():
        key = "" if r.row.doc_id is None else str(r.row.doc_id)
        assert (r.slot, r.shard) == (slot(key), sharding.SHARDS[table[slot(key)]])
    assert rows(out.select("row.*")) == rows(docs)
    by_text = sharding.place(docs, key="text", shards=NAMES, slots=53).collect()
    assert all(r.shard == NAMES[sharding.lookup_table(NAMES, 53)[slot(r.row.text or "", 53)]] for r in by_text)
    assert sharding.assignments(make_docs()).collect() == []


def test_written_shards(spark, documents, tmp_path):
    sharding.write_shards(documents, str(tmp_path / "out"), shards=NAMES, slots=53)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back.drop("_shard")) == rows(documents)
    assert set(back.select("doc_id", "_shard").collect()) == set(sharding.place(documents, shards=NAMES, slots=53).select("row.doc_id", "shard").collect())


def test_native(documents):
    plan = sharding.assignments(documents)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
