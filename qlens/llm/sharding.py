"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime
size: an offset and a step, both from a hash of its name. The shards take
turns, each claiming the first slot of its order that is still free, until the
table is full. A row's key hashes to a slot, and the broadcast table gives its
shard. Adding or removing a shard leaves most slots where they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qlens.llm.common import whole_row

SHARDS = tuple(f"shard-{k:03d}" for k in range(64))
SLOTS = 65_537


def preference(name: str, slots: int) -> tuple[int, int]:
    """(offset, step): the shard prefers offset, offset + step, offset + 2 step, ... modulo the prime number of slots."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, 1 + int.from_bytes(digest[8:], "big") % (slots - 1)


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard; ``slots`` is prime and the result does not depend on the shards' order."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, and at least one")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    turns = sorted(range(len(shards)), key=lambda k: shards[k])
    at, step = map(list, zip(*(preference(s, slots) for s in shards)))
    table, free = [-1] * slots, slots
    while free:
        for k in turns:
            while table[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % slots
            table[at[k]] = k
            free -= 1
            if not free:
                break
    return table


def table_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard) rows of the table."""
    owners = ",".join(map(str, lookup_table(shards, slots)))
    names = F.array(*[F.lit(s) for s in shards])
    found = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    return found.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of the key as text, modulo ``slots``; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def place(docs: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(row, slot, shard): every row of ``docs`` as a struct, and where it belongs.

    No row is shuffled: the table is broadcast, and has ``slots`` rows whatever
    the size of the input. Rows with equal keys, repeated rows among them, go
    to the same shard; an empty table gives none.
    """
    rows = docs.select(whole_row(docs), slot_of(F.col(key), slots).alias("slot"))
    return rows.join(F.broadcast(table_frame(docs.sparkSession, shards, slots)), "slot").select("row", "slot", "shard")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> None:
    """Writes ``docs`` as Parquet, a folder ``_shard=<name>`` for each shard.

    Rows are rebalanced by shard first, so that not every task writes a file to
    every folder; a shard too large for one task is split over several.
    """
    placed = place(docs, key, shards, slots).select("row.*", F.col("shard").alias("_shard"))
    placed.hint("rebalance", "_shard").write.partitionBy("_shard").parquet(path)


def assignments(docs: DataFrame) -> DataFrame:
    """doc_id, slot, shard of every document."""
    return place(docs.select("doc_id")).select("row.doc_id", "slot", "shard")
