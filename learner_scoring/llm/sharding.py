"""Shard placement by a permutation-filled lookup table; DataFrame functions only.

Every shard has its own order of preference over the slots of a prime-sized
table, and the shards take turns in claiming their next free slot. A key's hash
names a slot and the slot its shard: placement takes one look, shards get equal
shares, and adding or removing a shard moves few keys.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots (a prime, well above the number of shards) and shards of the registered query.
SLOTS = 16381
SHARDS = 64


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _number(label: str) -> int:
    return int(hashlib.md5(label.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard; bounded by ``slots``, whatever the data.

    Shard ``s`` prefers slots offset, offset + skip, offset + 2 skip, ... modulo
    the prime, which is a permutation for any skip from 1 to slots - 1.
    """
    if not shards or len(shards) > slots or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("there must be one shard at least, no more than slots, and a prime number of slots")
    at = [_number(f"offset:{s}") % slots for s in shards]
    skip = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): the lookup table, small enough to broadcast by construction."""
    return spark.createDataFrame(list(enumerate(shards[i] for i in lookup_table(shards, slots))), "slot long, shard string")


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot a key hashes to; null keys hash like the empty string."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long") % slots


def place(rows: DataFrame, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` (columns so named are replaced).

    Equal keys go to one shard; a null key counts as the empty string; an empty
    table gives no rows. The rows stay where they are: the table comes to them.
    """
    kept = rows.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots))
    return kept.join(F.broadcast(table_frame(rows.sparkSession, shard_names(shards), slots)), "slot").select(*kept.columns, "shard")
