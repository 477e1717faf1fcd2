"""Place documents on shards by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size (offset and stride taken from
its name). Shards take turns; each claims its first preferred slot that is free, until the table is full.
Shares differ by one slot at most, and when a shard leaves, few slots of the others change hands.

The table has ``slots`` rows whatever the data's size, so it is filled on the driver and broadcast; a
document costs one hash and one look-up in a hash table. Keys are hashed by value: null keys have the
place of the text "null", repeated keys share a shard, an empty table gives an empty result, and columns
that the input already has under the names of the result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
SLOTS = 4099  # a prime above a hundred slots for each shard


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> np.ndarray:
    """For each slot the index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots or not _is_prime(slots):
        raise ValueError("shards must be distinct, at least one, at most as many as the prime number of slots")
    preferences = [
        ((_number(f"offset {s}") + np.arange(slots) * (_number(f"stride {s}") % (slots - 1) + 1)) % slots).tolist()
        for s in shards
    ]
    turn_of, table = [0] * len(shards), np.full(slots, -1)
    for turn in range(slots):
        shard = turn % len(shards)
        order, at = preferences[shard], turn_of[shard]
        while table[order[at]] >= 0:
            at += 1
        table[order[at]] = shard
        turn_of[shard] = at + 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % slots


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    rows = [(slot, shards[i]) for slot, i in enumerate(lookup(shards, slots).tolist())]
    return spark.createDataFrame(rows, "slot long, shard string")


def place(frame: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The rows with their slot and shard."""
    table = lookup_table(frame.sparkSession, shards, slots)
    keyed = frame.drop("shard").withColumn("slot", slot_of(F.col(key), slots))
    return keyed.join(F.broadcast(table), "slot")  # a fixed number of rows
