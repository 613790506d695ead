"""Placement of keys on shards by a permutation-filled lookup table (operator 8).

Every shard has its own permutation of the slots of a table of prime size, given by an offset
and a skip that are hashes of its name. Shards take turns: each claims the next free slot of
its permutation, until the table is full, so shares differ by one slot at most (or follow the
weights, by more turns). A key's slot is its hash modulo the size. If a shard leaves, its slots
are claimed by the others and few other slots change hands.

The table's size is fixed, so it is safe to broadcast: a lookup is one hash join, without a
shuffle of the rows, at any input size. A hot key is one shard by the meaning of placement;
where its rows are too many for one place, ``spread`` deals them over several shards by a
second key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS = 65_537


def _hash(text: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{text}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> list[str]:
    """The shard of every slot. Names are taken in sorted order, so their order in the call does
    not matter; a mapping gives turns per round. ``slots`` must be prime and at least the
    number of shards."""
    turns = dict(shards) if isinstance(shards, Mapping) else {s: 1 for s in shards}
    names = sorted(s for s, n in turns.items() if n > 0)
    if not names:
        raise ValueError("no shard to place keys on")
    if slots < len(names) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number not below the number of shards")
    skip = {s: _hash(s, "skip") % (slots - 1) + 1 if slots > 2 else 1 for s in names}
    at = {s: _hash(s, "offset") % slots for s in names}
    owner: list[str | None] = [None] * slots
    free = slots
    while free:
        for name in names:
            for _ in range(turns[name]):
                while owner[at[name]] is not None:
                    at[name] = (at[name] + skip[name]) % slots
                owner[at[name]] = name
                free -= 1
                if not free:
                    return owner
    return owner


def slot_of(key: Column, slots: int = SLOTS, spread: Column | None = None) -> Column:
    """The slot of a key. NULL is placed like the empty text; equal keys meet in one slot
    unless ``spread`` tells their rows apart."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    if spread is not None:
        text = F.concat_ws("\x1f", text, F.coalesce(spread.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % slots


def table_of(spark: SparkSession, shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> DataFrame:
    """(slot, shard), as many rows as slots."""
    owner = lookup_table(shards, slots)
    names = sorted(set(owner))
    number = {name: i for i, name in enumerate(names)}
    packed = ",".join(str(number[name]) for name in owner)
    owners = F.array(*map(F.lit, names))
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(packed), ",")).alias("slot", "n"))
    return rows.select(
        F.col("slot").cast("long").alias("slot"), F.get(owners, F.col("n").cast("int")).alias("shard")
    )


def place(
    rows: DataFrame, key: str, shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS,
    spread: str | None = None,
) -> DataFrame:
    """``rows`` with slot and shard; input columns of these names are replaced. Every row gets
    exactly one shard, repeated rows and NULL keys included."""
    table = table_of(rows.sparkSession, shards, slots)
    slot = slot_of(F.col(key), slots, F.col(spread) if spread else None)
    return rows.drop("slot", "shard").withColumn("slot", slot).join(F.broadcast(table), "slot")
