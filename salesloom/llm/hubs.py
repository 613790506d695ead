"""Comparisons of hubs with their members, in which a hub's payload travels once per part of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import lean

RAYS = 2048  # a hub's payload is repeated for every so many members

Accept = Callable[[bytes, bytes], bool]


def similar(num: int, den: int) -> Accept:
    """Have two sets, as sorted 64-bit numbers, a Jaccard similarity of num/den at least?"""

    def accept(x: bytes, y: bytes) -> bool:
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
        return den * both >= num * (len(a) + len(b) - both)

    return accept


def _judged(accept: Accept):
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload = None
        for batch in batches:
            kept = []
            us, found = batch.column("u").to_pylist(), batch.column("payload").to_pylist()
            for i, (u, own) in enumerate(zip(us, found)):
                if u is None:
                    payload = own  # the hub's, for the members that follow
                elif accept(payload, own):
                    kept.append(i)
            yield batch.select(["u", "v", "part"]).take(pa.array(kept, pa.int64()))

    return lambda batches: lean(judged(batches))


def dealt(pairs: DataFrame) -> DataFrame:
    """The pairs (member u, hub v) with a ``part``: the members of a hub in parts of some RAYS."""
    sizes = pairs.groupBy("v").agg(F.expr(f"1 + count(1) div {RAYS}").alias("parts"))
    return pairs.join(sizes, "v").select("u", "v", F.pmod(F.xxhash64("u"), F.col("parts")).alias("part"))


def accepted(pairs: DataFrame, payloads: DataFrame, accept: Accept) -> DataFrame:
    """The pairs (u, v, part) whose payloads, of (key, payload), ``accept`` takes.

    A hub's payload comes before its members' in each part; a task holds one payload at a time.
    """
    members = pairs.join(payloads.select(F.col("key").alias("u"), "payload"), "u")
    kind = pairs.schema["u"].dataType
    hubs = pairs.select("v", "part").distinct().join(
        payloads.select(F.col("key").alias("v"), "payload"), "v"
    ).withColumn("u", F.lit(None).cast(kind))
    return hubs.unionByName(members).repartition("v", "part").sortWithinPartitions(
        "v", "part", F.col("u").asc_nulls_first()
    ).select("u", "v", "part", "payload").mapInArrow(
        _judged(accept), f"u {kind.simpleString()}, v {kind.simpleString()}, part long"
    )
