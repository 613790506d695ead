"""Attach columns of a keyed table to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window, functions as F, types as T


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    how: str = "left",
    null_safe: Sequence[str] = (),
    single: bool = False,
) -> DataFrame:
    """Join ``table`` on ``on`` (row column -> table column) and add ``take``.

    NULL equals nothing, except in the row columns named in ``null_safe``.

    With ``single`` a row may find one table row at most, as a scalar subquery may: finding a second
    one raises and names the key. The table's rows carry the count of their key, taken over the
    partitioning and order that a shuffled join asks for anyway. Keys that no row looks up may
    repeat.

    The strategy is Spark's: a table measured below the broadcast threshold is
    broadcast, else both sides are shuffled on the key and adaptive execution
    splits the partition of a hot key. A table that is bucketed by ``on`` (``CatalogStore.
    write_bucketed``) is read as it lies and only ``rows`` are shuffled. A left join also has to
    keep rows whose key is NULL; they match nothing, so a text of their key is replaced by a hash
    of the row, which spreads them, rather than sent to the one task that owns NULL. Keys
    without a text (dates) have an additional key for that.
    """
    right = table.select(
        *[F.col(c).alias(f"_on_{i}") for i, c in enumerate(on.values())],
        *[F.col(c).alias(f"_take_{c}") for c in take],
    )
    matches = []
    for i, name in enumerate(on):
        found = F.col(f"_on_{i}")
        matches.append(
            F.col(name).eqNullSafe(found) if name in null_safe else F.col(name) == found
        )

    if single:
        keys = [f"_on_{i}" for i in range(len(on))]
        right = right.withColumn(
            "_held", F.count(F.lit(1)).over(Window.partitionBy(*keys))
        )

    left = rows
    texts = [i for i, c in enumerate(on) if isinstance(rows.schema[c].dataType, T.StringType)]
    if how == "left" and not null_safe and texts:
        missing = reduce(or_, [F.col(c).isNull() for c in on])
        name = list(on)[texts[0]]
        hashed = F.xxhash64(*rows.columns).cast("string")
        left = rows.withColumns({
            "_spread": F.when(missing, hashed).otherwise(F.col(name)), "_complete": ~missing,
        })
        # The hash might equal some key, so completeness is asked for beside it.
        matches[texts[0]] = (F.col("_spread") == F.col(f"_on_{texts[0]}")) & F.col("_complete")
    elif how == "left" and not null_safe:
        missing = reduce(or_, [F.col(c).isNull() for c in on])
        left = rows.withColumn(
            "_spread", F.when(missing, F.xxhash64(*rows.columns)).otherwise(F.lit(0))
        )
        # Always 0, but not a constant: Spark would take a constant out of the join key.
        right = right.withColumn("_zero", F.pmod(F.xxhash64("_on_0"), F.lit(1)))
        matches.append(F.col("_spread") == F.col("_zero"))

    joined = left.join(right, reduce(and_, matches), how)
    taken = {c: F.col(f"_take_{c}") for c in take}
    if single:
        shown = F.concat_ws(", ", *[
            F.concat(F.lit(f"{name} = "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
            for c, name in on.items()
        ])
        error = F.raise_error(F.concat(F.lit("more than one row for "), shown))
        # Part of every taken value, so that no projection drops the check.
        taken = {
            c: F.when(F.col("_held") > 1, error.cast(table.schema[c].dataType)).otherwise(value)
            for c, value in taken.items()
        }
    return joined.select(*rows.columns, *[value.alias(c) for c, value in taken.items()])
