"""One row per business key, the same row every time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def settled(distinct: DataFrame, *by: str) -> DataFrame:
    """The rows of a distinct step, shuffled by ``by``.

    Without an exchange between them Spark drops a distinct below another grouping: all
    input rows would then be sorted for the aggregation above, or parsed by what
    stands between.
    """
    return distinct.repartition(*by)


# Bytes of a written tuple: what ends a value, and what a missing and a given one begin with.
END, MISSING, GIVEN = "\x00", "\x01", "\x02"
# END and MISSING inside a value, in an order that undoes what the reverse does.
ESCAPES = ((MISSING, MISSING + GIVEN), (END, MISSING + MISSING))


def written(*texts: str) -> Column:
    """A tuple of texts as one: equal for equal tuples only, and ordered as they are column by
    column, NULL first. One column is narrower to shuffle and quicker to hash than many."""

    def value(name: str) -> Column:
        text = F.col(name)
        for byte, escape in ESCAPES:
            text = F.replace(text, F.lit(byte), F.lit(escape))
        return F.coalesce(F.concat(F.lit(GIVEN), text), F.lit(MISSING))

    return F.concat(*[part for name in texts for part in (value(name), F.lit(END))])


def read_back(column: str, *texts: str) -> list[Column]:
    """The texts that ``written`` was given."""

    def value(place: int) -> Column:
        part = F.split_part(F.col(column), F.lit(END), F.lit(place))
        text = F.substring(part, 2, 2**31 - 1)
        for byte, escape in reversed(ESCAPES):
            text = F.replace(text, F.lit(escape), F.lit(byte))
        return F.when(part != MISSING, text)

    return [value(i + 1).alias(name) for i, name in enumerate(texts)]


def one_row_per_key(df: DataFrame, key: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Keep, per key, the smallest payload in column order, nulls first.

    NULL key parts are equal to each other. The distinct step comes first because
    it is a hash aggregation that combines before its shuffle and spreads the
    variants of a hot key over all tasks; what is left to sort and compare is one row per
    different description, not one per input row. Texts are shuffled as one column for the key and
    one for the payload.
    """
    types = {f.name: f.dataType for f in df.schema}
    if any(types[c] != T.StringType() for c in (*key, *payload)):
        variants = settled(df.select(*key, *payload).distinct(), *key)
        winner = F.min(F.struct(*payload)).alias("_winner")
        return variants.groupBy(*key).agg(winner).select(
            *key, *[F.col("_winner")[c].alias(c) for c in payload]
        )
    rows = df.select(written(*key).alias("_key"), written(*payload).alias("_payload"))
    winners = settled(rows.distinct(), "_key").groupBy("_key").agg(
        F.min("_payload").alias("_payload")
    )
    return winners.select(*read_back("_key", *key), *read_back("_payload", *payload))
