"""Star model: five entity dimensions, a date dimension and the sales fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions import parse
from salesloom.functions.measures import partial_total, total
from salesloom.operators.dedup import one_row_per_key, settled
from salesloom.operators.keys import content_key, content_key_if_complete, dense_key
from salesloom.operators.lookup import lookup
from salesloom.schema import CUSTOMER, PRODUCT, SELLER, STAR_ENTITIES, STORE, SUPPLIER, Entity


def dimension(staging: DataFrame, entity: Entity, dense: bool = False) -> DataFrame:
    """One row per business key, NULL parts included, with its surrogate id.

    Winners are picked on the raw text and only the winners are parsed.
    """
    winners = one_row_per_key(staging, entity.key, entity.payload)
    keyed = _keyed(winners, entity.id, entity.key, dense)
    return keyed.select(
        *[
            parse.PERMISSIVE[entity.parsed[c]](F.col(c)).alias(c) if c in entity.parsed else c
            for c in entity.columns
        ]
    )


def date_dimension(staging: DataFrame, dense: bool = False) -> DataFrame:
    """Every sale date read permissively, with one NULL row if any is missing or unreadable."""
    texts = settled(staging.select("sale_date").distinct(), "sale_date")
    dates = texts.select(parse.permissive_date(F.col("sale_date")).alias("full_date")).distinct()
    keyed = _keyed(dates, "date_id", ["full_date"], dense)
    return keyed.select(
        "full_date", "date_id",
        *[part.alias(name) for name, part in parse.date_parts(F.col("full_date")).items()],
    )


def _keyed(df: DataFrame, id_column: str, key, dense: bool) -> DataFrame:
    if dense:
        return dense_key(df, id_column, by=key)
    return df.withColumn(id_column, content_key(*[F.col(c) for c in key]))


def dimensions(staging: DataFrame, dense: bool = False) -> dict[str, DataFrame]:
    tables = {e.table: dimension(staging, e, dense) for e in STAR_ENTITIES}
    tables["dim_date"] = date_dimension(staging, dense)
    return tables


def fact(staging: DataFrame) -> DataFrame:
    """One row per staged sale; an id is NULL where a part of the business key is.

    The dimensions come from the same staging rows and their ids are hashes of the
    business key, so each id is computed from the sale's own columns. This is a
    projection: it moves no rows, whatever the size or skew of the keys.
    """
    return _fact(staging)


def _fact(staging: DataFrame, *more: Column) -> DataFrame:
    sale_date = parse.permissive_date(F.col("sale_date"))
    ids = [
        content_key_if_complete(*[F.col(c) for c in e.key]).alias(e.id) for e in STAR_ENTITIES
    ]
    return staging.select(
        *ids, content_key_if_complete(sale_date).alias("date_id"), *_measures(), *more
    )


# Partition columns of the fact by month.
MONTH = ("sale_year", "sale_month")


def fact_by_month(staging: DataFrame) -> DataFrame:
    """The fact with year and month of each sale, NULL for sales without a date, still a
    projection: what a table partitioned by month is written from."""
    date = parse.permissive_date(F.col("sale_date"))
    return _fact(staging, F.year(date).alias(MONTH[0]), F.month(date).alias(MONTH[1]))


def sales_per_month(fact: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Sales of the months from ``first`` to ``last``, (year, month) each.

    The range is told in whole years beside it, so that folders of a table partitioned by year and
    month are skipped before anything is read.
    """
    year, month = (F.col(c) for c in MONTH)
    number = year * 12 + month
    in_range = year.between(first[0], last[0]) & number.between(
        first[0] * 12 + first[1], last[0] * 12 + last[1]
    )
    return fact.where(in_range).groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("num_orders"), *partial_total("sale_total_price", "amount")
    ).select(
        year.alias("year"), month.alias("month"), total("amount").alias("total_sales"), "num_orders"
    )


def fact_by_lookup(staging: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same fact with ids looked up in given dimensions, whatever their ids are.

    Needed for dense ids or dimensions that were loaded elsewhere: six left joins
    on the business keys. Dimensions that are small as a rule come first and take their
    columns out of the rows, so what a large one shuffles is narrow.
    """
    keys = [c for e in STAR_ENTITIES for c in e.key]
    sales = staging.select(
        *keys, parse.permissive_date(F.col("sale_date")).alias("full_date"), *_measures()
    )
    sales = lookup(sales, tables["dim_date"], {"full_date": "full_date"}, ["date_id"]).drop("full_date")
    for entity in (SELLER, STORE, PRODUCT, SUPPLIER, CUSTOMER):
        on = {c: c for c in entity.key}
        # The business key has done its work after its join; shuffle it no further.
        sales = lookup(sales, tables[entity.table], on, [entity.id]).drop(*entity.key)
    return sales.select(
        *[e.id for e in STAR_ENTITIES], "date_id", "sale_quantity", "sale_total_price"
    )


def _measures():
    return [
        parse.permissive_int(F.col("sale_quantity")).alias("sale_quantity"),
        parse.permissive_double(F.col("sale_total_price")).alias("sale_total_price"),
    ]


def build(staging: DataFrame, dense: bool = False) -> dict[str, DataFrame]:
    """All seven tables as plans over ``staging``."""
    tables = dimensions(staging, dense)
    tables["fact_sales"] = fact_by_lookup(staging, tables) if dense else fact(staging)
    return tables
