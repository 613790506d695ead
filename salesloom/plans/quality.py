"""Audits: keys, references, row counts, declared types, lost sales, unreadable text.

Each report is small (one row per table, column or dimension). Tables are reduced
per key before anything is joined, so a hot key is one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from salesloom import schema
from salesloom.functions import measures, parse
from salesloom.operators.contract import contract_report
from salesloom.plans import snowflake

Tables = Mapping[str, DataFrame]


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- key uniqueness -----------------------------------------------------------

# Columns that should identify a row of a snowflake table, beside its surrogate id.
BUSINESS_KEYS = {
    "d_date": ("full_date",),
    "d_customer": ("first_name", "last_name", "email"),
    "d_seller": ("first_name", "last_name", "email"),
    "d_product": ("name", "category_id"),
    "d_store": ("name", "location_id"),
    "d_supplier": ("name", "email"),
}


def duplicate_keys(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows, rows with a NULL key part, and keys held by more than one row."""
    incomplete = reduce(or_, [F.col(c).isNull() for c in key])
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(incomplete, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(~incomplete & (F.col("n") > 1)).alias("duplicate_keys"),
    ).select(
        F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
        "row_count", "null_key_rows", "duplicate_keys",
    )


def snowflake_duplicate_keys(tables: Tables) -> DataFrame:
    """Surrogate ids of all fourteen tables, then the business keys."""
    surrogate = [duplicate_keys(df, t, [schema.primary_key(t)]) for t, df in tables.items()]
    business = [duplicate_keys(tables[t], t, key) for t, key in BUSINESS_KEYS.items()]
    return union_all(surrogate + business)


# --- referential integrity ----------------------------------------------------


def orphans(child: DataFrame, table: str, id_column: str, parent: DataFrame,
            parent_table: str, parent_key: str) -> DataFrame:
    """Rows whose id has no parent row, and rows without an id."""
    per_id = child.groupBy(id_column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    checked = per_id.join(known, F.col(id_column) == F.col("_parent"), "left")
    has_id, found = F.col(id_column).isNotNull(), F.col("_parent").isNotNull()

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return checked.agg(
        rows(~has_id).alias("rows_without_id"), rows(has_id & ~found).alias("orphan_rows")
    ).select(
        F.lit(table).alias("table_name"), F.lit(id_column).alias("column_name"),
        F.lit(parent_table).alias("parent_table"), "rows_without_id", "orphan_rows",
    )


def orphan_rows(child: DataFrame, id_column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The orphan rows themselves."""
    known = parent.select(F.col(parent_key).alias(id_column))
    return child.filter(F.col(id_column).isNotNull()).join(known, id_column, "left_anti")


def snowflake_orphans(tables: Tables) -> DataFrame:
    return union_all([
        orphans(tables[t], t, c, tables[parent], parent, schema.primary_key(parent))
        for t, c, parent in schema.SNOWFLAKE_REFERENCES
    ])


def star_orphans(tables: Tables) -> DataFrame:
    return union_all([
        orphans(tables["fact_sales"], "fact_sales", c, tables[parent], parent, c)
        for c, parent in schema.STAR_REFERENCES.items()
    ])


# --- what a load adds -----------------------------------------------------------

# Layout of the lines below; ``violations`` counts keys held twice, or rows without a parent.
VIOLATIONS = (
    "rule string, table_name string, column_names string, parent_table string, violations bigint"
)


def _violation(rule: str, table: str, columns: str, parent: str, counted: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
        F.lit(columns).alias("column_names"), F.lit(parent).alias("parent_table"),
        counted.cast("bigint").alias("violations"),
    ]


def added_duplicates(
    added: DataFrame, before: DataFrame | None, table: str, key: Sequence[str]
) -> DataFrame:
    """Keys that added rows hold more than once, hold beside published rows, or leave NULL.

    Published rows are read in the key's range of the added ones only: numbers that follow the highest
    one skip all of them by file statistics.
    """
    per_key = added.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    incomplete = reduce(or_, [F.col(c).isNull() for c in key])
    held = F.lit(False)
    if before is not None:
        lowest = added.agg(*[F.min(c).alias(c) for c in key[:1]]).first()[0]
        old = before.select(*key)
        if lowest is not None:
            old = old.where(F.col(key[0]) >= F.lit(lowest))
        old = old.distinct().withColumn("_old", F.lit(True))
        per_key, held = per_key.join(old, list(key), "left"), F.coalesce("_old", F.lit(False))
    return per_key.agg(
        F.count_if(incomplete | (F.col("n") > 1) | held).alias("bad")
    ).select(*_violation("unique", table, ",".join(key), "", F.col("bad")))


def added_orphans(
    child: DataFrame, table: str, column: str, parent: DataFrame | None, parent_table: str,
    parent_key: str,
) -> DataFrame:
    """Rows whose id has no parent row; a missing table has none."""
    per_id = child.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    if parent is not None:
        known = parent.select(F.col(parent_key).alias(column))
        per_id = per_id.join(known, column, "left_anti")
    return per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad")).select(
        *_violation("reference", table, column, parent_table, F.col("bad"))
    )


# --- row counts ---------------------------------------------------------------


def row_counts(tables: Tables) -> DataFrame:
    """One row per table. On stored parquet the counts come from file footers."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ])


# --- declared types -----------------------------------------------------------


def snowflake_contract(tables: Tables) -> DataFrame:
    """Values that break or are rounded by their declared type, per column.

    ``tables`` must be built with ``enforce=False``: enforcing raises at the first
    value that does not fit and leaves nothing to count.
    """
    return union_all([
        contract_report(df, t, {
            c: d for c, d in schema.SNOWFLAKE_COLUMNS[t].items() if c in df.columns
        })
        for t, df in tables.items()
    ])


# --- fact reconciliation ------------------------------------------------------


def _matches(staging: DataFrame, dimension: DataFrame, name: str,
             on: dict[str, Column]) -> DataFrame:
    """How the staged sales meet one dimension; ``on`` is dimension column -> feed value."""
    sales = staging.select(*[value.alias(c) for c, value in on.items()])
    sales = sales.groupBy(*on).agg(F.count(F.lit(1)).alias("sales"))
    held = dimension.groupBy(*on).agg(F.count(F.lit(1)).alias("held"))
    found = F.coalesce(F.col("held"), F.lit(0))

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("sales"))), F.lit(0))

    return sales.join(held, list(on), "left").agg(
        rows(F.lit(True)).alias("staged_sales"),
        rows(found == 0).alias("unmatched_sales"),
        rows(found > 1).alias("multiplied_sales"),
        F.coalesce(F.sum(F.col("sales") * found), F.lit(0)).alias("sales_after"),
    ).select(
        F.lit(name).alias("dimension"),
        "staged_sales", "unmatched_sales", "multiplied_sales", "sales_after",
    )


def reconciliation(staging: DataFrame, tables: Tables) -> DataFrame:
    """Why ``f_sale`` has more or fewer rows than were staged.

    Per dimension, taken alone: staged sales that find no row, that find several,
    and the rows that would remain. The line ``f_sale`` is the net result. Works on
    content keys.
    """
    category = snowflake.PRODUCT_CATEGORY.key_of_row()
    location = snowflake.STORE_LOCATION.key_of_row()
    keys = {
        "d_customer": {
            "first_name": F.col("customer_first_name"),
            "last_name": F.col("customer_last_name"), "email": F.col("customer_email"),
        },
        "d_seller": {
            "first_name": F.col("seller_first_name"),
            "last_name": F.col("seller_last_name"), "email": F.col("seller_email"),
        },
        "d_product": {"name": F.col("product_name"), "category_id": category},
        "d_store": {"name": F.col("store_name"), "location_id": location},
        "d_supplier": {"name": F.col("supplier_name"), "email": F.col("supplier_email")},
        "d_date": {"full_date": parse.permissive_date(F.col("sale_date"))},
    }
    lines = [_matches(staging, tables[t], t, on) for t, on in keys.items()]
    staged = staging.agg(F.count(F.lit(1)).alias("staged_sales"))
    stored = tables["f_sale"].agg(F.count(F.lit(1)).alias("sales_after"))
    unknown = F.lit(None).cast("bigint")
    net = staged.select(
        F.lit("f_sale").alias("dimension"), "staged_sales",
        unknown.alias("unmatched_sales"), unknown.alias("multiplied_sales"),
        stored.scalar().alias("sales_after"),
    )
    return union_all([*lines, net])


# --- unreadable text ----------------------------------------------------------

# The typed feed columns and the type each model reads them as.
STRICT_COLUMNS = {
    "customer_age": "int", "product_price": "decimal", "product_quantity": "int",
    "product_weight": "decimal", "product_rating": "decimal", "product_reviews": "int",
    "product_release_date": "date", "product_expiry_date": "date",
    "sale_date": "date", "sale_quantity": "int", "sale_total_price": "decimal",
}
PERMISSIVE_COLUMNS = {
    "customer_age": "int", "product_price": "double", "product_quantity": "int",
    "product_weight": "double", "product_rating": "double", "product_reviews": "int",
    "sale_date": "date", "sale_quantity": "int", "sale_total_price": "double",
}


def parse_failures(staging: DataFrame) -> DataFrame:
    """Per typed column and rule: filled texts, those read as NULL, those that raise.

    ``inexact`` counts doubles a total cannot add as decimals without change (NaN,
    infinity, too large, or more than ten decimals), and strict decimals with digits behind the
    eighteenth. One pass over the staging rows.
    """

    def line(rule: str, name: str, kind: str) -> Column:
        text = F.col(name)
        inexact = F.lit(False)
        if rule == "strict":
            unreadable, raises = parse.strict_outcome(text, kind)
            if kind == "decimal":
                inexact = parse.is_filled(text) & (parse.beyond_scale(text) != "")
        else:
            value = parse.PERMISSIVE[kind](text)
            unreadable, raises = parse.is_filled(text) & value.isNull(), F.lit(False)
            if kind == "double":
                inexact = value.isNotNull() & measures.exactly(value).isNull()
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("read_as"),
            F.count_if(parse.is_filled(text)).alias("filled"),
            F.count_if(unreadable).alias("unreadable"),
            F.count_if(raises).alias("raises"),
            F.count_if(inexact).alias("inexact"),
        )

    lines = [line("strict", n, k) for n, k in STRICT_COLUMNS.items()]
    lines += [line("permissive", n, k) for n, k in PERMISSIVE_COLUMNS.items()]
    return staging.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))


def parse_rejects(staging: DataFrame, *place: str) -> DataFrame:
    """(place, rule, column_name, text, raises) of every text that ``parse_failures`` counts as
    unreadable or raising; ``place`` names the columns that tell which row it was.

    One pass, and rows without such a text give none.
    """

    def line(rule: str, name: str, kind: str) -> Column:
        text = F.col(name)
        if rule == "strict":
            unreadable, raises = parse.strict_outcome(text, kind)
        else:
            unreadable = parse.is_filled(text) & parse.PERMISSIVE[kind](text).isNull()
            raises = F.lit(False)
        unreadable, raises = (F.coalesce(c, F.lit(False)) for c in (unreadable, raises))
        found = F.struct(
            F.lit(rule).alias("rule"), F.lit(name).alias("column_name"), text.alias("text"),
            raises.alias("raises"),
        )
        return F.when(unreadable | raises, found)

    lines = [line("strict", n, k) for n, k in STRICT_COLUMNS.items()]
    lines += [line("permissive", n, k) for n, k in PERMISSIVE_COLUMNS.items()]
    rejects = F.explode(F.array_compact(F.array(*lines))).alias("_reject")
    return staging.select(*place, rejects).select(*place, "_reject.*")
