"""Every query by name: ``(spark, sf_dir) -> DataFrame`` over the given tables.

As in the warehouse itself, the feed is written once per application and state of the folder as
a staging table, which the models read with column pruning, and marts and audits
read the models as tables. The queries that show the feed and its parsing read the
given tables directly. ``discard`` removes the written tables.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom import schema
from salesloom.functions import parse
from salesloom.jobs import loads
from salesloom.operators.keys import content_key, content_key_if_complete, key_by_place, packed, shown
from salesloom.plans import marts, quality, reports, snowflake, star
from salesloom.session import (
    file_state, materialize, remove_materialized, scratch_folder, side_by_side,
)
from salesloom.sources.csv_feed import read_csv_feed, read_csv_with_rejects, write_csv_feed
from salesloom.sources.retail import BROKEN, staging_feed
from salesloom.sources.tables import CatalogStore, FileStore, write_counted
from salesloom.sources.versions import VersionedStore

Query = Callable[[SparkSession, str], DataFrame]

# The given tables that the feed is derived from.
SOURCES = ("lineitem", "orders", "customer", "nation", "part", "supplier")

_STAGED: dict[tuple, object] = {}


def _kept(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """What ``make()`` has written, once per application and state of the input."""
    state = file_state(spark, [f"{sf_dir}/{t}.parquet" for t in SOURCES])
    key = (spark.sparkContext.applicationId, sf_dir, state, name)
    if key not in _STAGED:
        _STAGED[key] = make()
    return _STAGED[key]


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written to the shared folder."""
    return _kept(spark, sf_dir, name, lambda: materialize(build(), name))


def discard(spark: SparkSession) -> None:
    """Remove the tables that queries of this application have written to the shared folder."""
    application = spark.sparkContext.applicationId
    for key in [k for k in _STAGED if k[0] == application]:
        del _STAGED[key]
    remove_materialized(spark)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "staging", lambda: staging_feed(spark, sf_dir))


def broken_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with values that the declared types cannot store."""
    return _once(spark, sf_dir, "broken", lambda: staging_feed(spark, sf_dir, BROKEN))


Plans = Mapping[str, Callable[[], DataFrame]]


def _store(spark: SparkSession, sf_dir: str, kind: str, plans: Plans) -> dict[str, DataFrame]:
    """Each table planned and written once; what is read back, by name."""
    return side_by_side(spark, {
        name: lambda name=name, build=build: _once(spark, sf_dir, f"{kind}-{name}", build)
        for name, build in plans.items()
    })


def star_tables(spark: SparkSession, sf_dir: str, *dimensions: str) -> dict[str, DataFrame]:
    """The fact and the dimensions named, all of them by default, as tables."""
    feed = staging(spark, sf_dir)
    plans = {e.table: lambda e=e: star.dimension(feed, e) for e in schema.STAR_ENTITIES}
    plans["dim_date"] = lambda: star.date_dimension(feed)
    wanted = {name: plans[name] for name in dimensions or plans}
    return _store(spark, sf_dir, "content", {**wanted, "fact_sales": lambda: star.fact(feed)})


def stored_dimensions(spark: SparkSession, sf_dir: str, dense: bool = False) -> dict:
    """The thirteen snowflake dimensions as tables; each level reads the one before."""
    kind, feed = ("dense" if dense else "content"), staging(spark, sf_dir)
    subs = {
        s.table: lambda s=s: snowflake.sub_dimension(feed, s, dense)
        for s in snowflake.SUB_DIMENSIONS
    }
    subs["d_product_details"] = lambda: snowflake.product_details(feed, dense)
    subs["d_date"] = lambda: snowflake.date_dimension(feed, dense)
    stored = _store(spark, sf_dir, kind, subs)

    found = stored if dense else None
    dims = {
        d.table: lambda d=d: snowflake.dimension(feed, d, found, dense)
        for d in snowflake.DIMENSIONS
    }
    dims["d_product"] = lambda: snowflake.product(
        feed, stored["d_product_details"], found and stored["d_product_category"], dense
    )
    return stored | _store(spark, sf_dir, kind, dims)


def stored_snowflake(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The whole snowflake as tables, for audits that read each one often."""
    stored = stored_dimensions(spark, sf_dir)

    def sales() -> DataFrame:
        return snowflake.number_sales(unnumbered_sales(spark, sf_dir, stored))

    return stored | _store(spark, sf_dir, "content", {"f_sale": sales})


def unnumbered_sales(
    spark: SparkSession, sf_dir: str, stored: Mapping[str, DataFrame]
) -> DataFrame:
    """The fact without ids as a table: numbering reads it more than once."""
    return _once(
        spark, sf_dir, "unnumbered", lambda: snowflake.fact(staging(spark, sf_dir), stored)
    )


# --- feed and parsing ---------------------------------------------------------


def stg_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_feed(spark, sf_dir)


def parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = staging_feed(spark, sf_dir)
    numbers = ("customer_age", "product_quantity", "product_reviews", "sale_quantity")
    amounts = ("product_price", "product_weight", "product_rating", "sale_total_price")
    return feed.select(
        "id",
        *[parse.strict_int(F.col(c)).alias(c) for c in numbers],
        *[parse.strict_decimal(F.col(c)).alias(c) for c in amounts],
    )


def parse_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = staging_feed(spark, sf_dir)
    numbers = ("customer_age", "product_quantity", "product_reviews", "sale_quantity")
    amounts = ("product_price", "product_weight", "product_rating", "sale_total_price")
    return feed.select(
        "id",
        *[parse.permissive_int(F.col(c)).alias(c) for c in numbers],
        *[parse.permissive_double(F.col(c)).alias(c) for c in amounts],
    )


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = staging_feed(spark, sf_dir)
    sale = parse.permissive_date(F.col("sale_date"))
    return feed.select(
        "id",
        parse.strict_date(F.col("product_release_date")).alias("release_date"),
        parse.strict_date(F.col("product_expiry_date")).alias("expiry_date"),
        sale.alias("sale_date"),
        *[part.alias(name) for name, part in parse.date_parts(sale).items()],
    )


def null_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("customer_postal_code", "store_city", "store_location", "product_category")
    return staging_feed(spark, sf_dir).select(
        "id", *[parse.null_to_empty(F.col(c)).alias(c) for c in columns]
    )


# --- keys ---------------------------------------------------------------------


def hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of every customer key, in the dimension and in the fact."""
    key = [F.col(c) for c in schema.CUSTOMER.key]
    return staging(spark, sf_dir).select(*schema.CUSTOMER.key).distinct().select(
        *schema.CUSTOMER.key,
        content_key(*key).alias("dimension_id"),
        content_key_if_complete(*key).alias("fact_id"),
    )


def dense_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers numbered 1..n."""
    feed = staging(spark, sf_dir)
    return star.dimension(feed, schema.CUSTOMER, dense=True).select(
        "customer_id", *schema.CUSTOMER.key
    )


# --- models, marts, reports, audits ---------------------------------------------


# What each mart joins to the fact.
MART_DIMENSIONS = {
    "mart_product_sales": ("dim_product",),
    "mart_customer_sales": ("dim_customer",),
    "mart_time_sales": ("dim_date",),
    "mart_store_sales": ("dim_store",),
    "mart_supplier_sales": ("dim_supplier", "dim_product"),
    "mart_product_quality": ("dim_product",),
}


def _dimension(entity: schema.Entity) -> Query:
    return lambda spark, sf_dir: star.dimension(staging(spark, sf_dir), entity)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dimension(staging(spark, sf_dir))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact(staging(spark, sf_dir))


def fact_sales_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over dense ids, every id looked up."""
    feed = staging(spark, sf_dir)
    plans = {e.table: lambda e=e: star.dimension(feed, e, True) for e in schema.STAR_ENTITIES}
    plans["dim_date"] = lambda: star.date_dimension(feed, True)
    dense = _store(spark, sf_dir, "dense", plans)
    return star.fact_by_lookup(feed, dense)


def _sub_dimension(spec: snowflake.SubDimension) -> Query:
    return lambda spark, sf_dir: snowflake.sub_dimension(staging(spark, sf_dir), spec)


def _snow_dimension(spec: snowflake.Dimension) -> Query:
    return lambda spark, sf_dir: snowflake.dimension(staging(spark, sf_dir), spec)


def sub_product_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snowflake.product_details(staging(spark, sf_dir))


def snow_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snowflake.date_dimension(staging(spark, sf_dir))


def snow_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = staging(spark, sf_dir)
    return snowflake.product(feed, snowflake.product_details(feed))


def snow_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_dimensions(spark, sf_dir)
    return snowflake.number_sales(unnumbered_sales(spark, sf_dir, stored))


def snow_fact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over dense ids, every id looked up, without ``sale_id``."""
    dense = stored_dimensions(spark, sf_dir, dense=True)
    return snowflake.fact_by_lookup(staging(spark, sf_dir), dense)


def _snow_lookup(spec: snowflake.Dimension) -> Query:
    """A dimension and its sub-dimensions with dense ids, looked up."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = staging(spark, sf_dir)
        subs = {s.table: snowflake.sub_dimension(feed, s, dense=True) for s in spec.points_to}
        return snowflake.dimension(feed, spec, subs, dense=True)

    return query


def snow_product_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products, details and categories with dense ids, looked up."""
    feed = staging(spark, sf_dir)
    return snowflake.product(
        feed,
        snowflake.product_details(feed, dense=True),
        snowflake.sub_dimension(feed, snowflake.PRODUCT_CATEGORY, dense=True),
        dense=True,
    )


def _mart(name: str, report: Callable[[DataFrame], DataFrame] = lambda mart: mart) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = star_tables(spark, sf_dir, *MART_DIMENSIONS[name])
        return report(marts.MARTS[name](tables))

    return query


def _from_star(report: Callable[[dict[str, DataFrame]], DataFrame], *dimensions: str) -> Query:
    return lambda spark, sf_dir: report(star_tables(spark, sf_dir, *dimensions))


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.snowflake_duplicate_keys(stored_snowflake(spark, sf_dir))


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.snowflake_orphans(stored_snowflake(spark, sf_dir)).unionByName(
        quality.star_orphans(star_tables(spark, sf_dir))
    )


def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"raw_data": staging(spark, sf_dir), **stored_snowflake(spark, sf_dir)}
    return quality.row_counts(tables)


def dq_row_counts_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star_tables(spark, sf_dir)
    return quality.row_counts(
        {"staging": staging(spark, sf_dir), **tables, **marts.build(tables)}
    )


def audited_snowflake(
    spark: SparkSession, sf_dir: str, feed: DataFrame, kind: str
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The fourteen tables before declared types apply, and in them. Nothing raises: a value
    that cannot be stored is kept in the first for counting and is NULL in the second."""
    def level(plans: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return _store(spark, sf_dir, kind, {n: lambda df=df: df for n, df in plans.items()})

    raw = level(snowflake.sub_dimensions(feed, enforce=False))
    stored = {t: snowflake.as_stored(t, df) for t, df in raw.items()}
    entities = level(snowflake.dimensions(feed, stored, enforce=False))
    raw |= entities
    stored |= {t: snowflake.as_stored(t, df) for t, df in entities.items()}
    # Every id is looked up: a key that cannot be stored has no row to be found. Ids are content
    # keys here and travel with the sales as 16 bytes.
    pack = [c for t, c, _ in schema.SNOWFLAKE_REFERENCES if t == "f_sale"]
    raw |= level({"f_sale": snowflake.fact_by_lookup(feed, stored, enforce=False, pack=pack)})
    stored["f_sale"] = snowflake.as_stored("f_sale", raw["f_sale"])
    return raw, stored


def dq_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = audited_snowflake(spark, sf_dir, staging(spark, sf_dir), "audit")
    return quality.snowflake_contract(raw)


def dq_contract_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = audited_snowflake(spark, sf_dir, broken_staging(spark, sf_dir), "audit-broken")
    return quality.snowflake_contract(raw)


def dq_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = staging(spark, sf_dir)
    return quality.reconciliation(feed, audited_snowflake(spark, sf_dir, feed, "audit")[1])


def dq_reconciliation_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = broken_staging(spark, sf_dir)
    return quality.reconciliation(feed, audited_snowflake(spark, sf_dir, feed, "audit-broken")[1])


# --- later feeds ----------------------------------------------------------------


def _feed_no(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """The sales of even orders (0) or of odd ones (1): two feeds that share most keys and differ in
    what they say of them. Not the staging table: a load keeps its feed as one."""
    order = F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint")
    return staging_feed(spark, sf_dir).where(order % 2 == number)


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[VersionedStore, list[loads.Outcome]]:
    """Both feeds loaded one after the other: the snowflake with numbered ids, the star with hashed."""

    def make():
        store = VersionedStore(scratch_folder(spark, "versions"))
        return store, [
            loads.load_feed(spark, store, _feed_no(spark, sf_dir, n), f"feed {n}") for n in (0, 1)
        ]

    return _kept(spark, sf_dir, "loaded", make)


def _first_load(spark: SparkSession, store: VersionedStore, table: str) -> Column:
    """Was this row there after the first feed? Ids are numbers and the later ones follow."""
    before = store.read(spark, table, 1).agg(F.count(F.lit(1)).alias("n"))
    return (F.col(schema.primary_key(table)) <= before.scalar()).alias("first_load")


def load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the snowflake tables after one feed and after both, and the range of their ids."""
    store, _ = two_loads(spark, sf_dir)

    def line(table: str) -> DataFrame:
        id_ = schema.primary_key(table)
        before = store.read(spark, table, 1).agg(F.count(F.lit(1)).alias("rows_before"))
        after = store.read(spark, table).agg(
            F.count(F.lit(1)).alias("rows_after"),
            F.min(id_).alias("lowest_id"), F.max(id_).alias("highest_id"),
        )
        return after.select(
            F.lit(table).alias("table_name"), before.scalar().alias("rows_before"),
            "rows_after", "lowest_id", "highest_id",
        )

    return quality.union_all([line(t) for t in schema.SNOWFLAKE_COLUMNS])


def load_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their pets and locations, and whether the first feed brought them."""
    store, _ = two_loads(spark, sf_dir)
    customers = store.read(spark, "d_customer")
    joined = customers.join(store.read(spark, "d_customer_pet"), "pet_id").join(
        store.read(spark, "d_customer_location"), "location_id"
    )
    return joined.select(
        "first_name", "last_name", "age", "email", "pet_type", "pet_name", "pet_breed",
        "pet_category", "country", "postal_code", _first_load(spark, store, "d_customer"),
    )


def load_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with category and details, and whether the first feed brought them."""
    store, _ = two_loads(spark, sf_dir)
    joined = store.read(spark, "d_product").join(
        store.read(spark, "d_product_category"), "category_id"
    ).join(store.read(spark, "d_product_details"), "details_id")
    return joined.select(
        "name", "category_name", "price", "quantity", *snowflake.DETAILS,
        _first_load(spark, store, "d_product"),
    )


def load_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of both feeds with what their ids point to, and whether the first feed brought them."""
    store, _ = two_loads(spark, sf_dir)

    def named(table: str, **columns: str) -> DataFrame:
        return store.read(spark, table).select(
            schema.primary_key(table), *[F.col(c).alias(n) for n, c in columns.items()]
        )

    sales = store.read(spark, "f_sale")
    for dimension in (
        named("d_customer", customer_email="email"), named("d_seller", seller_email="email"),
        named("d_supplier", supplier_email="email"), named("d_date", full_date="full_date"),
        named("d_product", product_name="name", category_id="category_id", details_id="details_id"),
        named("d_product_category", category_name="category_name"),
        named("d_product_details", weight="weight", color="color"),
        named("d_store", store_name="name", location_id="location_id"),
        named("d_store_location", city="city", state="state", country="country"),
    ):
        sales = sales.join(dimension, dimension.columns[0])
    return sales.select(
        "sale_quantity", "sale_total_price", "customer_email", "seller_email", "supplier_email",
        "full_date", "product_name", "category_name", "weight", "color", "store_name", "city",
        "state", "country", _first_load(spark, store, "f_sale"),
    )


def _loaded_mart(name: str) -> Query:
    """A mart over both feeds, from the sums that each load has stored."""
    return lambda spark, sf_dir: loads.marts_of(two_loads(spark, sf_dir)[0], spark)[name]


def _with_outcome(
    spark: SparkSession, store: VersionedStore, outcome: loads.Outcome, tables: list[str]
) -> DataFrame:
    """The audit lines of a load beside the rows that readers of each table now see."""
    readable = quality.row_counts({t: store.read(spark, t) for t in tables})
    return outcome.report.join(
        readable.withColumnRenamed("row_count", "rows_readable"), "table_name"
    ).withColumn("published", F.lit(outcome.published))


def publish_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the second feed, which is published."""
    store, outcomes = two_loads(spark, sf_dir)
    return _with_outcome(
        spark, store, outcomes[1], [*schema.SNOWFLAKE_COLUMNS, *schema.STAR_TABLES]
    )


def publish_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a load that appends the second feed's customers without asking which are
    known, and its sales without the other dimensions: rejected, readers see the first feed."""
    store = VersionedStore(scratch_folder(spark, "versions"))
    loads.load_feed(spark, store, _feed_no(spark, sf_dir, 0), "feed 0", {"star": loads.add_to_star})
    feed, load = _feed_no(spark, sf_dir, 1), store.begin(spark)
    load.append(star.dimension(feed, schema.CUSTOMER), "dim_customer")
    load.append(star.fact(feed), "fact_sales")
    return _with_outcome(
        spark, store, loads.publish_if_clean(load, spark, "feed 1"), ["dim_customer", "fact_sales"]
    )


def sale_ids_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with ids numbered by where its rows were written, and what the ids amount to."""
    stored = stored_dimensions(spark, sf_dir)
    sales = unnumbered_sales(spark, sf_dir, stored)
    numbered = _once(spark, sf_dir, "placed", lambda: key_by_place(sales, "sale_id"))
    ids = numbered.agg(
        F.min("sale_id").alias("lowest_id"), F.max("sale_id").alias("highest_id"),
        F.count_distinct("sale_id").alias("different_ids"),
    )
    return numbered.drop("sale_id").select(
        "*", *[ids.select(c).scalar().alias(c) for c in ids.columns]
    )


# --- how tables lie -------------------------------------------------------------


def fact_sales_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over dense ids, looked up in dimensions that lie bucketed by their business keys."""
    feed = staging(spark, sf_dir)
    plans = {e.table: lambda e=e: star.dimension(feed, e, True) for e in schema.STAR_ENTITIES}
    plans["dim_date"] = lambda: star.date_dimension(feed, True)
    dense = _store(spark, sf_dir, "dense", plans)
    keys = {**{e.table: e.key for e in schema.STAR_ENTITIES}, "dim_date": ("full_date",)}

    def bucketed() -> dict[str, DataFrame]:
        store, mark = CatalogStore(), os.urandom(8).hex()
        for table, key in keys.items():
            name = f"{table}_{mark}"
            store.write_bucketed(dense[table], name, key, 8, scratch_folder(spark, name))
        return {table: store.read(spark, f"{table}_{mark}") for table in keys}

    return star.fact_by_lookup(feed, _kept(spark, sf_dir, "bucketed", bucketed))


REPLAYED = (1996, 5)


def _by_month(spark: SparkSession, sf_dir: str) -> FileStore:
    """The fact partitioned by month, one month of it then replaced from a corrected feed."""

    def make() -> FileStore:
        store, feed = FileStore(scratch_folder(spark, "by-month")), staging(spark, sf_dir)
        ids = list(schema.STAR_REFERENCES)
        store.write_partitioned(star.fact_by_month(feed), "fact_sales", star.MONTH, ids)
        corrected = star.fact_by_month(feed.withColumn("sale_quantity", F.lit("7"))).where(
            (F.col("sale_year") == REPLAYED[0]) & (F.col("sale_month") == REPLAYED[1])
        )
        store.replace_partitions(corrected, "fact_sales", star.MONTH, ids)
        return store

    return _kept(spark, sf_dir, "by-month", make)


def replay_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_month(spark, sf_dir).read(spark, "fact_sales")


def monthly_trend_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen months of the fact partitioned by month; the others are not read."""
    return star.sales_per_month(replay_month(spark, sf_dir), (1995, 11), (1997, 1))


def _packed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star tables with ids of 16 bytes."""
    return _store(spark, sf_dir, "packed", {
        name: lambda df=df: packed(df, list(schema.STAR_REFERENCES))
        for name, df in star_tables(spark, sf_dir).items()
    })


def fact_sales_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_packed(spark, sf_dir)["fact_sales"], list(schema.STAR_REFERENCES))


def mart_supplier_sales_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.supplier_sales(_packed(spark, sf_dir))


# --- sources and sinks ----------------------------------------------------------

# The feed as text is many times the size of its tables: it is delivered compressed, in files of
# some 100 MB of text each.
DELIVERED = {"compression": "gzip", "records_per_file": 250_000}


def io_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as delivered (CSV, line breaks and quotes inside fields) and read back."""
    folder = scratch_folder(spark, "csv")
    feed = staging(spark, sf_dir).withColumn("product_description", F.concat(
        "product_description", F.lit('\r\nsecond "line"\n'), "id"
    ))
    write_csv_feed(feed, folder, **DELIVERED)
    return read_csv_feed(spark, folder)


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed delivered beside files with too few and too many columns: sales read, with NULL, and
    records rejected, with the reason."""
    folder, feed = scratch_folder(spark, "csv"), staging(spark, sf_dir)
    order = F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint")
    for name, rows in (
        ("whole", feed),
        ("narrow", feed.where(order % 89 == 0).select(*feed.columns[:3])),
        ("wide", feed.where(order % 97 == 0).withColumn("more", F.lit("x"))),
    ):
        write_csv_feed(rows, f"{folder}/{name}", **DELIVERED)
    good, bad = read_csv_with_rejects(spark, [f"{folder}/{n}" for n in ("whole", "narrow", "wide")])
    return good.select("id", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.split_part("text", F.lit(","), F.lit(1)).alias("id"), "reason")
    )


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.parse_rejects(broken_staging(spark, sf_dir), "id")


def io_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice and counted: the second write replaces the first."""
    store, dates = FileStore(scratch_folder(spark, "store")), dim_date(spark, sf_dir)
    write_counted(store, dates.limit(1), "dim_date")
    rows = write_counted(store, dates, "dim_date")
    return store.read(spark, "dim_date").withColumn("written", F.lit(rows).cast("bigint"))


def io_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created twice, the second time without effect, then filled by two appends."""
    name = f"dates_{os.urandom(8).hex()}"
    store, dates = CatalogStore(), dim_date(spark, sf_dir)
    store.create_if_absent(spark, name, dates.schema)
    store.append(dates.where("quarter <= 2"), name)
    store.create_if_absent(spark, name, dates.schema)
    store.append(dates.where("quarter > 2 OR quarter IS NULL"), name)
    return store.read(spark, name)


def dq_parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.parse_failures(staging(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "stg_rows": stg_rows,
    "parse_strict": parse_strict,
    "parse_permissive": parse_permissive,
    "parse_dates": parse_dates,
    "null_to_empty": null_to_empty,
    "hash_key": hash_key,
    "dense_key": dense_key,
    "sub_customer_location": _sub_dimension(snowflake.CUSTOMER_LOCATION),
    "sub_customer_pet": _sub_dimension(snowflake.CUSTOMER_PET),
    "sub_seller_location": _sub_dimension(snowflake.SELLER_LOCATION),
    "sub_store_location": _sub_dimension(snowflake.STORE_LOCATION),
    "sub_supplier_location": _sub_dimension(snowflake.SUPPLIER_LOCATION),
    "sub_product_category": _sub_dimension(snowflake.PRODUCT_CATEGORY),
    "sub_product_details": sub_product_details,
    "snow_date": snow_date,
    "snow_customer": _snow_dimension(snowflake.CUSTOMER),
    "snow_seller": _snow_dimension(snowflake.SELLER),
    "snow_product": snow_product,
    "snow_store": _snow_dimension(snowflake.STORE),
    "snow_supplier": _snow_dimension(snowflake.SUPPLIER),
    "snow_fact": snow_fact,
    "snow_fact_lookup": snow_fact_lookup,
    "snow_customer_lookup": _snow_lookup(snowflake.CUSTOMER),
    "snow_seller_lookup": _snow_lookup(snowflake.SELLER),
    "snow_store_lookup": _snow_lookup(snowflake.STORE),
    "snow_supplier_lookup": _snow_lookup(snowflake.SUPPLIER),
    "snow_product_lookup": snow_product_lookup,
    "dim_customer": _dimension(schema.CUSTOMER),
    "dim_seller": _dimension(schema.SELLER),
    "dim_product": _dimension(schema.PRODUCT),
    "dim_store": _dimension(schema.STORE),
    "dim_supplier": _dimension(schema.SUPPLIER),
    "dim_date": dim_date,
    "fact_sales": fact_sales,
    "fact_sales_lookup": fact_sales_lookup,
    "mart_product_sales": _mart("mart_product_sales"),
    "mart_customer_sales": _mart("mart_customer_sales"),
    "mart_time_sales": _mart("mart_time_sales"),
    "mart_store_sales": _mart("mart_store_sales"),
    "mart_supplier_sales": _mart("mart_supplier_sales"),
    "mart_product_quality": _mart("mart_product_quality"),
    "top_products": _mart("mart_product_sales", reports.top_products),
    "revenue_by_category": _mart("mart_product_sales", reports.revenue_by_category),
    "avg_rating_by_product": _mart("mart_product_sales", reports.avg_rating_by_product),
    "top_customers": _mart("mart_customer_sales", reports.top_customers),
    "customers_by_country": _mart("mart_customer_sales", reports.customers_by_country),
    "monthly_trend": _mart("mart_time_sales", reports.monthly_trend),
    "yearly_trend": _from_star(reports.yearly_trend, "dim_date"),
    "avg_order_by_month": _mart("mart_time_sales", reports.avg_order_by_month),
    "top_stores": _mart("mart_store_sales", reports.top_stores),
    "stores_by_city": _from_star(lambda t: reports.stores_by(t, "store_city"), "dim_store"),
    "stores_by_country": _from_star(lambda t: reports.stores_by(t, "store_country"), "dim_store"),
    "top_suppliers": _mart("mart_supplier_sales", reports.top_suppliers),
    "suppliers_by_country": _from_star(
        reports.suppliers_by_country, "dim_supplier", "dim_product"
    ),
    "rating_sales_corr": _mart("mart_product_quality", reports.rating_sales_correlation),
    "most_reviewed": _mart("mart_product_quality", reports.most_reviewed),
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_orphans": dq_orphans,
    "dq_row_counts": dq_row_counts,
    "dq_row_counts_star": dq_row_counts_star,
    "dq_contract": dq_contract,
    "dq_contract_broken": dq_contract_broken,
    "dq_reconciliation": dq_reconciliation,
    "dq_reconciliation_broken": dq_reconciliation_broken,
    "io_csv": io_csv,
    "io_overwrite": io_overwrite,
    "io_append": io_append,
    "dq_parse_failures": dq_parse_failures,
    "load_row_counts": load_row_counts,
    "load_customers": load_customers,
    "load_products": load_products,
    "load_sales": load_sales,
    "load_mart_product_sales": _loaded_mart("mart_product_sales"),
    "load_mart_customer_sales": _loaded_mart("mart_customer_sales"),
    "load_mart_supplier_sales": _loaded_mart("mart_supplier_sales"),
    "load_mart_time_sales": _loaded_mart("mart_time_sales"),
    "publish_clean": publish_clean,
    "publish_broken": publish_broken,
    "sale_ids_by_place": sale_ids_by_place,
    "fact_sales_bucketed": fact_sales_bucketed,
    "replay_month": replay_month,
    "monthly_trend_range": monthly_trend_range,
    "fact_sales_packed": fact_sales_packed,
    "mart_supplier_sales_packed": mart_supplier_sales_packed,
    "csv_rejects": csv_rejects,
    "parse_rejects": parse_rejects,
}
