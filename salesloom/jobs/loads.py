"""Later feeds: add one to loaded tables, audit what it adds, publish only if that is clean.

A load is written aside (``sources.versions``) and becomes visible as a whole or not at all. A
feed has a name; one that was loaded before is not loaded again, so a failed run is simply run
again.

Rules of a later feed:

- A business key that is known keeps its row and its id: the first feed that describes a key
  decides, within a feed the smallest description (``dedup``). Only keys that are new are written.
- New ids follow the highest one of their table (``dense``, the default), or are content keys.
- Sales are resolved against all rows loaded so far, their own feed's included, and appended;
  sales loaded before are not resolved again.
- A product that is known stays with the details it found when it was new.

With numbered ids each row of a dimension also holds its content key (``content_key``). It is what new
rows are told from known ones by, and what ids of parent tables are looked up in. One folder of
tables is loaded with one kind of ids.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from salesloom import schema
from salesloom.functions import parse
from salesloom.jobs.warehouse import STAGING
from salesloom.operators.dedup import settled
from salesloom.operators.keys import content_key, key_by_place
from salesloom.operators.lookup import lookup
from salesloom.operators.merge import numbered_after, unknown
from salesloom.plans import marts, quality, snowflake, star
from salesloom.session import materialize, remove_folder, scratch_folder, side_by_side, writing
from salesloom.sources.versions import Load, VersionedStore

PRODUCT_KEYS = "keys_of_products"  # products that were described, whether they found details or not
STATES = marts.STATES
REJECTS = "rejects"
KEY = "content_key"


def _known(load: Load, spark: SparkSession, table: str, id_column: str) -> DataFrame | None:
    """(key, id) of the rows of a table so far, this load's included."""
    if not load.has(table):
        return None
    held = load.read(spark, table)
    key = KEY if KEY in held.columns else id_column
    return held.select(F.col(key).alias("key"), F.col(id_column).alias("id"))


def merge_table(
    load: Load, spark: SparkSession, table: str, found: DataFrame, id_column: str, dense: bool,
    parents: Mapping[str, str] | None = None,
) -> None:
    """Append the rows of ``found`` whose content key (in ``id_column``) is not known.

    ``parents`` names the parent table of each column that holds a parent's content key; with dense
    ids it is replaced by the parent's id.
    """
    columns = found.columns
    known = _known(load, spark, table, id_column)
    if known is not None and (known.schema["id"].dataType == T.StringType()) == dense:
        raise ValueError(f"{table} was loaded with the other kind of ids")
    fresh = unknown(found.withColumnRenamed(id_column, KEY), KEY, known)
    if not dense:
        load.append(fresh.withColumnRenamed(KEY, id_column).select(*columns), table)
        return
    numbered = numbered_after(fresh, KEY, id_column, known)
    for column, parent in (parents or {}).items():
        ids = _known(load, spark, parent, schema.primary_key(parent))
        numbered = lookup(
            numbered.withColumnRenamed(column, "_parent"), ids, {"_parent": "key"}, ["id"], "inner",
        ).withColumnRenamed("id", column).drop("_parent")
    load.append(numbered.select(*columns, KEY), table)


def _append_numbered(load: Load, spark: SparkSession, sales: DataFrame) -> None:
    """Append sales with ids after the highest one, numbered by where they were written."""
    held = load.read(spark, "f_sale").agg(F.max("sale_id")).first()[0] if load.has("f_sale") else 0
    folder = scratch_folder(spark, "unnumbered")
    with writing(spark):
        sales.write.parquet(folder)
    load.append(key_by_place(spark.read.parquet(folder), "sale_id", held or 0), "f_sale")
    remove_folder(spark, folder)


def _variants(load: Load, feed: DataFrame, entity: schema.Entity) -> DataFrame:
    """The different descriptions of an entity in a feed: all that its dimensions and
    sub-dimensions of either model are made from."""
    columns = [*entity.key, *entity.payload]
    return load.aside(
        feed, f"variants-{entity.table}", lambda: feed.select(*columns).distinct()
    )


def _winners(load: Load, feed: DataFrame, entity: schema.Entity) -> DataFrame:
    """Per business key the smallest description (``dedup``): ``_delivered`` as the star picks it,
    ``_emptied`` as the snowflake does, with NULL as '' where that stores it so."""
    emptied = next((d.emptied for d in snowflake.DIMENSIONS if d.entity == entity), ())

    def make() -> DataFrame:
        payload = [
            parse.null_to_empty(F.col(c)).alias(c) if c in emptied else F.col(c)
            for c in entity.payload
        ]
        return settled(_variants(load, feed, entity), *entity.key).groupBy(*entity.key).agg(
            F.min(F.struct(*entity.payload)).alias("_delivered"),
            F.min(F.struct(*payload)).alias("_emptied"),
        )

    return load.aside(feed, f"winners-{entity.table}", make)


def _picked(load: Load, feed: DataFrame, entity: schema.Entity, winner: str) -> DataFrame:
    """One row per business key as delivered, in the columns of the feed. A model that makes one key
    of several still takes the smallest of these: it is the smallest of all their rows."""
    return _winners(load, feed, entity).select(*entity.key, f"{winner}.*")


def _dates(load: Load, feed: DataFrame) -> DataFrame:
    return load.aside(feed, "dates", lambda: feed.select("sale_date").distinct())


def _describe(load: Load, spark: SparkSession, feed: DataFrame) -> None:
    """Write aside what the dimensions of both models are made from, entity by entity: the sales
    are read and shuffled for it once per load."""
    side_by_side(spark, {
        e.table: lambda e=e: _winners(load, feed, e) for e in schema.STAR_ENTITIES
    } | {"dates": lambda: _dates(load, feed)})


# The entity whose descriptions hold the columns of each sub-dimension.
_SUBS_OF = (
    *[(d.entity, d.points_to) for d in snowflake.DIMENSIONS],
    (schema.PRODUCT, (snowflake.PRODUCT_CATEGORY,)),
)


def _sub_dimensions(load: Load, feed: DataFrame) -> dict[str, DataFrame]:
    tables = {
        s.table: snowflake.sub_dimension(_variants(load, feed, entity), s)
        for entity, subs in _SUBS_OF for s in subs
    }
    tables["d_product_details"] = snowflake.product_details(_variants(load, feed, schema.PRODUCT))
    tables["d_date"] = snowflake.date_dimension(_dates(load, feed))
    return tables


def add_to_snowflake(
    load: Load, spark: SparkSession, feed: DataFrame, dense: bool = True
) -> None:
    """Merge a feed into the fourteen snowflake tables of a load, level by level."""
    parents = {
        t: {c: p for child, c, p in schema.SNOWFLAKE_REFERENCES if child == t}
        for t in schema.SNOWFLAKE_COLUMNS
    }

    def merge(found: Mapping[str, DataFrame]) -> None:
        side_by_side(spark, {
            t: lambda t=t, df=df: merge_table(
                load, spark, t, df, schema.primary_key(t), dense, parents[t]
            )
            for t, df in found.items()
        })

    _describe(load, spark, feed)
    merge(_sub_dimensions(load, feed))
    delivered = _picked(load, feed, schema.PRODUCT, "_delivered")
    product_key = content_key(*[F.col(c) for c in schema.PRODUCT.key])
    described = load.read(spark, PRODUCT_KEYS) if load.has(PRODUCT_KEYS) else None
    products = load.aside(feed, "new-products", lambda: unknown(
        delivered.withColumn("key", product_key), "key", described
    ))
    details = load.read(spark, "d_product_details")
    if dense:
        details = details.drop("details_id").withColumnRenamed(KEY, "details_id")
    found = {
        d.table: snowflake.dimension(_picked(load, feed, d.entity, "_emptied"), d)
        for d in snowflake.DIMENSIONS
    }
    found["d_product"] = snowflake.product(products.drop("key"), details)
    merge(found)
    load.append(products.select("key"), PRODUCT_KEYS)

    stored = {t: load.read(spark, t) for t in schema.SNOWFLAKE_COLUMNS if t != "f_sale"}
    resolve = snowflake.fact_by_lookup if dense else snowflake.fact
    _append_numbered(load, spark, resolve(feed, stored))


def add_to_star(load: Load, spark: SparkSession, feed: DataFrame, dense: bool = False) -> None:
    """Merge a feed into the star tables of a load, and its sums into the state of the marts."""
    _describe(load, spark, feed)
    found = {
        e.table: star.dimension(_picked(load, feed, e, "_delivered"), e)
        for e in schema.STAR_ENTITIES
    }
    found["dim_date"] = star.date_dimension(_dates(load, feed))
    ids = {**{e.table: e.id for e in schema.STAR_ENTITIES}, "dim_date": "date_id"}
    side_by_side(spark, {
        t: lambda t=t, df=df: merge_table(load, spark, t, df, ids[t], dense)
        for t, df in found.items()
    })
    if dense:
        sales = star.fact_by_lookup(feed, {t: load.read(spark, t) for t in ids})
    else:
        sales = star.fact(feed)
    load.append(sales, "fact_sales")
    add_to_states(load, spark)


def add_to_states(load: Load, spark: SparkSession) -> None:
    """Append the partial sums of the sales that this load has added; old sales are not read."""
    new = load.added("fact_sales")
    side_by_side(spark, {
        name: lambda name=name, ids=ids: load.append(marts.sales_per(new, *ids), name)
        for name, ids in STATES.items() if name != marts.PRICED
    } | {marts.PRICED: lambda: _add_priced(load, spark)})


def _add_priced(load: Load, spark: SparkSession) -> None:
    """The same with the list prices of the products sold. All sales are summed anew if prices were
    replaced, or if older sales were loaded without this state."""
    whole = not load.has(marts.PRICED) or load.replaced("dim_product")
    sales = load.read(spark, "fact_sales") if whole else load.added("fact_sales")
    sums = marts.priced_sales(sales, load.read(spark, "dim_product"))
    (load.write if whole else load.append)(sums, marts.PRICED)


def compact_states(load: Load, spark: SparkSession) -> None:
    """One row per id again where several loads have appended theirs."""
    side_by_side(spark, {
        name: lambda name=name, ids=ids: load.write(
            marts.merged_sales(load.read(spark, name), *ids), name
        )
        for name, ids in STATES.items() if len(load.tables.get(name, ())) > 1
    })


def marts_of(store: VersionedStore | Load, spark: SparkSession) -> dict[str, DataFrame]:
    """The six marts from the stored sums and the dimensions: no sale is read, unless a state is
    missing because sales were loaded before there was one."""
    held = store.tables if isinstance(store, Load) else store.contents(spark)["tables"]
    states = [t for t in STATES if t in held]
    names = [t for t in schema.STAR_TABLES if t != "fact_sales" or len(states) < len(STATES)]
    return marts.build({t: store.read(spark, t) for t in [*names, *states]})


# --- audit and publication -------------------------------------------------------------

# Keys that each model declares, beside the ids of its tables.
UNIQUE = {"d_date": ("full_date",)}


def rules(load: Load) -> tuple[dict[str, tuple[str, ...]], list[tuple[str, str, str, str]]]:
    """Keys by table, and (table, column, parent, parent key), of the tables that are loaded."""
    ids = {t: schema.primary_key(t) for t in schema.SNOWFLAKE_COLUMNS}
    ids |= {**{e.table: e.id for e in schema.STAR_ENTITIES}, "dim_date": "date_id"}
    references = [(t, c, p, schema.primary_key(p)) for t, c, p in schema.SNOWFLAKE_REFERENCES]
    references += [("fact_sales", c, p, c) for c, p in schema.STAR_REFERENCES.items()]
    return (
        {t: (c,) for t, c in ids.items() if load.has(t)},
        [r for r in references if load.has(r[0])],
    )


@dataclass(frozen=True)
class Outcome:
    """``version`` is None if the load was rejected; ``report`` has a line per rule."""

    version: int | None
    report: DataFrame

    @property
    def published(self) -> bool:
        return self.version is not None


def publish_if_clean(load: Load, spark: SparkSession, *feeds: str) -> Outcome:
    """Audit what a load adds and make it visible, or delete it and say what was wrong.

    Only what the load can have broken is looked at: its own rows against each other, against the
    published ones and against their parents. If a table's published rows were replaced, rows that
    point to it are looked at as well.
    """
    if load.replaced("dim_product") and load.has(marts.PRICED) and marts.PRICED not in load.written:
        _add_priced(load, spark)
    keys, references = rules(load)
    lines = []
    for table, key in [*keys.items(), *[(t, k) for t, k in UNIQUE.items() if t in keys]]:
        added = load.added(table)
        if added is not None:
            before = None if load.replaced(table) else load.before(table)
            lines.append(quality.added_duplicates(added, before, table, key))
    for table, column, parent, parent_key in references:
        child = load.read(spark, table) if load.replaced(parent) else load.added(table)
        if child is not None:
            known = load.read(spark, parent) if load.has(parent) else None
            lines.append(quality.added_orphans(child, table, column, known, parent, parent_key))
    if not lines:
        return Outcome(load.publish(*feeds), spark.createDataFrame([], quality.VIOLATIONS))
    report = materialize(quality.union_all(lines), "load-audit")
    if report.where("violations > 0").take(1):
        load.abandon()
        return Outcome(None, report)
    return Outcome(load.publish(*feeds), report)


def load_feed(
    spark: SparkSession, store: VersionedStore, feed: DataFrame, name: str,
    models: Mapping[str, Callable[[Load, SparkSession, DataFrame], None]] | None = None,
    rejects: DataFrame | None = None,
) -> Outcome | None:
    """Add a named feed to both models (or those given) and publish; None if it was loaded before.

    The feed is read once: its rows are kept as staging rows, from which the models are made.
    ``rejects``, what its reader could not read, is kept beside them under the feed's name.
    """
    load = store.begin(spark)
    if name in load.base["feeds"]:
        return None
    try:
        load.append(feed.select(*schema.STAGING_COLUMNS), STAGING)
        if rejects is not None:
            load.append(rejects.withColumn("feed", F.lit(name)), REJECTS)
        kept = load.added(STAGING)
        for add in (models or {"snowflake": add_to_snowflake, "star": add_to_star}).values():
            add(load, spark, kept)
        load.clear()
        return publish_if_clean(load, spark, name)
    except BaseException:
        load.abandon()
        raise
