"""The batch jobs, from delivered files to marts.

Each job reads one store and writes another, table by table, and returns the row
counts it wrote. Jobs overwrite, so a failed run is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from salesloom import schema
from salesloom.operators.keys import key_by_place, packed
from salesloom.plans import marts, snowflake, star
from salesloom.session import materialize, remove_folder, scratch_folder, side_by_side
from salesloom.sources.csv_feed import read_csv_feed
from salesloom.sources.tables import FileStore, JdbcStore, Store, write_counted

STAGING = "staging"


def _write_all(
    spark: SparkSession, target: Store, plans: Mapping[str, Callable[[], DataFrame]]
) -> dict[str, int]:
    """Write independent tables; their row counts."""

    def write(name: str) -> Callable[[], int]:
        return lambda: write_counted(target, plans[name](), name)

    return side_by_side(spark, {name: write(name) for name in plans})


def read_staging(spark: SparkSession, source: Store, table: str = STAGING) -> DataFrame:
    """The staged feed. A database is read once, into the shared folder: every table
    of a model reads the feed again."""
    feed = source.read(spark, table).select(*schema.STAGING_COLUMNS)
    return materialize(feed, STAGING) if isinstance(source, JdbcStore) else feed


def ingest(spark: SparkSession, paths: str | Sequence[str], target: Store) -> dict[str, int]:
    """CSV files to the staging table."""
    return {STAGING: write_counted(target, read_csv_feed(spark, paths), STAGING)}


def build_snowflake(
    spark: SparkSession, source: Store, target: Store, dense: bool = False,
    repeatable: bool = False,
) -> dict[str, int]:
    """Staging to the fourteen snowflake tables.

    Each level reads the one before it as written, so nothing is computed twice and
    ids are those on disk. Sales are numbered by where their rows were written, without
    moving them; ``repeatable`` numbers them by their values instead, which a second run over the
    same feed repeats, for one shuffle of the fact.
    """
    feed = read_staging(spark, source)
    level = snowflake.sub_dimensions(feed, dense)
    counts = _write_all(spark, target, {n: lambda df=df: df for n, df in level.items()})
    stored = {n: target.read(spark, n) for n in counts}

    level = snowflake.dimensions(feed, stored, dense)
    counts |= _write_all(spark, target, {n: lambda df=df: df for n, df in level.items()})
    stored = {n: target.read(spark, n) for n in counts}

    resolve = snowflake.fact_by_lookup if dense else snowflake.fact
    sales = resolve(feed, stored)
    folder = scratch_folder(spark, "unnumbered")
    sales.write.parquet(folder)
    written = spark.read.parquet(folder)
    if repeatable:
        numbered = snowflake.number_sales(written)
    else:
        numbered = key_by_place(written, "sale_id")
    counts["f_sale"] = write_counted(target, numbered, "f_sale")
    remove_folder(spark, folder)
    return counts


def build_star(
    spark: SparkSession, source: Store, target: Store, dense: bool = False, pack: bool = False
) -> dict[str, int]:
    """Staging to the seven star tables.

    With content keys the fact does not wait for the dimensions; with dense ids it
    reads them as written. ``pack`` stores content keys as 16 bytes instead of 32 digits.
    """
    if dense and pack:
        raise ValueError("numbered ids are not packed")
    feed = read_staging(spark, source)
    plans = {n: lambda df=df: df for n, df in star.dimensions(feed, dense).items()}
    if not dense:
        tables = {n: plan() for n, plan in plans.items()} | {"fact_sales": star.fact(feed)}
        if pack:
            tables = {n: packed(df, list(schema.STAR_REFERENCES)) for n, df in tables.items()}
        return _write_all(spark, target, {n: lambda df=df: df for n, df in tables.items()})
    counts = _write_all(spark, target, plans)
    stored = {n: target.read(spark, n) for n in counts}
    fact = star.fact_by_lookup(feed, stored)
    return counts | {"fact_sales": write_counted(target, fact, "fact_sales")}


def build_months(
    spark: SparkSession, source: Store, target: FileStore, replace: bool = False
) -> dict[str, int]:
    """The star fact partitioned by year and month of sale.

    With ``replace`` only the months that the staged sales fall into are written, each whole: the
    correction of a month costs that month. Sales without a date are a month of their own.
    """
    fact = star.fact_by_month(read_staging(spark, source))
    seen = Observation("months")
    counted = fact.observe(seen, F.count(F.lit(1)).alias("rows"))
    write = target.replace_partitions if replace else target.write_partitioned
    write(counted, "fact_sales", star.MONTH)
    return {"fact_sales": seen.get["rows"]}


def build_marts(spark: SparkSession, source: Store, target: Store) -> dict[str, int]:
    """Star tables to the six marts. The quality mart is cut from the product mart."""
    tables = {n: source.read(spark, n) for n in schema.STAR_TABLES}
    plans = {
        n: lambda mart=mart: mart(tables)
        for n, mart in marts.MARTS.items() if n != "mart_product_quality"
    }
    counts = _write_all(spark, target, plans)
    quality = marts.quality_columns(target.read(spark, "mart_product_sales"))
    return counts | {
        "mart_product_quality": write_counted(target, quality, "mart_product_quality")
    }
