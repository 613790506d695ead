from __future__ import annotations

import pytest

from salesloom import registry, schema
from salesloom.jobs import warehouse
from salesloom.plans import marts, snowflake, star
from salesloom.sources.csv_feed import read_csv_feed, write_csv_feed
from salesloom.sources.tables import FileStore


@pytest.mark.parametrize("dense", [False, True])
def test_jobs_from_csv_to_marts(spark, sf_dir, tmp_path, dense):
    feed = registry.staging(spark, sf_dir)
    delivered = str(tmp_path / "delivered")
    write_csv_feed(feed.repartition(3), delivered)
    assert read_csv_feed(spark, delivered).exceptAll(feed).isEmpty()

    store = FileStore(str(tmp_path / "tables"))
    assert warehouse.ingest(spark, delivered, store) == {"staging": feed.count()}
    snow = warehouse.build_snowflake(spark, store, store, dense)
    assert set(snow) == set(schema.SNOWFLAKE_COLUMNS)
    assert snow == {n: store.read(spark, n).count() for n in snow}
    stars = warehouse.build_star(spark, store, store, dense)
    assert set(stars) == set(schema.STAR_TABLES) and stars["fact_sales"] == feed.count()
    built = warehouse.build_marts(spark, store, store)
    assert set(built) == set(schema.MART_TABLES)

    expected = registry.QUERIES["mart_product_quality"](spark, sf_dir)
    written = store.read(spark, "mart_product_quality")
    assert sorted(map(str, written.collect())) == sorted(map(str, expected.collect()))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", before)


def test_fact_is_a_projection(spark, sf_dir):
    text = plan(star.fact(registry.staging(spark, sf_dir)))
    assert "Exchange" not in text and "Join" not in text


def test_mart_scans_only_its_columns_and_reduces_before_joining(spark, sf_dir):
    text = plan(marts.time_sales(star.build(registry.staging(spark, sf_dir))))
    scans = [line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema" in line]
    assert sorted(scans) == [
        "struct<sale_date:string,sale_total_price:string>", "struct<sale_date:string>",
    ]
    assert text.index("Join") < text.index("partial_count")


def test_snowflake_fact_pushes_null_filters_to_the_scan(spark, sf_dir):
    feed = registry.staging(spark, sf_dir)
    dims = registry.stored_dimensions(spark, sf_dir)
    text = plan(snowflake.fact(feed, dims))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    assert any("IsNotNull(customer_email)" in line and "IsNotNull(sale_date)" in line
               for line in pushed)
    # Two joins, not six: the other ids are computed.
    assert text.count("HashJoin [") + text.count("SortMergeJoin [") == 2


def before_the_last_exchange(text: str) -> str:
    """The deepest part of a plan: what runs on the scanned rows before the first shuffle."""
    return text[text.rindex("Exchange"):]


@pytest.mark.parametrize("name", [
    "dim_customer", "dim_seller", "dim_product", "dim_store", "dim_supplier",
    "snow_customer", "snow_seller", "snow_store", "snow_supplier",
])
def test_staged_rows_are_hashed_not_sorted(spark, sf_dir, name):
    scanned = before_the_last_exchange(plan(registry.QUERIES[name](spark, sf_dir)))
    assert "HashAggregate" in scanned and "Sort" not in scanned


@pytest.mark.parametrize("name,parser", [
    ("dim_date", "gettimestamp"), ("snow_date", "gettimestamp"), ("sub_product_details", "RLIKE"),
])
def test_texts_are_parsed_after_they_are_distinct(spark, sf_dir, name, parser):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert parser in text and parser not in before_the_last_exchange(text)


@pytest.mark.parametrize("name", [
    "revenue_by_category", "avg_rating_by_product", "mart_product_sales", "mart_time_sales",
])
def test_marts_are_not_ordered(spark, sf_dir, name):
    assert "rangepartitioning" not in plan(registry.QUERIES[name](spark, sf_dir))


def test_command_line_runs_on_catalog_tables(spark, sf_dir, tmp_path, monkeypatch):
    from salesloom.jobs import __main__ as cli
    from salesloom.sources.tables import CatalogStore, JdbcStore

    monkeypatch.setattr(cli, "build_session", lambda *a: spark)
    monkeypatch.setattr(cli, "remove_materialized", lambda spark: None)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    spark.sql("CREATE DATABASE IF NOT EXISTS wh")
    spark.sql("CREATE DATABASE IF NOT EXISTS wh2")
    registry.staging(spark, sf_dir).write.mode("overwrite").saveAsTable("wh.staging")
    cli.main(["star", "--source", "catalog:wh", "--target", str(tmp_path)])
    cli.main(["marts", "--source", str(tmp_path), "--target", "catalog:wh"])
    by_month = str(tmp_path / "months")
    cli.main(["months", "--source", "catalog:wh", "--target", by_month])
    months = spark.read.parquet(f"{by_month}/fact_sales").groupBy(*star.MONTH).count().collect()
    may = spark.table("wh.staging").where("sale_date like '5/%/1996'").limit(3)
    may.write.mode("overwrite").saveAsTable("wh2.staging")
    cli.main(["months", "--source", "catalog:wh2", "--target", by_month, "--replace"])
    after = spark.read.parquet(f"{by_month}/fact_sales").groupBy(*star.MONTH).count().collect()
    assert {tuple(r) for r in after} ^ {tuple(r) for r in months} == {
        (1996, 5, 3), *[tuple(r) for r in months if tuple(r)[:2] == (1996, 5)]
    }
    packed_to = str(tmp_path / "packed")
    cli.main(["star", "--source", "catalog:wh", "--target", packed_to, "--pack"])
    assert spark.read.parquet(f"{packed_to}/fact_sales").schema["customer_id"].dataType.simpleString() == "binary"
    cli.main(["marts", "--source", packed_to, "--target", packed_to])
    assert sorted(map(str, spark.read.parquet(f"{packed_to}/mart_time_sales").collect())) == sorted(
        map(str, spark.table("wh.mart_time_sales").collect()))
    assert spark.table("wh.mart_time_sales").count() > 0
    assert cli.store("catalog:wh", {}) == CatalogStore("wh")
    assert isinstance(cli.store("jdbc:x:y", {"user": "u"}, 4), JdbcStore)


def test_jdbc_reads_are_split_by_conditions():
    from salesloom.sources.tables import JdbcStore

    plain = JdbcStore("jdbc:x:y")
    assert plain.conditions("t", ["id"]) == []
    split = JdbcStore("jdbc:x:y", splits=3).conditions("t", ["id", "b"])
    assert len(split) == 3 and "IS NULL" in split[0] and all("MOD" in c for c in split)
    assert JdbcStore("jdbc:x:y", splits=3).conditions("t", ["b"]) == []
    given = JdbcStore("jdbc:x:y", predicates={"t": ["a = 1", "a <> 1"]})
    assert given.conditions("t", []) == ["a = 1", "a <> 1"]


def test_staged_tables_follow_their_input_and_are_removed(spark, sf_dir, tmp_path, monkeypatch):
    import os
    import shutil

    from salesloom import session

    monkeypatch.setattr(registry, "_STAGED", {})
    monkeypatch.setattr(session, "_WRITTEN", {})
    copy = tmp_path / "tables"
    copy.mkdir()
    for name in registry.SOURCES:
        shutil.copyfile(f"{sf_dir}/{name}.parquet", copy / f"{name}.parquet")
    assert registry.staging(spark, str(copy)).count() == 6000
    some = spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(10).toPandas()
    some.to_parquet(copy / "lineitem.parquet", coerce_timestamps="us")
    assert registry.staging(spark, str(copy)).count() == 10
    written = [name for names in session._WRITTEN.values() for name in names]
    registry.discard(spark)
    assert len(written) == 2 and not any(os.path.exists(name) for name in written)
