"""Later feeds, audits before publication, versions, ids by place, checked lookups."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from salesloom import schema
from salesloom.jobs import loads
from salesloom.operators.keys import key_by_place
from salesloom.operators.lookup import lookup
from salesloom.plans import marts, snowflake, star
from salesloom.sources.versions import Outdated, VersionedStore


def sale(i: int, **changes) -> dict:
    """One sale; every description follows from its key, so no two feeds contradict each other."""
    c, s, p, o, u = i % 7, i % 3, i % 5, i % 4, i % 2
    return {
        "id": f"{i}-1", "sale_date": f"{1 + i % 12}/5/2021", "sale_quantity": str(i),
        "sale_total_price": f"{i}.50",
        "customer_first_name": f"c{c}", "customer_email": f"c{c}@x", "customer_age": str(20 + c),
        "customer_country": f"land{c % 2}", "customer_pet_name": f"pet{c}",
        "seller_first_name": f"s{s}", "seller_country": f"land{s}",
        "product_name": f"p{p}", "product_category": (None, "", "a", "b", "a")[p],
        "product_weight": f"{p}.50", "product_brand": f"b{p}",
        "store_name": f"o{o}", "store_city": f"city{o}", "store_state": f"st{o}",
        "supplier_name": f"u{u}", "supplier_email": f"u{u}@x", "supplier_city": f"ucity{u}",
        **changes,
    }


def rows(df, *without: str) -> list[str]:
    return sorted(map(str, df.drop(*without).select(*sorted(set(df.columns) - set(without))).collect()))


@pytest.fixture(scope="module")
def feeds(feed):
    first = feed(*[sale(i) for i in range(20)])
    # New customers, products and dates, beside known ones.
    second = feed(
        *[sale(i) for i in range(12, 40)],
        *[sale(50 + i, customer_email=f"new{i}@x", product_name=f"new{i}") for i in range(4)],
        sale(60, sale_date="bad", customer_email=None),
    )
    return first.cache(), second.cache()


def loaded(spark, folder, feeds, dense):
    models = {
        "snowflake": lambda *a: loads.add_to_snowflake(*a, dense=dense),
        "star": lambda *a: loads.add_to_star(*a, dense=dense),
    }
    store = VersionedStore(str(folder))
    outcomes = [loads.load_feed(spark, store, f, f"feed {i}", models) for i, f in enumerate(feeds)]
    assert [o.version for o in outcomes] == [1, 2]
    return store


def lenient(df):
    return df.withColumn("sale_date", F.when(F.col("sale_date") != "bad", F.col("sale_date")))


@pytest.fixture(scope="module")
def by_content(spark, feeds, tmp_path_factory):
    return loaded(spark, tmp_path_factory.mktemp("content"), [lenient(f) for f in feeds], False)


@pytest.fixture(scope="module")
def by_number(spark, feeds, tmp_path_factory):
    return loaded(spark, tmp_path_factory.mktemp("numbers"), [lenient(f) for f in feeds], True)


def test_two_feeds_make_the_tables_of_the_whole_feed(spark, feeds, by_content):
    whole = lenient(feeds[0].unionByName(feeds[1]))
    expected = {**snowflake.build(whole, numbered=False), **star.build(whole)}
    for table, df in expected.items():
        assert rows(by_content.read(spark, table), "sale_id") == rows(df), table
    for name, mart in marts.build(star.build(whole)).items():
        assert rows(loads.marts_of(by_content, spark)[name]) == rows(mart), name


def test_numbered_ids_stay_and_new_ones_follow(spark, by_content, by_number):
    for table in schema.SNOWFLAKE_COLUMNS:
        key = schema.primary_key(table)
        before, after = (by_number.read(spark, table, v) for v in (1, 2))
        assert before.exceptAll(after).isEmpty()
        ids = sorted(r[0] for r in after.select(key).collect())
        assert ids == list(range(1, len(ids) + 1)) and ids[: before.count()] == sorted(
            r[0] for r in before.select(key).collect()
        )
        assert len(ids) == by_content.read(spark, table).count()
    # Numbers and content keys point to the same things.
    for child, column, parent in schema.SNOWFLAKE_REFERENCES:
        key = schema.primary_key(parent)

        def told(store):
            named = store.read(spark, parent)
            kept = [c for c, d in schema.SNOWFLAKE_COLUMNS[parent].items() if d != "key"]
            to = named.select(F.col(key).alias(column), *[F.col(c).alias(f"parent_{c}") for c in kept])
            ids = [c for c, d in schema.SNOWFLAKE_COLUMNS[child].items() if d == "key"]
            return rows(store.read(spark, child).drop("content_key").join(to, column), *ids)

        assert told(by_number) == told(by_content), (child, column)


def test_star_facts_point_to_numbered_dimensions(spark, feeds, by_number, by_content):
    for mart, df in loads.marts_of(by_number, spark).items():
        assert rows(df) == rows(loads.marts_of(by_content, spark)[mart]), mart


def test_first_description_of_a_key_stays(spark, feed, tmp_path):
    store = VersionedStore(str(tmp_path))
    models = {
        "snowflake": lambda *a: loads.add_to_snowflake(*a, dense=False), "star": loads.add_to_star,
    }
    first = feed(sale(1, customer_age="50", store_state="west", product_weight="2.00"))
    second = feed(
        sale(1, customer_age="20", store_state="east", product_weight="1.00"),
        sale(2, customer_age="30"), sale(1, store_state="west"),
    )
    for i, f in enumerate((first, second)):
        assert loads.load_feed(spark, store, f, str(i), models).published
    ages = {r["email"]: r["age"] for r in store.read(spark, "d_customer").collect()}
    assert ages == {"c1@x": 50, "c2@x": 30}
    # The store kept its state, so the sale of the other state is lost, as within one feed.
    assert store.read(spark, "d_store").count() == 2
    assert store.read(spark, "f_sale").count() == 3
    assert store.read(spark, "fact_sales").count() == 4
    weights = store.read(spark, "d_product").join(store.read(spark, "d_product_details"), "details_id")
    assert {(r["name"], str(r["weight"])) for r in weights.collect()} == {("p1", "2.00"), ("p2", "2.50")}


def test_a_feed_is_loaded_once_and_empty_ones_change_nothing(spark, feeds, by_number):
    before = {t: by_number.read(spark, t).count() for t in ("f_sale", "d_customer", "fact_sales")}
    assert loads.load_feed(spark, by_number, feeds[1], "feed 1") is None
    star_only = {"star": lambda *a: loads.add_to_star(*a, dense=True)}
    assert loads.load_feed(spark, by_number, feeds[1].limit(0), "nothing", star_only).published
    with pytest.raises(ValueError, match="other kind of ids"):
        loads.load_feed(spark, by_number, feeds[1], "hashed", {"star": loads.add_to_star})
    assert before == {t: by_number.read(spark, t).count() for t in before}


def files_under(folder) -> int:
    return sum(f.endswith(".parquet") for _, _, names in os.walk(folder) for f in names)


def test_a_broken_load_leaves_the_old_tables(spark, feeds, tmp_path):
    store = VersionedStore(str(tmp_path))
    assert loads.load_feed(spark, store, feeds[0], "first", {"star": loads.add_to_star}).published
    before, kept = files_under(tmp_path), rows(store.read(spark, "fact_sales"))
    load = store.begin(spark)
    load.append(star.dimension(feeds[1], schema.CUSTOMER), "dim_customer")
    load.append(star.fact(feeds[1]), "fact_sales")
    outcome = loads.publish_if_clean(load, spark, "second")
    found = {r["column_names"]: r["violations"] for r in outcome.report.collect()}
    assert not outcome.published and found["customer_id"] == 0  # of the references
    unique = outcome.report.where("rule = 'unique' AND violations > 0").collect()
    assert [(r["table_name"], r["violations"]) for r in unique] == [("dim_customer", 7)]
    assert found["product_id"] == 3 and found["seller_id"] == 0  # one has no category, so no id
    assert files_under(tmp_path) == before and rows(store.read(spark, "fact_sales")) == kept
    assert store.contents(spark)["feeds"] == ["first"]


def test_a_failing_load_is_abandoned_and_can_be_repeated(spark, feed, tmp_path):
    store = VersionedStore(str(tmp_path))
    calls = []

    def failing(load, spark, kept):
        loads.add_to_star(load, spark, kept)
        if not calls.append(1) and len(calls) == 1:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        loads.load_feed(spark, store, feed(sale(1)), "a", {"star": failing})
    assert files_under(tmp_path) == 0 and store.versions(spark) == []
    assert loads.load_feed(spark, store, feed(sale(1)), "a", {"star": failing}).version == 1


def test_replaced_parents_are_checked_against_old_children(spark, feeds, tmp_path):
    store = VersionedStore(str(tmp_path))
    loads.load_feed(spark, store, feeds[0], "first", {"star": loads.add_to_star})
    load = store.begin(spark)
    sellers = load.read(spark, "dim_seller")
    load.write(sellers.where("seller_first_name <> 's1'"), "dim_seller")
    outcome = loads.publish_if_clean(load, spark)
    bad = outcome.report.where("violations > 0").collect()
    assert [(r["column_names"], r["violations"]) for r in bad] == [("seller_id", 7)]


def test_only_one_of_two_loads_is_published(spark, feeds, tmp_path):
    store = VersionedStore(str(tmp_path))
    one, two = store.begin(spark), store.begin(spark)
    for load in (one, two):
        load.append(star.date_dimension(feeds[0]), "dim_date")
    assert one.publish("a") == 1
    with pytest.raises(Outdated):
        two.publish("b")
    two.abandon()
    assert store.read(spark, "dim_date").count() == star.date_dimension(feeds[0]).count()


def test_versions_stay_readable_until_they_expire(spark, tmp_path):
    store = VersionedStore(str(tmp_path))
    for n in range(3):
        load = store.begin(spark)
        load.write(spark.range(n + 1), "t")
        load.append(spark.range(10), "log")
        load.publish(str(n))
    assert [store.read(spark, "t", v).count() for v in store.versions(spark)] == [1, 2, 3]
    assert store.read(spark, "log").count() == 30
    store.expire(spark, keep=2)
    assert store.versions(spark) == [2, 3] and store.read(spark, "log", 2).count() == 20
    assert store.contents(spark)["feeds"] == ["0", "1", "2"]
    store.expire(spark)
    assert store.read(spark, "t").count() == 3 and store.read(spark, "log").count() == 30


def test_states_merge_and_marts_read_no_sale(spark, by_content, tmp_path):
    tables = loads.marts_of(by_content, spark)
    for df in tables.values():
        assert not [f for f in df.inputFiles() if "fact_sales" in f]
    load = by_content.begin(spark)
    before = {n: rows(df) for n, df in tables.items()}
    loads.compact_states(load, spark)
    assert load.read(spark, "sales_per_customer").groupBy("customer_id").count().where("count > 1").isEmpty()
    assert {n: rows(df) for n, df in loads.marts_of(load, spark).items()} == before
    load.abandon()


def test_prices_of_a_state_follow_the_products(spark, by_content):
    load = by_content.begin(spark)
    dearer = load.read(spark, "dim_product").withColumn("product_price", F.col("product_price") + 1)
    load.write(dearer, "dim_product")
    del load.tables["sales_per_supplier_priced"]  # as sales were loaded before there was one
    older = rows(loads.marts_of(load, spark)["mart_supplier_sales"])
    load.tables["sales_per_supplier_priced"] = by_content.contents(spark)["tables"]["sales_per_supplier_priced"]
    loads._add_priced(load, spark)
    assert rows(loads.marts_of(load, spark)["mart_supplier_sales"]) == older
    before = rows(loads.marts_of(by_content, spark)["mart_supplier_sales"])
    assert before != older and len(before) == len(older)
    load.abandon()


def test_command_line_loads_reports_and_refuses(spark, sf_dir, tmp_path, monkeypatch, capsys):
    from salesloom import registry
    from salesloom.jobs import __main__ as cli
    from salesloom.sources.csv_feed import write_csv_feed

    monkeypatch.setattr(cli, "build_session", lambda *a: spark)
    monkeypatch.setattr(cli, "remove_materialized", lambda spark: None)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    feed = registry.staging(spark, sf_dir).limit(300)
    write_csv_feed(feed, str(tmp_path / "in" / "good"))
    write_csv_feed(feed.select("id", "store_name"), str(tmp_path / "in" / "narrow"))
    arguments = ["load", "--paths", str(tmp_path / "in" / "*"), "--target", str(tmp_path / "wh"), "--feed", "may", "--content-keys"]
    cli.main(arguments)
    cli.main(arguments)
    assert capsys.readouterr().out.split("\n")[:2] == ["may\tversion 1", "may\tloaded before"]
    store = VersionedStore(str(tmp_path / "wh"))
    assert store.read(spark, "rejects").where("feed = 'may'").count() == 300
    assert store.read(spark, "fact_sales").count() == 300
    cli.main(["marts", "--source", f"versions:{tmp_path}/wh", "--target", str(tmp_path / "marts")])
    assert spark.read.parquet(str(tmp_path / "marts" / "mart_time_sales")).count() > 0

    def broken(load, spark, feed):
        load.append(star.fact(feed), "fact_sales")

    monkeypatch.setattr(cli.loads, "add_to_star", lambda *a, dense: broken(*a))
    new = feed.limit(5).withColumn("customer_email", F.lit("nobody@x"))
    write_csv_feed(new, str(tmp_path / "june"))
    with pytest.raises(SystemExit):
        cli.main([*arguments[:2], str(tmp_path / "june"), *arguments[3:5], "--feed", "june", "--content-keys"])
    assert "customer_id" in capsys.readouterr().out
    assert store.contents(spark)["feeds"] == ["may"]


# --- ids by place ---------------------------------------------------------------------


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("files", [1, 7])
def test_keys_by_place_are_dense_and_move_no_row(spark, tmp_path, files):
    spark.range(5000).selectExpr("id % 10 AS a", "repeat(string(id % 3), 40) AS b").repartition(
        files
    ).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # several tasks per file
    try:
        table = spark.read.parquet(str(tmp_path / "t"))
        numbered = key_by_place(table, "id", after=100)
        text = plan(numbered)
        found = numbered.select("id").collect()
        again = key_by_place(table, "id", after=100).exceptAll(numbered)
        assert again.isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert sorted(r[0] for r in found) == list(range(101, 5101))
    assert numbered.columns == ["id", "a", "b"]
    # Only the table of files is shuffled; the rows meet it by broadcast.
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("_path" in line or "_file" in line for line in exchanges)


def test_keys_by_place_of_an_empty_table(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    assert key_by_place(spark.read.parquet(str(tmp_path / "t")), "n").count() == 0


# --- lookups that must find one row -----------------------------------------------------


def test_a_second_match_raises_and_names_the_key(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "key string, v int")
    for names, fails in ((["a", "c", None, "x"], False), (["a", "b"], True)):
        asked = spark.createDataFrame([(n,) for n in names], "k string")
        found = lookup(asked, table, {"k": "key"}, ["v"], single=True)
        if fails:
            with pytest.raises(SparkRuntimeException, match="more than one row for key = b"):
                found.collect()
        else:
            assert {r["k"]: r["v"] for r in found.collect()} == {"a": 1, "c": 4, None: None, "x": None}


def test_a_repeated_location_stops_the_fact(spark, feed):
    tables = snowflake.build(feed(*[sale(i) for i in range(6)]), dense=True, numbered=False)
    tables = {n: df for n, df in tables.items() if n != "f_sale"}
    assert snowflake.fact_by_lookup(feed(sale(1)), tables).count() == 1
    twice = tables["d_store_location"].unionByName(
        tables["d_store_location"].withColumn("location_id", F.col("location_id") + 100)
    )
    doubled = {**tables, "d_store_location": twice}
    with pytest.raises(SparkRuntimeException, match="more than one row for city = city1"):
        snowflake.fact_by_lookup(feed(sale(1)), doubled).collect()
    # An audit counts instead of stopping.
    assert snowflake.fact_by_lookup(feed(sale(1)), doubled, enforce=False).count() >= 1


def test_the_check_shuffles_nothing_more(spark, tmp_path):
    spark.range(50).selectExpr("string(id) AS key", "id AS v").write.parquet(str(tmp_path / "t"))
    spark.range(100).selectExpr("string(id % 60) AS k").write.parquet(str(tmp_path / "r"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table, asked = (spark.read.parquet(str(tmp_path / n)) for n in "tr")
        counts = []
        for single in (False, True):
            found = lookup(asked, table, {"k": "key"}, ["v"], "inner", single=single)
            text = plan(found)
            counts.append((text.count("Exchange hashpartitioning"), found.count()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert counts[0] == counts[1] == (2, counts[0][1])


# --- what both models read of a feed ------------------------------------------------------


def test_models_share_descriptions_and_pick_as_each_does_alone(spark, feed, tmp_path):
    """NULL and '' tie in the snowflake only, so each model may pick another row of a key."""
    rows_ = feed(
        sale(1, customer_age=None, customer_country=None, customer_postal_code="b"),
        sale(1, customer_age=None, customer_country="", customer_postal_code="a"),
        sale(2, store_city=None, store_location="z", store_phone="2"),
        sale(2, store_city="", store_location=None, store_phone="3"),
        sale(2, store_city="", store_location="", store_phone="1"),
        sale(3, supplier_email=None, seller_email=None), sale(3, product_category=None),
    )
    load = VersionedStore(str(tmp_path)).begin(spark)
    loads.add_to_snowflake(load, spark, rows_, dense=False)
    loads.add_to_star(load, spark, rows_)
    for table, df in {**snowflake.build(rows_, numbered=False), **star.build(rows_)}.items():
        assert rows(load.read(spark, table), "sale_id") == rows(df), table
    # Dimensions are made from one set of written descriptions, whichever model asks.
    for entity in schema.STAR_ENTITIES:
        picked = loads._picked(load, rows_, entity, "_delivered")
        assert all("aside-winners" in f for f in picked.inputFiles())
    assert len([f for f in os.listdir(tmp_path / "data") if f.startswith("aside-winners")]) == 5
    load.clear()
    assert not [f for f in os.listdir(tmp_path / "data") if f.startswith("aside-")]
    load.abandon()


def test_a_load_makes_its_feed_without_the_staging_table(spark, sf_dir):
    from salesloom import registry

    feed = registry._feed_no(spark, sf_dir, 1)
    read = {os.path.basename(f) for f in feed.inputFiles()}
    assert read == {f"{t}.parquet" for t in registry.SOURCES}
    staged = registry.staging(spark, sf_dir)
    assert feed.exceptAll(staged).isEmpty()
    assert feed.count() + registry._feed_no(spark, sf_dir, 0).count() == staged.count()
