from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesloom import schema
from salesloom.plans import quality, snowflake


def fact_rows(staging, **how):
    """``f_sale`` with the id of the staged sale it came from carried as its quantity."""
    numbered = staging.withColumn("sale_quantity", F.col("id"))
    tables = snowflake.build(numbered, numbered=False, **how)
    return Counter(r.sale_quantity for r in tables["f_sale"].collect()), tables


@pytest.mark.parametrize("dense", [False, True])
def test_null_empty_and_named_category(feed, dense):
    sales, tables = fact_rows(feed(
        {"id": "1", "product_category": None},
        {"id": "2", "product_category": ""},
        {"id": "3", "product_category": "A"},
    ), dense=dense)
    assert tables["d_product"].count() == 3 and tables["d_product_category"].count() == 2
    assert sales == Counter({1: 2, 2: 2, 3: 1})


def test_null_and_empty_city_are_one_store(feed):
    sales, tables = fact_rows(feed({"id": "1", "store_city": None}, {"id": "2", "store_city": ""}))
    assert tables["d_store"].count() == 1
    assert sales == Counter({1: 1, 2: 1})


def test_store_keeps_one_location(feed):
    staging = feed(
        {"id": "1", "store_state": "B"}, {"id": "2", "store_state": "A"},
        {"id": "3", "store_state": "A"},
    )
    sales, tables = fact_rows(staging)
    assert tables["d_store"].count() == 1 and tables["d_store_location"].count() == 2
    assert sales == Counter({2: 1, 3: 1})
    report = {r.dimension: r for r in quality.reconciliation(staging, tables).collect()}
    assert (report["d_store"].unmatched_sales, report["d_product"].unmatched_sales) == (1, 0)
    assert (report["f_sale"].staged_sales, report["f_sale"].sales_after) == (3, 2)


def test_details_match_unrounded_values(feed):
    """Stored weights are rounded to cents, the product's own is not."""
    weights = {"p1": "1.001", "p2": "1.002", "p3": "1.5", "p4": "1.00"}
    staging = feed(*[{"product_name": n, "product_weight": w} for n, w in weights.items()])
    tables = snowflake.build(staging)
    assert tables["d_product_details"].count() == 4
    found = Counter(r.name for r in tables["d_product"].collect())
    assert found == Counter({"p3": 1, "p4": 3})


def test_incomplete_key_is_kept_and_lost(feed):
    sales, tables = fact_rows(feed({"id": "1", "customer_email": None}, {"id": "2"}))
    assert tables["d_customer"].count() == 2
    assert sales == Counter({2: 1})


@pytest.mark.parametrize("date", ["", None])
def test_sale_without_date_is_lost(feed, date):
    sales, tables = fact_rows(feed({"id": "1", "sale_date": date}, {"id": "2"}))
    assert tables["d_date"].count() == 1
    assert sales == Counter({2: 1})


@pytest.mark.parametrize(
    "table, change",
    [
        ("d_product_details", {"product_rating": "100.0"}),
        ("d_product_details", {"product_reviews": "99999999999"}),
        ("d_product_details", {"product_release_date": "13/1/2021"}),
        ("d_date", {"sale_date": "2/30/2021"}),
        ("d_customer_location", {"customer_postal_code": "9" * 51}),
        ("d_customer", {"customer_first_name": "x" * 201}),
        ("f_sale", {"sale_total_price": "99999999999.99"}),
    ],
)
def test_value_that_does_not_fit_raises(feed, table, change):
    with pytest.raises(Exception, match="does not fit|out of range"):
        snowflake.build(feed(change))[table].collect()


def test_declared_columns_and_types(feed):
    for name, df in snowflake.build(feed({})).items():
        declared = schema.SNOWFLAKE_COLUMNS[name]
        assert df.columns == list(declared)
        types = {
            c: "string" if d == "key" or d.startswith("varchar") else d
            for c, d in declared.items() if c != "sale_id"
        }
        assert {c: t for c, t in df.dtypes if c in types} == types


def test_equal_sales_are_kept_and_numbered(feed):
    rows = snowflake.build(feed(*[{}] * 5))["f_sale"].collect()
    assert sorted(r.sale_id for r in rows) == [1, 2, 3, 4, 5]


def test_dense_ids_give_the_same_model(spark, sf_dir):
    """Both kinds of key: the same sales, compared through business keys."""
    from salesloom import registry

    feed = registry.staging(spark, sf_dir)

    def resolved(tables):
        return Counter(map(tuple, (
            tables["f_sale"]
            .join(tables["d_customer"].select("customer_id", "first_name", "last_name"), "customer_id")
            .join(tables["d_product"].select("product_id", "name", "price"), "product_id")
            .join(tables["d_store"].select("store_id", "phone"), "store_id")
            .join(tables["d_date"].select("date_id", "full_date"), "date_id")
            .select("sale_quantity", "sale_total_price", "first_name", "last_name", "name", "price",
                    "phone", "full_date")
        ).collect()))

    content = snowflake.build(feed, numbered=False)
    dense = registry.stored_dimensions(spark, sf_dir, dense=True)
    dense["f_sale"] = snowflake.fact_by_lookup(feed, dense)
    assert resolved(content) == resolved(dense)
    ids = [r.customer_id for r in dense["d_customer"].collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_packed_ids_give_the_same_fact(spark, feed):
    staging = feed(*[{"customer_email": f"c{n}", "supplier_email": f"s{n % 3}"} for n in range(9)])
    tables = {n: df for n, df in snowflake.build(staging, numbered=False).items() if n != "f_sale"}
    ids = ["customer_id", "seller_id", "product_id", "store_id", "supplier_id", "date_id"]
    plain = snowflake.fact_by_lookup(staging, tables)
    packed = snowflake.fact_by_lookup(staging, tables, pack=ids)
    assert packed.dtypes == plain.dtypes and packed.count() == 9
    assert packed.exceptAll(plain).isEmpty()
    assert "unhex" in packed._jdf.queryExecution().optimizedPlan().toString()
