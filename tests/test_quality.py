from __future__ import annotations

from salesloom import registry
from salesloom.plans import quality, snowflake, star


def test_orphans_are_found(spark, feed):
    tables = star.build(feed({}, {"store_name": "other"}, {"store_city": None}))
    kept = {**tables, "dim_store": tables["dim_store"].filter("store_name = 'other'")}
    rows = {r.column_name: (r.rows_without_id, r.orphan_rows)
            for r in quality.star_orphans(kept).collect()}
    assert rows["store_id"] == (1, 1) and rows["date_id"] == (0, 0)
    lost = quality.orphan_rows(kept["fact_sales"], "store_id", kept["dim_store"], "store_id")
    assert lost.count() == 1


def test_duplicate_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a")], "i int, k string")
    row = quality.duplicate_keys(df, "t", ["i", "k"]).first()
    assert (row.row_count, row.null_key_rows, row.duplicate_keys) == (4, 1, 1)


def test_parse_failures(feed):
    staging = feed(
        {"customer_age": "n/a", "sale_total_price": "1.23456789012"},
        {"customer_age": "12.7", "sale_total_price": "NaN", "sale_date": "1/5/21"},
        {"customer_age": "99999999999", "sale_total_price": None},
        {"customer_age": "", "sale_total_price": "-1"},
    )
    rows = {(r.rule, r.column_name): tuple(r)[3:] for r in quality.parse_failures(staging).collect()}
    # filled, unreadable, raises, inexact
    assert rows["strict", "customer_age"] == (3, 2, 1, 0)
    assert rows["permissive", "customer_age"] == (3, 2, 0, 0)
    assert rows["strict", "sale_total_price"] == (3, 2, 0, 0)
    assert rows["permissive", "sale_total_price"] == (3, 0, 0, 2)
    assert rows["strict", "sale_date"] == (4, 0, 1, 0)
    assert rows["permissive", "sale_date"] == (4, 1, 0, 0)


def test_contract_counts_what_enforcing_raises(feed):
    staging = feed({"customer_postal_code": "9" * 51, "product_weight": "1.505"}, {})
    tables = snowflake.build(staging, enforce=False, numbered=False)
    rows = {(r.table_name, r.column_name): (r.not_storable, r.rounded)
            for r in quality.snowflake_contract(tables).collect()}
    assert rows["d_customer_location", "postal_code"] == (1, 0)
    assert rows["d_product_details", "weight"] == (0, 1)


def test_audits_go_on_where_a_build_stops(feed, spark, sf_dir, monkeypatch):
    """One value that breaks its type is counted, in the contract and as lost sales."""
    staging = feed({"customer_first_name": "x" * 201}, {"sale_date": "13/45/2021"},
                   {"sale_quantity": "99999999999"}, {"product_price": "123456789012.5"}, {})
    raw, stored = registry.audited_snowflake(spark, sf_dir, staging, "test-audit")
    rows = {(r.table_name, r.column_name): r.not_storable
            for r in quality.snowflake_contract(raw).collect()}
    assert rows["d_customer", "first_name"] == 1 and rows["f_sale", "sale_quantity"] == 1
    assert rows["d_product", "price"] == 0  # the smaller text wins its key
    lines = {r.dimension: r for r in quality.reconciliation(staging, stored).collect()}
    assert lines["d_customer"].unmatched_sales == 1 and lines["d_date"].unmatched_sales == 1
    assert lines["f_sale"].sales_after == 3


def test_digits_beyond_the_scale_match_nothing_and_stay_apart(feed):
    one, two = "1.0000000000000000001", "1.0000000000000000002"
    staging = feed({"product_weight": one, "product_name": "p1"},
                   {"product_weight": two, "product_name": "p2"},
                   {"product_weight": "1", "product_name": "p3"})
    tables = snowflake.build(staging)
    assert tables["d_product_details"].count() == 3
    products = {r["name"]: 0 for r in tables["d_product"].collect()}
    assert set(products) == {"p3"}
    rows = {(r.rule, r.column_name): r.inexact for r in quality.parse_failures(staging).collect()}
    assert rows["strict", "product_weight"] == 2


def test_row_counts(spark, sf_dir):
    rows = {r.table_name: r.row_count for r in registry.dq_row_counts(spark, sf_dir).collect()}
    assert len(rows) == 15 and rows["raw_data"] == 6000
