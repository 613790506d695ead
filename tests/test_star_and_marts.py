from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesloom import registry
from salesloom.plans import marts, quality, reports, star


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return registry.star_tables(spark, sf_dir)


def test_fact_keeps_every_sale_and_points_to_dimensions(spark, sf_dir, tables):
    assert tables["fact_sales"].count() == registry.staging(spark, sf_dir).count()
    for row in quality.star_orphans(tables).collect():
        assert row.orphan_rows == 0, row


def test_lookup_fact_equals_computed_fact(spark, sf_dir, tables):
    feed = registry.staging(spark, sf_dir)
    by_lookup = star.fact_by_lookup(feed, tables)
    computed = star.fact(feed)
    assert Counter(map(tuple, by_lookup.collect())) == Counter(map(tuple, computed.collect()))


def test_keys_are_unique(tables):
    for name, key in [
        ("dim_customer", ["customer_id"]), ("dim_product", ["product_id"]),
        ("dim_store", ["store_name", "store_city"]), ("dim_date", ["full_date"]),
    ]:
        assert quality.duplicate_keys(tables[name], name, key).first().duplicate_keys == 0


def test_incomplete_key_has_a_dimension_row_but_no_id(feed):
    built = star.build(feed({"customer_email": None}, {"customer_email": None}, {}))
    assert built["dim_customer"].count() == 2
    assert built["fact_sales"].filter("customer_id is null").count() == 2


def test_null_and_empty_city_are_two_stores(feed):
    built = star.build(feed({"store_city": None}, {"store_city": ""}))
    assert built["dim_store"].count() == 2


def test_unreadable_dates_share_one_null_row(feed):
    built = star.build(feed({"sale_date": ""}, {"sale_date": "soon"}, {"sale_date": "1/5/2021"}))
    assert Counter(r.year for r in built["dim_date"].collect()) == Counter({None: 1, 2021: 1})
    time = {r.year: r.num_orders for r in marts.time_sales(built).collect()}
    assert time == {None: 2, 2021: 1}


def test_unmatched_customer_has_the_empty_name(feed):
    mart = marts.customer_sales(star.build(feed({"customer_email": None})))
    assert [(r.customer_name, r.customer_country) for r in mart.collect()] == [("", None)]


def test_missing_amount_counts_as_sale_but_not_in_the_mean(feed):
    built = star.build(feed({"sale_total_price": "bad"}, {"sale_total_price": "10.00"}))
    row = marts.store_sales(built).first()
    assert (row.num_sales, row.total_revenue, row.avg_check) == (2, 10.0, 10.0)


def test_no_amount_at_all_is_null(feed):
    row = marts.store_sales(star.build(feed({"sale_total_price": "bad"}))).first()
    assert (row.num_sales, row.total_revenue, row.avg_check) == (1, None, None)


@pytest.mark.parametrize(
    "texts, expected",
    [
        (["0.1"] * 10, 1.0),
        (["1e3", "0.125"], 1000.125),
        (["1e30", "1"], 1e30 + 1),
        (["Infinity", "5"], math.inf),
        (["NaN", "5"], math.nan),
        (["-2.5", "2.5"], 0.0),
    ],
)
def test_totals(feed, texts, expected):
    built = star.build(feed(*[{"sale_total_price": t} for t in texts]))
    total = marts.product_sales(built).first().total_revenue
    assert total == expected or (math.isnan(total) and math.isnan(expected))


def test_ratings_weigh_by_sales(feed):
    """Two products share no key but one supplier: its mean price is per sale row."""
    built = star.build(feed(
        *[{"product_name": "a", "product_price": "10"}] * 3, {"product_name": "b", "product_price": "20"},
        {"product_name": "c", "product_price": "n/a"},
    ))
    row = marts.supplier_sales(built).first()
    assert (row.avg_product_price, row.num_products_sold) == (12.5, 5)
    reviews = {r.product_name: (r.avg_rating, r.total_reviews) for r in
               marts.product_quality(built).collect()}
    assert reviews == {"a": (4.5, 21), "b": (4.5, 7), "c": (4.5, 7)}


def test_every_mart_holds_all_revenue(tables):
    expected = tables["fact_sales"].agg(
        F.sum(F.col("sale_total_price").cast("decimal(28,2)"))
    ).first()[0]
    for name, mart in marts.build(tables).items():
        column = next(c for c in mart.columns if c in ("total_revenue", "total_spent", "total_sales"))
        held = mart.agg(F.sum(F.col(column).cast("decimal(28,2)"))).first()[0]
        assert held == expected, name


def test_rankings_leave_out_unmatched_sales(feed):
    built = star.build(feed(
        {"product_category": None, "sale_total_price": "999"}, {"product_name": "x"},
        {"product_name": "y"},
    ))
    mart = marts.product_sales(built)
    assert reports.best_products(mart).first().product_name is None
    assert [r.product_name for r in reports.top_products(mart, 5).collect()] == ["x", "y"]


def test_winner_is_the_same_for_any_order(feed):
    staging = feed(*[{"product_price": str(n % 7), "product_color": f"c{n % 5}"} for n in range(60)])
    expected = star.dimension(staging, star.STAR_ENTITIES[2]).collect()
    again = star.dimension(staging.orderBy(F.rand(7)).repartition(3), star.STAR_ENTITIES[2]).collect()
    assert expected == again and expected[0].product_price == 0.0


@pytest.mark.parametrize("amount,want", [("0.0000004", 4e-06), ("1e-15", 1e-14), ("0.1", 1.0)])
def test_totals_lose_no_digits(feed, amount, want):
    tables = star.build(feed(*[{"sale_total_price": amount, "product_rating": amount,
                                "product_price": amount}] * 10))
    columns = {"product_sales": "total_revenue", "customer_sales": "total_spent",
               "time_sales": "total_sales", "store_sales": "total_revenue",
               "supplier_sales": "total_revenue", "product_quality": "total_revenue"}
    for mart, column in columns.items():
        row = getattr(marts, mart)(tables).first()
        assert row[column] == pytest.approx(want, rel=1e-12), mart
    assert marts.product_sales(tables).first()["avg_rating"] == pytest.approx(float(amount))
    assert marts.supplier_sales(tables).first()["avg_product_price"] == pytest.approx(float(amount))


def test_sums_do_not_depend_on_the_order_of_rows(feed):
    amounts = [{"sale_total_price": a} for a in ("0.1", "0.2", "0.3", "1e9", "0.00000001")] * 5
    found = {marts.store_sales(star.build(feed(*own))).first()["total_revenue"]
             for own in (amounts, amounts[::-1], sorted(amounts, key=str))}
    assert found == {5 * 1e9 + 3.00000005}


def exchanged(df) -> list[str]:
    """What each shuffle of a plan is dealt by."""
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def test_supplier_sums_leave_a_task_as_one_row_per_supplier(spark, feed, tmp_path):
    tables = star.build(feed(*[{"product_name": f"p{n}", "product_price": str(n)} for n in range(50)]))
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    lines = exchanged(marts.supplier_sales(stored))
    assert lines and not any("product_id" in line for line in lines)
    sums = marts.priced_sales(stored["fact_sales"], stored["dim_product"]).collect()
    assert [(r.sales, r.price_n, float(r.price_exact)) for r in sums] == [(50, 50, 1225.0)]


def test_sales_without_a_product_have_no_price_but_count(feed):
    built = star.build(feed(
        {"product_price": "10"}, {"product_category": None, "product_price": "99"}, {"supplier_email": None},
    ))
    rows = {r.supplier_name: (r.num_products_sold, r.avg_product_price)
            for r in marts.supplier_sales(built).collect()}
    assert rows == {"supplier_name": (2, 10.0), None: (1, 10.0)}


def test_the_fact_meets_customers_last_and_without_other_keys(spark, feed, tmp_path):
    staging = feed(*[{"customer_email": f"c{n}", "store_name": f"s{n % 3}"} for n in range(20)])
    tables = star.dimensions(staging, dense=True)
    for name, df in {**tables, "staging": staging}.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in [*tables, "staging"]}
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = star.fact_by_lookup(stored["staging"], stored)
        text = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # The topmost join is the last one; its rows hold no key but the customer's.
    joins = [line for line in text.splitlines() if "Join LeftOuter" in line]
    assert "customer_email" in joins[0] and not any("customer_email" in line for line in joins[1:])
    assert found.count() == 20 and found.where("customer_id IS NULL OR store_id IS NULL").isEmpty()
