"""What the marts are read for: rankings, distributions, trends and a correlation.

Rankings and distributions leave out the group of sales without a matching
dimension row (``matched``); in the marts it stays. Averages over a coarser group
come from the fact, because a mart's sale count includes sales without an amount.
Every ranking has a full tie-break.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from salesloom.functions.measures import average, partial_total, total
from salesloom.plans import marts

Tables = Mapping[str, DataFrame]


def _top(mart: DataFrame, measure: str, ties: list[str], k: int) -> DataFrame:
    # Each task keeps k rows and only those are merged.
    return mart.orderBy(F.col(measure).desc(), *ties).limit(k)


# --- products -----------------------------------------------------------------

_PRODUCT = ["product_name", "product_category"]


def matched_products(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("product_name").isNotNull())


def best_products(product_sales: DataFrame) -> DataFrame:
    """The whole mart, best revenue first."""
    return product_sales.orderBy(F.col("total_revenue").desc(), *_PRODUCT)


def top_products(product_sales: DataFrame, k: int = 10) -> DataFrame:
    """Best revenue."""
    return _top(matched_products(product_sales), "total_revenue", _PRODUCT, k)


def revenue_by_category(product_sales: DataFrame) -> DataFrame:
    return (
        matched_products(product_sales)
        .groupBy("product_category")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.sum("total_quantity_sold").alias("total_quantity_sold"),
            *partial_total("total_revenue", "amount"),
        )
        .select(
            "product_category", "products", "total_quantity_sold",
            total("amount").alias("total_revenue"),
        )
    )


def avg_rating_by_product(product_sales: DataFrame) -> DataFrame:
    return matched_products(product_sales).select(*_PRODUCT, "avg_rating")


def rating_sales_correlation(product_quality: DataFrame) -> DataFrame:
    """Pearson correlation over products; a product without rating does not count."""
    quantity = F.col("total_quantity_sold").cast("double")
    corr = F.corr("avg_rating", quantity)
    # Merged in any order: digits behind the ninth are noise.
    return product_quality.agg(F.round(corr, 9).alias("rating_sales_corr"))


def most_reviewed(product_quality: DataFrame, k: int = 10) -> DataFrame:
    return _top(matched_products(product_quality), "total_reviews", _PRODUCT, k)


# --- customers ----------------------------------------------------------------


def matched_customers(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("customer_name") != "")


def top_customers(customer_sales: DataFrame, k: int = 10) -> DataFrame:
    """Highest spend."""
    ties = ["customer_name", "customer_country"]
    return _top(matched_customers(customer_sales), "total_spent", ties, k)


def customers_by_country(customer_sales: DataFrame) -> DataFrame:
    return (
        matched_customers(customer_sales)
        .groupBy("customer_country")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("num_purchases").alias("num_purchases"),
            *partial_total("total_spent", "amount"),
        )
        .select(
            "customer_country", "customers", "num_purchases",
            total("amount").alias("total_spent"),
        )
    )


# --- time ---------------------------------------------------------------------


def monthly_trend(time_sales: DataFrame) -> DataFrame:
    return (
        time_sales.filter(F.col("year").isNotNull())
        .select("year", "month", "total_sales", "num_orders")
        .orderBy("year", "month")
    )


def avg_order_by_month(time_sales: DataFrame) -> DataFrame:
    return (
        time_sales.filter(F.col("year").isNotNull())
        .select("year", "month", "avg_order_size")
        .orderBy("year", "month")
    )


def yearly_trend(tables: Tables) -> DataFrame:
    return (
        marts.sales_by(tables, "dim_date", "date_id", [F.col("year")], how="inner")
        .filter(F.col("year").isNotNull())
        .select(
            "year",
            total("amount").alias("total_sales"),
            F.col("sales").alias("num_orders"),
            average("amount").alias("avg_order_size"),
        )
        .orderBy("year")
    )


# --- stores -------------------------------------------------------------------


def top_stores(store_sales: DataFrame, k: int = 10) -> DataFrame:
    """Best revenue."""
    ties = ["store_name", "store_city", "store_country"]
    return _top(store_sales.filter(F.col("store_name").isNotNull()), "total_revenue", ties, k)


def stores_by(tables: Tables, attribute: str) -> DataFrame:
    """Stores, revenue and average check per ``store_city`` or ``store_country``."""
    return marts.sales_by(
        tables, "dim_store", "store_id", [F.col(attribute)],
        F.count("store_id").alias("stores"), how="inner",
    ).select(
        attribute, "stores",
        total("amount").alias("total_revenue"),
        F.col("sales").alias("num_sales"),
        average("amount").alias("avg_check"),
    )


# --- suppliers ----------------------------------------------------------------


def top_suppliers(supplier_sales: DataFrame, k: int = 10) -> DataFrame:
    """Best revenue."""
    ties = ["supplier_name", "supplier_country"]
    matched = supplier_sales.filter(F.col("supplier_name").isNotNull())
    return _top(matched, "total_revenue", ties, k)


def suppliers_by_country(tables: Tables) -> DataFrame:
    return marts.supplier_totals(tables, "supplier_country", how="inner").select(
        "supplier_country", "suppliers",
        total("amount").alias("total_revenue"),
        average("price").alias("avg_product_price"),
        F.col("sales").alias("num_products_sold"),
    )
