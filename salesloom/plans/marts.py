"""Six aggregate marts over the star model.

Every mart adds up the fact per dimension id first and joins the dimension to
those sums (prices of products alone are joined before: ``priced_sales``). The fact is reduced before it is shuffled, a hot id or the group of
unmatched sales arrives as one row per task, and the join has at most one row
per id on either side, so it stays even when a dimension is too big to broadcast.

Sales without a matching dimension row form a group of their own (NULL names).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions.measures import average, merged, partial_total, partial_weighted, total
from salesloom.operators.lookup import lookup

Tables = Mapping[str, DataFrame]


def sales_per(fact: DataFrame, *ids: str) -> DataFrame:
    """Fact sums per id: ``sales``, ``quantity`` and the partial total ``amount_*``."""
    return fact.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("sales"),
        F.sum("sale_quantity").alias("quantity"),
        *partial_total("sale_total_price", "amount"),
    )


def priced_sales(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Fact sums per supplier, with the partial sum of list prices (``price_*``), once per sale row.

    Each sale takes its product's price before anything is added up: products are a few where
    suppliers and products together are nearly as many as sales. The sums leave a task as one row
    per supplier; sales are shuffled only where the products are too many to broadcast.
    """
    sales = fact.select(
        "supplier_id", "product_id", "sale_quantity", "sale_total_price",
        F.lit(1).cast("bigint").alias("sales"),
    )
    priced = lookup(sales, products, {"product_id": "product_id"}, ["product_price"])
    return priced.groupBy("supplier_id").agg(
        F.sum("sales").alias("sales"),
        F.sum("sale_quantity").alias("quantity"),
        *partial_total("sale_total_price", "amount"),
        *partial_weighted("product_price", "sales", "price"),
    )


# Stored sums per dimension id, by the name of their table. Sums of later sales are appended to
# them; the marts add up the rows of an id, so they need no sale that was summed before.
STATES: dict[str, tuple[str, ...]] = {
    "sales_per_customer": ("customer_id",),
    "sales_per_product": ("product_id",),
    "sales_per_store": ("store_id",),
    "sales_per_date": ("date_id",),
    "sales_per_supplier_priced": ("supplier_id",),
}
PRICED = "sales_per_supplier_priced"


def merged_sales(state: DataFrame, *ids: str) -> DataFrame:
    """Sums of several loads as one row per id, in the columns of ``sales_per``, or of
    ``priced_sales`` where the state has them."""
    prices = merged("price") if "price_n" in state.columns else []
    return state.groupBy(*ids).agg(
        F.sum("sales").alias("sales"), F.sum("quantity").alias("quantity"), *merged("amount"), *prices
    )


def _sales(tables: Tables, *ids: str) -> DataFrame:
    """The stored sums per id if there are any, else those of the fact."""
    for name, of in STATES.items():
        if of == ids and name in tables and name != PRICED:
            return merged_sales(tables[name], *ids)
    return sales_per(tables["fact_sales"], *ids)


def sales_by(
    tables: Tables,
    dimension: str,
    id_column: str,
    groups: list[Column],
    *extra: Column,
    how: str = "left",
) -> DataFrame:
    """Fact sums per dimension attribute, through the sums per id.

    ``how="inner"`` leaves out sales without a matching dimension row.
    """
    per_id = _sales(tables, id_column)
    return (
        per_id.join(tables[dimension], id_column, how)
        .groupBy(*groups)
        .agg(
            F.sum("sales").alias("sales"),
            F.sum("quantity").alias("quantity"),
            *merged("amount"),
            *extra,
        )
    )


def _product_totals(tables: Tables) -> DataFrame:
    return sales_by(
        tables, "dim_product", "product_id",
        [F.col("product_name"), F.col("product_category")],
        *partial_weighted("product_rating", "sales", "rating"),
        F.sum(F.col("product_reviews") * F.col("sales")).alias("total_reviews"),
    ).select(
        "product_name", "product_category",
        F.col("quantity").alias("total_quantity_sold"),
        total("amount").alias("total_revenue"),
        average("rating").alias("avg_rating"),
        "total_reviews",
    )


def product_sales(tables: Tables) -> DataFrame:
    """Quantity, revenue, rating and reviews per product.

    Rating and reviews count once per sale row, so they weigh by sales. A stored table keeps no
    order: ``reports.best_products`` orders what is read.
    """
    return _product_totals(tables)


def product_quality(tables: Tables) -> DataFrame:
    """Rating and reviews beside quantity and revenue, per product."""
    return quality_columns(_product_totals(tables))


def quality_columns(product_sales: DataFrame) -> DataFrame:
    """The quality mart of a product mart: both hold the same six columns."""
    return product_sales.select(
        "product_name", "product_category", "avg_rating", "total_reviews",
        "total_quantity_sold", "total_revenue",
    )


def customer_sales(tables: Tables) -> DataFrame:
    """Spend per customer name and country; namesakes in a country are one group.

    The group of unmatched sales has the empty name.
    """
    name = F.concat_ws(" ", "customer_first_name", "customer_last_name").alias("customer_name")
    return sales_by(
        tables, "dim_customer", "customer_id", [name, F.col("customer_country")]
    ).select(
        "customer_name", "customer_country",
        total("amount").alias("total_spent"),
        F.col("sales").alias("num_purchases"),
        average("amount").alias("avg_check"),
    )


def time_sales(tables: Tables) -> DataFrame:
    """Sales per year and month; the trends of ``reports`` order them."""
    return sales_by(tables, "dim_date", "date_id", [F.col("year"), F.col("month")]).select(
        "year", "month",
        total("amount").alias("total_sales"),
        F.col("sales").alias("num_orders"),
        average("amount").alias("avg_order_size"),
    )


def store_sales(tables: Tables) -> DataFrame:
    """Revenue per store name, city and country."""
    return sales_by(
        tables, "dim_store", "store_id",
        [F.col("store_name"), F.col("store_city"), F.col("store_country")],
    ).select(
        "store_name", "store_city", "store_country",
        total("amount").alias("total_revenue"),
        F.col("sales").alias("num_sales"),
        average("amount").alias("avg_check"),
    )


def supplier_sales(tables: Tables) -> DataFrame:
    """Revenue per supplier name and country, with the mean list price per sale row.

    ``num_products_sold`` counts sale rows. The price needs the product, so sales
    take it first, are added up per supplier and then meet the supplier.
    """
    return supplier_totals(tables, "supplier_name", "supplier_country").select(
        "supplier_name", "supplier_country",
        total("amount").alias("total_revenue"),
        average("price").alias("avg_product_price"),
        F.col("sales").alias("num_products_sold"),
    )


def supplier_totals(tables: Tables, *groups: str, how: str = "left") -> DataFrame:
    """Fact sums per supplier attribute, with the partial price sum and the suppliers."""
    if PRICED in tables:
        per_supplier = merged_sales(tables[PRICED], "supplier_id")
    else:
        per_supplier = priced_sales(tables["fact_sales"], tables["dim_product"])
    return (
        per_supplier.join(tables["dim_supplier"], "supplier_id", how)
        .groupBy(*groups)
        .agg(
            F.sum("sales").alias("sales"),
            *merged("amount"),
            *merged("price"),
            F.count("supplier_id").alias("suppliers"),
        )
    )


MARTS = {
    "mart_product_sales": product_sales,
    "mart_customer_sales": customer_sales,
    "mart_time_sales": time_sales,
    "mart_store_sales": store_sales,
    "mart_supplier_sales": supplier_sales,
    "mart_product_quality": product_quality,
}


def build(tables: Tables) -> dict[str, DataFrame]:
    """All six marts as plans over the star tables."""
    return {name: mart(tables) for name, mart in MARTS.items()}
