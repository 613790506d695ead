"""The staging feed derived from the TPC-H-like tables: one row per line item.

Gives the 50 text columns of the feed, with dirty numbers, missing keys and
conflicting descriptions, from any scale factor of the given tables.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Column -> expression over the joined tables. Valid both in Spark SQL and DuckDB.
STAGING_EXPRESSIONS: dict[str, str] = {
    "id": "concat(cast(l_orderkey as string),'-',cast(l_linenumber as string))",
    "customer_first_name": "split_part(c_name,'#',1)",
    "customer_last_name": "split_part(c_name,'#',2)",
    "customer_age": "CASE WHEN c_custkey%11=0 THEN 'n/a' WHEN c_custkey%13=0 THEN '' WHEN c_custkey%17=0 THEN NULL ELSE cast(18+c_custkey%60 as string) END",
    "customer_email": "CASE WHEN c_custkey%101=0 THEN NULL ELSE concat('c',cast(c_custkey as string),'@x.example') END",
    "customer_country": "cn.n_name",
    "customer_postal_code": "CASE WHEN c_custkey%7=0 THEN NULL ELSE cast(10000+c_custkey%90 as string) END",
    "customer_pet_type": "c_mktsegment",
    "customer_pet_name": "concat('Pet ',cast(l_partkey%5 as string))",
    "customer_pet_breed": "concat('Breed ',cast(l_suppkey%4 as string))",
    "seller_first_name": "'Seller'",
    "seller_last_name": "cast(o_orderkey%97 as string)",
    "seller_email": "concat('s',cast(o_orderkey%97 as string),'@x.example')",
    "seller_country": "o_orderpriority",
    "seller_postal_code": "CASE WHEN o_orderkey%5=0 THEN '' ELSE cast(20000+o_orderkey%9 as string) END",
    "product_name": "p_name",
    "product_category": "CASE WHEN p_size=1 THEN NULL WHEN p_size=2 THEN '' ELSE p_type END",
    "product_price": "cast(cast(p_retailprice as decimal(12,2)) as string)",
    "product_quantity": "CASE WHEN p_partkey%23=0 THEN '-1' ELSE cast(p_size as string) END",
    "sale_date": "CASE WHEN o_orderkey%211=0 THEN '' WHEN o_orderkey%223=0 THEN NULL ELSE concat(cast(month(o_orderdate) as string),'/',cast(day(o_orderdate) as string),'/',cast(year(o_orderdate) as string)) END",
    "sale_customer_id": "cast(o_custkey as string)",
    "sale_seller_id": "cast(o_orderkey%97 as string)",
    "sale_product_id": "cast(l_partkey as string)",
    "sale_quantity": "CASE WHEN l_orderkey%301=0 THEN '' WHEN l_orderkey%313=0 THEN concat(' +',cast(cast(l_quantity as int) as string),'.9 ') WHEN l_orderkey%317=0 THEN '.5' WHEN l_orderkey%331=0 THEN concat('-',cast(cast(l_quantity as int) as string),'.') ELSE cast(cast(l_quantity as int) as string) END",
    "sale_total_price": "CASE WHEN l_orderkey%307=0 THEN 'bad' WHEN l_orderkey%311=0 THEN concat(cast(l_linenumber as string),'.00000004') ELSE cast(cast(l_extendedprice as decimal(12,2)) as string) END",
    "store_name": "concat('Store ',cast(l_orderkey%13 as string))",
    "store_location": "CASE WHEN l_suppkey%6=0 THEN NULL ELSE concat('Unit ',cast(l_suppkey%6 as string)) END",
    "store_city": "CASE WHEN l_partkey%17=0 THEN '' WHEN l_partkey%17=1 THEN NULL ELSE concat('City ',cast(l_partkey%17 as string)) END",
    "store_state": "CASE WHEN l_suppkey%20=0 THEN 'State X' WHEN l_partkey%17=2 THEN NULL ELSE concat('State ',cast(l_partkey%17%4 as string)) END",
    "store_country": "concat('Country ',cast(l_partkey%17%3 as string))",
    "store_phone": "concat('555-',cast(1000+l_orderkey%13 as string))",
    "store_email": "concat('st',cast(l_orderkey%13 as string),'@x.example')",
    "pet_category": "l_returnflag",
    "product_weight": "concat(cast(p_size as string),'.',CASE WHEN p_partkey%25=0 THEN '505' ELSE '50' END)",
    "product_color": "split_part(p_name,' ',1)",
    "product_size": "CASE WHEN p_size<17 THEN 'S' WHEN p_size<34 THEN 'M' ELSE 'L' END",
    "product_brand": "p_brand",
    "product_material": "split_part(p_name,' ',2)",
    "product_description": "concat(p_name,', \"',p_type,'\"')",
    "product_rating": "CASE WHEN p_partkey%19=0 THEN 'N/A' ELSE concat(cast(1+p_partkey%4 as string),'.',cast(p_partkey%10 as string)) END",
    "product_reviews": "cast(p_partkey%500 as string)",
    "product_release_date": "concat(cast(1+p_partkey%12 as string),'/',cast(1+p_partkey%28 as string),'/2015')",
    "product_expiry_date": "CASE WHEN p_partkey%9=0 THEN '' ELSE concat(cast(1+p_partkey%12 as string),'/',cast(1+p_partkey%28 as string),'/2025') END",
    "supplier_name": "s_name",
    "supplier_contact": "concat('Contact ',cast(l_orderkey%3 as string))",
    "supplier_email": "CASE WHEN s_suppkey%50=0 THEN NULL ELSE concat('su',cast(s_suppkey as string),'@x.example') END",
    "supplier_phone": "concat('777-',cast(s_suppkey as string))",
    "supplier_address": "concat(cast(s_suppkey%40 as string),' High St')",
    "supplier_city": "concat('SCity ',cast(s_suppkey%12 as string))",
    "supplier_country": "sn.n_name",
}


# Values that the declared types cannot store, in place of some of the above: too long a name,
# integers and prices too wide, prices with three decimals, dates that do not exist.
BROKEN: dict[str, str] = {
    "customer_first_name": "CASE WHEN c_custkey%37=0 THEN repeat('x',201) ELSE split_part(c_name,'#',1) END",
    "product_quantity": "CASE WHEN p_partkey%29=0 THEN '99999999999' ELSE cast(p_size as string) END",
    "product_price": "CASE WHEN p_partkey%33=0 THEN '123456789012345.5' WHEN p_partkey%31=0 THEN concat(cast(cast(p_retailprice as decimal(12,2)) as string),'5') ELSE cast(cast(p_retailprice as decimal(12,2)) as string) END",
    "product_rating": "CASE WHEN p_partkey%41=0 THEN '1.0000000000000000001' WHEN p_partkey%41=1 THEN '4.55' ELSE concat(cast(1+p_partkey%4 as string),'.',cast(p_partkey%10 as string)) END",
    "sale_date": "CASE WHEN o_orderkey%227=0 THEN '13/45/2021' ELSE concat(cast(month(o_orderdate) as string),'/',cast(day(o_orderdate) as string),'/',cast(year(o_orderdate) as string)) END",
    "sale_quantity": "CASE WHEN l_orderkey%229=0 THEN '99999999999' ELSE cast(cast(l_quantity as int) as string) END",
}


def _of_parts(expression: str) -> bool:
    """Does an expression read columns of ``part`` and of no other table?"""
    return set(re.findall(r"\b(?:([closp])_|[cs]n\.)", expression)) == {"p"}


def staging_feed(
    spark: SparkSession, sf_dir: str, changes: Mapping[str, str] | None = None
) -> DataFrame:
    """The feed over every line item of ``sf_dir``; ``changes`` replace column expressions.

    Orders grow with the line items, so the two are always shuffled on the order
    key, which also spreads a feed that lies in few files; the other five joins are
    planned by size. Customers too many to broadcast meet the orders, which are fewer and narrower
    than the line items, before these do. What describes a part is made once per part, not once
    per sale; a cast that can raise is tried there and raises only in a sale. Column pruning reaches
    the scans, so a query that uses three feed columns reads only what those three need.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    expressions = {**STAGING_EXPRESSIONS, **(changes or {})}
    described = {c: e for c, e in expressions.items() if _of_parts(e)}
    can_raise = {c for c, e in described.items() if " as decimal" in e}
    tried = {c: e.replace("cast(p_", "try_cast(p_") for c, e in described.items()}
    parts = table("part").selectExpr("*", *[
        f"{tried[c] if c in can_raise else e} AS _{c}" for c, e in described.items()
    ])
    nation = table("nation")
    ordered = (
        table("orders")
        .join(table("customer"), on=_eq("o_custkey", "c_custkey"))
        .join(nation.alias("cn"), on=_eq("c_nationkey", "cn.n_nationkey"))
    )
    joined = (
        table("lineitem")
        .join(ordered.hint("merge"), on=_eq("l_orderkey", "o_orderkey"))
        .join(parts, on=_eq("l_partkey", "p_partkey"))
        .join(table("supplier"), on=_eq("l_suppkey", "s_suppkey"))
        .join(nation.alias("sn"), on=_eq("s_nationkey", "sn.n_nationkey"))
    )

    def of_sale(column: str, expression: str) -> str:
        if column not in described:
            return expression
        return f"coalesce(_{column}, {expression})" if column in can_raise else f"_{column}"

    return joined.selectExpr(*[f"{of_sale(c, e)} AS {c}" for c, e in expressions.items()])


def _eq(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)
