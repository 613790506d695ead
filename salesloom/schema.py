"""Table layouts, business keys and output types, declared as data.

Everything in this file is a fixed value of the data model: column names, key
columns, declared lengths and precisions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The staging feed, in file order. All columns are nullable text.
STAGING_COLUMNS = (
    "id",
    "customer_first_name", "customer_last_name", "customer_age", "customer_email",
    "customer_country", "customer_postal_code",
    "customer_pet_type", "customer_pet_name", "customer_pet_breed",
    "seller_first_name", "seller_last_name", "seller_email",
    "seller_country", "seller_postal_code",
    "product_name", "product_category", "product_price", "product_quantity",
    "sale_date", "sale_customer_id", "sale_seller_id", "sale_product_id",
    "sale_quantity", "sale_total_price",
    "store_name", "store_location", "store_city", "store_state", "store_country",
    "store_phone", "store_email",
    "pet_category",
    "product_weight", "product_color", "product_size", "product_brand",
    "product_material", "product_description", "product_rating", "product_reviews",
    "product_release_date", "product_expiry_date",
    "supplier_name", "supplier_contact", "supplier_email", "supplier_phone",
    "supplier_address", "supplier_city", "supplier_country",
)

STAGING_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in STAGING_COLUMNS]
)

# Fixed value: dates in the feed are month/day/year, with or without leading zeros.
DATE_FORMAT = "M/d/yyyy"


@dataclass(frozen=True)
class Entity:
    """A dimension found in the feed by its business key.

    ``payload`` is also the order that decides which of several conflicting
    descriptions of one key is kept: the smallest, nulls first.
    """

    table: str
    id: str
    key: tuple[str, ...]
    payload: tuple[str, ...]
    parsed: dict[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ()


# The star dimensions. ``columns`` is the output order.
CUSTOMER = Entity(
    table="dim_customer",
    id="customer_id",
    key=("customer_first_name", "customer_last_name", "customer_email"),
    payload=(
        "customer_age", "customer_country", "customer_postal_code",
        "customer_pet_type", "customer_pet_name", "customer_pet_breed", "pet_category",
    ),
    parsed={"customer_age": "int"},
    columns=(
        "customer_first_name", "customer_last_name", "customer_age", "customer_email",
        "customer_country", "customer_postal_code",
        "customer_pet_type", "customer_pet_name", "customer_pet_breed", "pet_category",
        "customer_id",
    ),
)
SELLER = Entity(
    table="dim_seller",
    id="seller_id",
    key=("seller_first_name", "seller_last_name", "seller_email"),
    payload=("seller_country", "seller_postal_code"),
    columns=(
        "seller_first_name", "seller_last_name", "seller_email",
        "seller_country", "seller_postal_code", "seller_id",
    ),
)
PRODUCT = Entity(
    table="dim_product",
    id="product_id",
    key=("product_name", "product_category"),
    payload=(
        "product_price", "product_quantity", "product_weight", "product_color",
        "product_size", "product_brand", "product_material", "product_description",
        "product_rating", "product_reviews", "product_release_date", "product_expiry_date",
    ),
    parsed={
        "product_price": "double",
        "product_quantity": "int",
        "product_weight": "double",
        "product_rating": "double",
        "product_reviews": "int",
    },
    columns=(
        "product_name", "product_category", "product_price", "product_quantity",
        "product_weight", "product_color", "product_size", "product_brand",
        "product_material", "product_description", "product_rating", "product_reviews",
        "product_release_date", "product_expiry_date", "product_id",
    ),
)
STORE = Entity(
    table="dim_store",
    id="store_id",
    key=("store_name", "store_city"),
    payload=("store_location", "store_phone", "store_email", "store_state", "store_country"),
    columns=(
        "store_name", "store_location", "store_city", "store_state", "store_country",
        "store_phone", "store_email", "store_id",
    ),
)
SUPPLIER = Entity(
    table="dim_supplier",
    id="supplier_id",
    key=("supplier_name", "supplier_email"),
    payload=(
        "supplier_contact", "supplier_phone", "supplier_address",
        "supplier_city", "supplier_country",
    ),
    columns=(
        "supplier_name", "supplier_contact", "supplier_email", "supplier_phone",
        "supplier_address", "supplier_city", "supplier_country", "supplier_id",
    ),
)

STAR_ENTITIES = (CUSTOMER, SELLER, PRODUCT, STORE, SUPPLIER)

STAR_TABLES = (
    "dim_customer", "dim_seller", "dim_product", "dim_store", "dim_supplier", "dim_date",
    "fact_sales",
)
# Which dimension each id of the star fact points to.
STAR_REFERENCES = {
    "customer_id": "dim_customer",
    "seller_id": "dim_seller",
    "product_id": "dim_product",
    "store_id": "dim_store",
    "supplier_id": "dim_supplier",
    "date_id": "dim_date",
}
MART_TABLES = (
    "mart_product_sales", "mart_customer_sales", "mart_time_sales",
    "mart_store_sales", "mart_supplier_sales", "mart_product_quality",
)

# Declared column types of the snowflake tables, in output order.
# "key" is a surrogate id; its type follows the kind of key the build assigns.
SNOWFLAKE_COLUMNS: dict[str, dict[str, str]] = {
    "d_customer_location": {
        "location_id": "key", "country": "varchar(200)", "postal_code": "varchar(50)",
    },
    "d_customer_pet": {
        "pet_id": "key", "pet_type": "varchar(100)", "pet_name": "varchar(200)",
        "pet_breed": "varchar(200)", "pet_category": "varchar(100)",
    },
    "d_seller_location": {
        "location_id": "key", "country": "varchar(200)", "postal_code": "varchar(50)",
    },
    "d_store_location": {
        "location_id": "key", "city": "varchar(200)", "state": "varchar(200)",
        "country": "varchar(200)",
    },
    "d_supplier_location": {
        "location_id": "key", "address": "varchar(300)", "city": "varchar(200)",
        "country": "varchar(200)",
    },
    "d_product_category": {"category_id": "key", "category_name": "varchar(200)"},
    "d_product_details": {
        "details_id": "key", "weight": "decimal(10,2)", "color": "varchar(100)",
        "size": "varchar(50)", "brand": "varchar(200)", "material": "varchar(200)",
        "description": "string", "rating": "decimal(3,1)", "reviews": "int",
        "release_date": "date", "expiry_date": "date",
    },
    "d_customer": {
        "customer_id": "key", "first_name": "varchar(200)", "last_name": "varchar(200)",
        "age": "int", "email": "varchar(300)", "pet_id": "key", "location_id": "key",
    },
    "d_seller": {
        "seller_id": "key", "first_name": "varchar(200)", "last_name": "varchar(200)",
        "email": "varchar(300)", "location_id": "key",
    },
    "d_product": {
        "product_id": "key", "name": "varchar(300)", "price": "decimal(10,2)",
        "quantity": "int", "category_id": "key", "details_id": "key",
    },
    "d_store": {
        "store_id": "key", "name": "varchar(300)", "location_detail": "varchar(300)",
        "phone": "varchar(50)", "email": "varchar(300)", "location_id": "key",
    },
    "d_supplier": {
        "supplier_id": "key", "name": "varchar(300)", "contact": "varchar(300)",
        "email": "varchar(300)", "phone": "varchar(50)", "location_id": "key",
    },
    "d_date": {
        "date_id": "key", "full_date": "date", "day": "int", "month": "int",
        "year": "int", "quarter": "int",
    },
    "f_sale": {
        "sale_id": "key", "sale_quantity": "int", "sale_total_price": "decimal(12,2)",
        "customer_id": "key", "seller_id": "key", "product_id": "key", "store_id": "key",
        "supplier_id": "key", "date_id": "key",
    },
}

# child table, id column, parent table
SNOWFLAKE_REFERENCES = (
    ("d_customer", "pet_id", "d_customer_pet"),
    ("d_customer", "location_id", "d_customer_location"),
    ("d_seller", "location_id", "d_seller_location"),
    ("d_product", "category_id", "d_product_category"),
    ("d_product", "details_id", "d_product_details"),
    ("d_store", "location_id", "d_store_location"),
    ("d_supplier", "location_id", "d_supplier_location"),
    ("f_sale", "customer_id", "d_customer"),
    ("f_sale", "seller_id", "d_seller"),
    ("f_sale", "product_id", "d_product"),
    ("f_sale", "store_id", "d_store"),
    ("f_sale", "supplier_id", "d_supplier"),
    ("f_sale", "date_id", "d_date"),
)


def primary_key(table: str) -> str:
    """The surrogate id of a snowflake table: its first declared column."""
    return next(iter(SNOWFLAKE_COLUMNS[table]))
