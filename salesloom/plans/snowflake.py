"""Snowflake model: seven sub-dimensions, six dimensions and the sales fact.

By default ids are content keys. A sub-dimension or dimension holds every key of
the staging rows it was built from, so wherever an equality join on the key must
match, the id is computed from the row instead. Joins stay where a match is not
implied: product to details, sale to product and sale to store. Pass the tables to
``*_by_lookup`` forms (or ``dense=True`` to ``build``) to look every id up.

Two rules of the model look like errors and are kept, because results depend on them:

- Product details store weight and rating rounded, and a product is matched to
  them by its unrounded values: a weight with three decimals finds nothing, one
  with two finds every row that rounds to it.
- A sale finds its store by name and its own location, and its product by name and
  category with NULL as ''. A store keeps one location per name and city, and NULL
  and '' categories are two products, so sales get lost or multiplied.

``quality.reconciliation`` counts both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesloom import schema
from salesloom.functions import parse
from salesloom.operators.contract import conform
from salesloom.operators.dedup import one_row_per_key, settled
from salesloom.operators.keys import (
    content_key,
    dense_key,
    dense_key_of_copies,
    packed,
    shown,
)
from salesloom.operators.lookup import lookup

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class SubDimension:
    """Distinct combinations of feed columns; ``columns`` is output -> feed column."""

    table: str
    id: str
    columns: dict[str, str]

    def key_of_row(self) -> Column:
        """The id a feed row points to."""
        return content_key(*[parse.null_to_empty(F.col(c)) for c in self.columns.values()])


# Sub-dimension columns and the feed columns they come from.
CUSTOMER_LOCATION = SubDimension(
    "d_customer_location", "location_id",
    {"country": "customer_country", "postal_code": "customer_postal_code"},
)
CUSTOMER_PET = SubDimension(
    "d_customer_pet", "pet_id",
    {
        "pet_type": "customer_pet_type", "pet_name": "customer_pet_name",
        "pet_breed": "customer_pet_breed", "pet_category": "pet_category",
    },
)
SELLER_LOCATION = SubDimension(
    "d_seller_location", "location_id",
    {"country": "seller_country", "postal_code": "seller_postal_code"},
)
STORE_LOCATION = SubDimension(
    "d_store_location", "location_id",
    {"city": "store_city", "state": "store_state", "country": "store_country"},
)
SUPPLIER_LOCATION = SubDimension(
    "d_supplier_location", "location_id",
    {"address": "supplier_address", "city": "supplier_city", "country": "supplier_country"},
)
PRODUCT_CATEGORY = SubDimension(
    "d_product_category", "category_id", {"category_name": "product_category"}
)
SUB_DIMENSIONS = (
    CUSTOMER_LOCATION, CUSTOMER_PET, SELLER_LOCATION, STORE_LOCATION, SUPPLIER_LOCATION,
    PRODUCT_CATEGORY,
)

# Product details, output -> (feed column, strict type).
DETAILS = {
    "weight": ("product_weight", "decimal"),
    "color": ("product_color", "text"),
    "size": ("product_size", "text"),
    "brand": ("product_brand", "text"),
    "material": ("product_material", "text"),
    "description": ("product_description", "text"),
    "rating": ("product_rating", "decimal"),
    "reviews": ("product_reviews", "int"),
    "release_date": ("product_release_date", "date"),
    "expiry_date": ("product_expiry_date", "date"),
}
NULLABLE_DETAILS = tuple(n for n, (_, kind) in DETAILS.items() if kind != "text")


@dataclass(frozen=True)
class Dimension:
    """A dimension of one feed entity that points to sub-dimensions.

    ``columns`` is output -> feed column; feed columns named in ``emptied`` have
    NULL stored as ''.
    """

    table: str
    entity: schema.Entity
    columns: dict[str, str]
    points_to: tuple[SubDimension, ...]
    emptied: tuple[str, ...]


# Dimension columns and the feed columns they come from.
CUSTOMER = Dimension(
    "d_customer", schema.CUSTOMER,
    {
        "first_name": "customer_first_name", "last_name": "customer_last_name",
        "age": "customer_age", "email": "customer_email",
    },
    (CUSTOMER_PET, CUSTOMER_LOCATION),
    (
        "customer_country", "customer_postal_code", "customer_pet_type",
        "customer_pet_name", "customer_pet_breed", "pet_category",
    ),
)
SELLER = Dimension(
    "d_seller", schema.SELLER,
    {
        "first_name": "seller_first_name", "last_name": "seller_last_name",
        "email": "seller_email",
    },
    (SELLER_LOCATION,),
    ("seller_country", "seller_postal_code"),
)
STORE = Dimension(
    "d_store", schema.STORE,
    {
        "name": "store_name", "location_detail": "store_location",
        "phone": "store_phone", "email": "store_email",
    },
    (STORE_LOCATION,),
    # The city is part of the business key: NULL and '' are one store here.
    ("store_location", "store_city", "store_state", "store_country"),
)
SUPPLIER = Dimension(
    "d_supplier", schema.SUPPLIER,
    {
        "name": "supplier_name", "contact": "supplier_contact",
        "email": "supplier_email", "phone": "supplier_phone",
    },
    (SUPPLIER_LOCATION,),
    ("supplier_address", "supplier_city", "supplier_country"),
)
DIMENSIONS = (CUSTOMER, SELLER, STORE, SUPPLIER)


def _assign(df: DataFrame, id_column: str, by, dense: bool, key: Column | None = None) -> DataFrame:
    key = content_key(*[F.col(c) for c in by]) if key is None else key
    return dense_key(df, id_column, by, key=key) if dense else df.withColumn(id_column, key)


def _rules(enforce: bool) -> dict:
    """How text is read: what cannot be held raises, or is left for the audit to count."""
    return parse.STRICT if enforce else parse.LENIENT


def _declared(df: DataFrame, table: str, enforce: bool) -> DataFrame:
    columns = schema.SNOWFLAKE_COLUMNS[table]
    return conform(df, columns) if enforce else df.select(*[c for c in columns if c in df.columns])


# --- sub-dimensions -----------------------------------------------------------


def sub_dimension(
    staging: DataFrame, spec: SubDimension, dense: bool = False, enforce: bool = True
) -> DataFrame:
    """Distinct combinations of the feed columns, NULL as '', with an id."""
    rows = staging.select(
        *[parse.null_to_empty(F.col(c)).alias(n) for n, c in spec.columns.items()]
    ).distinct()
    return _declared(_assign(rows, spec.id, spec.columns, dense), spec.table, enforce)


def _parsed_details(rows: DataFrame, *keep: str, enforce: bool = True) -> DataFrame:
    """The ten details of each row, unrounded, beside the columns in ``keep``.

    ``_beyond`` holds the digits of decimals that the parsed type cannot, '' as a rule.
    """

    def value(feed_column: str, kind: str) -> Column:
        text = F.col(feed_column)
        return parse.null_to_empty(text) if kind == "text" else _rules(enforce)[kind](text)

    digits = [parse.beyond_scale(F.col(c)) for c, kind in DETAILS.values() if kind == "decimal"]
    beyond = F.when(F.concat(*digits) != "", F.concat_ws("|", *digits)).otherwise("")
    return rows.select(
        *keep, *[value(c, k).alias(n) for n, (c, k) in DETAILS.items()], beyond.alias("_beyond")
    )


def product_details(staging: DataFrame, dense: bool = False, enforce: bool = True) -> DataFrame:
    """Distinct parsed details; distinct is taken before weight and rating are rounded.

    Distinct texts come first, so each is parsed once and not once per sale. Details that differ
    only in digits no type holds are different details.
    """
    columns = [c for c, _ in DETAILS.values()]
    texts = settled(staging.select(*columns).distinct(), *columns)
    rows = _parsed_details(texts, enforce=enforce).distinct()
    values, beyond = [F.col(n) for n in DETAILS], F.col("_beyond")
    key = F.when(beyond == "", content_key(*values)).otherwise(content_key(*values, beyond))
    return _declared(
        _assign(rows, "details_id", DETAILS, dense, key), "d_product_details", enforce
    )


def date_dimension(staging: DataFrame, dense: bool = False, enforce: bool = True) -> DataFrame:
    """Distinct sale dates read strictly; NULL and '' are left out."""
    texts = settled(
        staging.select("sale_date").filter(parse.is_filled(F.col("sale_date"))).distinct(),
        "sale_date",
    )
    dates = texts.select(_rules(enforce)["date"](F.col("sale_date")).alias("full_date")).distinct()
    if not enforce:
        dates = dates.filter(F.col("full_date").isNotNull())
    keyed = _assign(dates, "date_id", ["full_date"], dense)
    parts = parse.date_parts(F.col("full_date"))
    return _declared(
        keyed.select("date_id", "full_date", *[p.alias(n) for n, p in parts.items()]),
        "d_date", enforce,
    )


# --- dimensions ---------------------------------------------------------------


def _winners(staging: DataFrame, spec: Dimension) -> DataFrame:
    entity = spec.entity
    rows = staging.select(
        *[
            parse.null_to_empty(F.col(c)).alias(c) if c in spec.emptied else c
            for c in entity.key + entity.payload
        ]
    )
    return one_row_per_key(rows, entity.key, entity.payload)


def dimension(
    staging: DataFrame,
    spec: Dimension,
    tables: Tables | None = None,
    dense: bool = False,
    enforce: bool = True,
) -> DataFrame:
    """One row per business key with the ids of its sub-dimension rows.

    With ``tables`` the ids are looked up there (inner join), else computed.
    """
    winners = _assign(_winners(staging, spec), spec.entity.id, spec.entity.key, dense)
    for sub in spec.points_to:
        if tables is None:
            winners = winners.withColumn(sub.id, sub.key_of_row())
        else:
            on = {feed: name for name, feed in sub.columns.items()}
            winners = lookup(winners, tables[sub.table], on, [sub.id], "inner")
    columns = {
        name: _rules(enforce)["int"](F.col(c)) if c in spec.entity.parsed else F.col(c)
        for name, c in spec.columns.items()
    }
    return _declared(
        winners.select(
            spec.entity.id, *[c.alias(n) for n, c in columns.items()],
            *[sub.id for sub in spec.points_to],
        ),
        spec.table, enforce,
    )


def product(
    staging: DataFrame,
    details: DataFrame,
    categories: DataFrame | None = None,
    dense: bool = False,
    enforce: bool = True,
) -> DataFrame:
    """Products joined to every details row that stores exactly their parsed values.

    A product can match no details row or several, so the id covers both. One with digits
    that no stored value holds matches nothing.
    """
    winners = one_row_per_key(staging, schema.PRODUCT.key, schema.PRODUCT.payload)
    kept = [*schema.PRODUCT.key, "product_price", "product_quantity"]
    parsed = _parsed_details(winners, *kept, enforce=enforce)
    parsed = parsed.filter(F.col("_beyond") == "").drop("_beyond")
    # Stored values are rounded, the product's are not: compare them at full width.
    stored = details.select(
        "details_id",
        *[
            F.col(n).cast(parse.EXACT_DECIMAL).alias(n) if kind == "decimal" else n
            for n, (_, kind) in DETAILS.items()
        ],
    )
    matched = lookup(
        parsed, stored, {n: n for n in DETAILS}, ["details_id"], "inner", NULLABLE_DETAILS
    )
    if categories is None:
        matched = matched.withColumn("category_id", PRODUCT_CATEGORY.key_of_row())
    else:
        matched = lookup(
            matched.withColumn("_category", parse.null_to_empty(F.col("product_category"))),
            categories, {"_category": "category_name"}, ["category_id"], "inner",
        )
    keyed = _assign(
        matched, "product_id", ["product_name", "product_category", "details_id"], dense
    )
    return _declared(
        keyed.select(
            "product_id",
            F.col("product_name").alias("name"),
            _rules(enforce)["decimal"](F.col("product_price")).alias("price"),
            _rules(enforce)["int"](F.col("product_quantity")).alias("quantity"),
            "category_id", "details_id",
        ),
        "d_product", enforce,
    )


# --- fact ---------------------------------------------------------------------

# Dimension -> (feed column -> dimension column) of plain name-and-email keys.
_BY_NAME = {
    "d_customer": {
        "customer_first_name": "first_name", "customer_last_name": "last_name",
        "customer_email": "email",
    },
    "d_seller": {
        "seller_first_name": "first_name", "seller_last_name": "last_name",
        "seller_email": "email",
    },
    "d_supplier": {"supplier_name": "name", "supplier_email": "email"},
}


def _measures(enforce: bool) -> list[Column]:
    rules = _rules(enforce)
    return [
        rules["int"](F.col("sale_quantity")).alias("sale_quantity"),
        rules["decimal"](F.col("sale_total_price")).alias("sale_total_price"),
    ]


def _fact_columns(sales: DataFrame, enforce: bool) -> DataFrame:
    declared = {k: v for k, v in schema.SNOWFLAKE_COLUMNS["f_sale"].items() if k != "sale_id"}
    return conform(sales, declared) if enforce else sales.select(*declared)


def fact(staging: DataFrame, tables: Tables, enforce: bool = True) -> DataFrame:
    """Sales that find all six dimensions, without ``sale_id``.

    Customer, seller, supplier and date ids are computed: a complete key always
    has its row. Only ``d_product`` and ``d_store`` are joined.
    """
    named = (CUSTOMER, SELLER, SUPPLIER)
    names = [c for d in named for c in d.entity.key]
    complete = reduce(and_, [F.col(c).isNotNull() for c in [*names, "sale_date"]])
    dated = staging.filter(complete).withColumn(
        "full_date", parse.permissive_date(F.col("sale_date"))
    )
    sales = dated.filter(F.col("full_date").isNotNull()).select(
        *_measures(enforce),
        *[
            content_key(*[F.col(c) for c in d.entity.key]).alias(d.entity.id) for d in named
        ],
        content_key(F.col("full_date")).alias("date_id"),
        "product_name", "store_name",
        PRODUCT_CATEGORY.key_of_row().alias("category_id"),
        STORE_LOCATION.key_of_row().alias("location_id"),
    )
    return _fact_columns(_join_product_and_store(sales, tables), enforce)


def _join_product_and_store(sales: DataFrame, tables: Tables) -> DataFrame:
    sales = lookup(
        sales, tables["d_product"], {"product_name": "name", "category_id": "category_id"},
        ["product_id"], "inner",
    ).drop("product_name", "category_id")
    return lookup(
        sales, tables["d_store"], {"store_name": "name", "location_id": "location_id"},
        ["store_id"], "inner",
    ).drop("store_name", "location_id")


def fact_by_lookup(
    staging: DataFrame, tables: Tables, enforce: bool = True, pack: Sequence[str] = ()
) -> DataFrame:
    """The same fact with every id looked up: six inner joins, whatever the ids are.

    The category and the store location of a sale are resolved to their ids first
    and then used as part of the product and store keys. Each of the two must be found once: a
    loaded table that holds one twice raises, rather than doubling sales (an audit goes on).
    Dimensions that are small as a rule come first and take their columns out of the rows, so what
    a large one shuffles is narrow. Ids named in ``pack`` must be content keys; they are shuffled as 16
    bytes.
    """
    sales = staging.select(
        *_measures(enforce),
        parse.permissive_date(F.col("sale_date")).alias("full_date"),
        "product_name", "store_name",
        *[c for on in _BY_NAME.values() for c in on],
        *[
            parse.null_to_empty(F.col(c)).alias(c)
            for sub in (PRODUCT_CATEGORY, STORE_LOCATION) for c in sub.columns.values()
        ],
    )
    def by_name(sales: DataFrame, table: str) -> DataFrame:
        on = _BY_NAME[table]
        return lookup(sales, tables[table], on, [schema.primary_key(table)], "inner").drop(*on)

    sales = lookup(sales, tables["d_date"], {"full_date": "full_date"}, ["date_id"], "inner")
    sales = by_name(sales.drop("full_date"), "d_seller")
    for sub in (PRODUCT_CATEGORY, STORE_LOCATION):
        on = {feed: name for name, feed in sub.columns.items()}
        sales = lookup(sales, tables[sub.table], on, [sub.id], "inner", single=enforce).drop(*on)
    sales = _join_product_and_store(sales, tables)
    for table in ("d_supplier", "d_customer"):
        texts = [f.name for f in sales.schema if isinstance(f.dataType, T.StringType)]
        sales = by_name(packed(sales, [c for c in pack if c in texts]), table)
    binary = [f.name for f in sales.schema if isinstance(f.dataType, T.BinaryType)]
    return _fact_columns(shown(sales, [c for c in pack if c in binary]), enforce)


def number_sales(sales: DataFrame) -> DataFrame:
    """Add ``sale_id`` 1..n. Sales have no natural key and may be equal."""
    # Ids that are text are content keys.
    texts = [f.name for f in sales.schema if isinstance(f.dataType, T.StringType)]
    return dense_key_of_copies(sales, "sale_id", pack=texts)


# --- for audits -----------------------------------------------------------------


def as_stored(table: str, raw: DataFrame) -> DataFrame:
    """A table built with ``enforce=False`` in its declared types, NULL where a value breaks
    them: audits go on where a build would stop."""
    declared = schema.SNOWFLAKE_COLUMNS[table]
    return conform(raw, {c: d for c, d in declared.items() if c in raw.columns}, strict=False)


# --- whole model --------------------------------------------------------------


def sub_dimensions(
    staging: DataFrame, dense: bool = False, enforce: bool = True
) -> dict[str, DataFrame]:
    tables = {s.table: sub_dimension(staging, s, dense, enforce) for s in SUB_DIMENSIONS}
    tables["d_product_details"] = product_details(staging, dense, enforce)
    tables["d_date"] = date_dimension(staging, dense, enforce)
    return tables


def dimensions(
    staging: DataFrame, subs: Tables, dense: bool = False, enforce: bool = True
) -> dict[str, DataFrame]:
    """The five entity dimensions; dense ids of ``subs`` are looked up, content ids computed."""
    tables = {
        d.table: dimension(staging, d, subs if dense else None, dense, enforce)
        for d in DIMENSIONS
    }
    tables["d_product"] = product(
        staging, subs["d_product_details"],
        subs["d_product_category"] if dense else None, dense, enforce,
    )
    return tables


def build(
    staging: DataFrame, dense: bool = False, enforce: bool = True, numbered: bool = True
) -> dict[str, DataFrame]:
    """All fourteen tables as plans over ``staging``, in the order they can be written."""
    tables = sub_dimensions(staging, dense, enforce)
    tables.update(dimensions(staging, tables, dense, enforce))
    resolve = fact_by_lookup if dense else fact
    sales = resolve(staging, tables, enforce)
    tables["f_sale"] = number_sales(sales) if numbered else sales
    return tables
