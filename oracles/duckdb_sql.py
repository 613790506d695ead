"""One SQL text per registered query, over the given tables.

The data model comes from ``layout``, not from the package. Where the Spark plans compute ids from rows, reduce before joining or pick winners
with ``min(struct)``, the SQL joins every row to every dimension on the business key
and picks winners with ``row_number``.
"""

from __future__ import annotations

from oracles import layout

JOINED = """
SELECT {columns}
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
"""


def feed_sql(changes: dict[str, str]) -> str:
    columns = {**layout.FEED, **changes}
    return JOINED.format(columns=", ".join(f"{e} AS {c}" for c, e in columns.items()))


FEED, BROKEN_FEED = feed_sql({}), feed_sql(layout.BROKEN)


# --- expressions --------------------------------------------------------------


def key(*columns: str) -> str:
    parts = [
        f"CASE WHEN {c} IS NULL THEN 'n' "
        f"ELSE concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
        for c in columns
    ]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def complete(*columns: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def loose_int(c: str) -> str:
    """Blanks and control characters around are ignored, a fraction is cut off, and a missing
    digit counts as 0."""
    blank = r"[\x00-\x20\x7F]*"
    whole = rf"regexp_extract({c}, '^{blank}[+]?(-?[0-9]*)', 1)"
    return (
        rf"CASE WHEN regexp_full_match({c}, '{blank}([+-]?[0-9]+([.][0-9]*)?|[+-]?[.][0-9]*){blank}') "
        rf"THEN TRY_CAST(CASE WHEN {whole} IN ('', '-') THEN '0' ELSE {whole} END AS INTEGER) END"
    )


def loose_double(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def loose_date(c: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({c}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') "
        rf"THEN CAST(TRY_STRPTIME({c}, '%m/%d/%Y') AS DATE) END"
    )


def firm_int(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN CAST({c} AS INTEGER) END"


def firm_decimal(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}, '[0-9]+([.][0-9]+)?') "
        f"THEN CAST({c} AS DECIMAL(38,18)) END"
    )


def firm_date(c: str) -> str:
    return f"CASE WHEN length({c}) > 0 THEN CAST(STRPTIME({c}, '%m/%d/%Y') AS DATE) END"


def wide_int(c: str) -> str:
    """Any width, for audits."""
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN TRY_CAST({c} AS DECIMAL(38,0)) END"


def wide_decimal(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}, '[0-9]+([.][0-9]+)?') "
        f"THEN TRY_CAST({c} AS DECIMAL(38,18)) END"
    )


BEYOND = "[0-9]+[.][0-9]{18}[0-9]*[1-9][0-9]*"


def beyond(c: str) -> str:
    """Significant digits behind the eighteenth decimal place, '' if none."""
    return (
        f"CASE WHEN regexp_full_match(COALESCE({c}, ''), '{BEYOND}') "
        f"THEN rtrim(split_part({c}, '.', 2)[19:], '0') ELSE '' END"
    )


LOOSE = {"int": loose_int, "double": loose_double, "date": loose_date}
FIRM = {"int": firm_int, "decimal": firm_decimal, "date": firm_date}
WIDE = {"int": wide_int, "decimal": wide_decimal, "date": loose_date}


def calendar(date: str) -> str:
    return ", ".join(
        f"CAST({part}({date}) AS INTEGER) AS {part}" for part in ("day", "month", "year", "quarter")
    )


def winner(source: str, keys, order) -> str:
    """One row per key: the first in payload order."""
    by = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {by}) AS rn FROM {source}) WHERE rn = 1"
    )


def numbered(*columns: str) -> str:
    return f"row_number() OVER (ORDER BY {key(*columns)})"


def money(c: str, where: str = "") -> str:
    """The exact sum of doubles, rounded once: they are added in the digits they print."""
    return f"CAST(CAST(SUM(CAST(CAST({c} AS VARCHAR) AS DECIMAL(28,10))) AS VARCHAR) AS DOUBLE)"


def mean(c: str) -> str:
    return f"{money(c)} / COUNT({c})"


def with_(tables: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in tables.items()) + f"\n{select}"


# --- star ---------------------------------------------------------------------


def star_tables(dense: bool = False, feed: str = FEED, first: tuple = ()) -> dict[str, str]:
    """``first`` comes before the payload in the order that decides between descriptions."""
    make = numbered if dense else key
    tables = {"stg": feed}
    for e in layout.STAR_DIMENSIONS:
        columns = [
            f"{LOOSE[e['parsed'][c]](c)} AS {c}" if c in e["parsed"]
            else f"{make(*e['key'])} AS {c}" if c == e["id"] else c
            for c in e["columns"]
        ]
        tables[e["table"]] = (
            f"SELECT {', '.join(columns)} FROM ({winner('stg', e['key'], first + e['payload'])})"
        )
    tables["dim_date"] = (
        f"SELECT full_date, {make('full_date')} AS date_id, {calendar('full_date')} "
        f"FROM (SELECT DISTINCT {loose_date('sale_date')} AS full_date FROM stg)"
    )
    joins = " ".join(
        f"LEFT JOIN {e['table']} ON "
        + " AND ".join(f"r.{c} = {e['table']}.{c}" for c in e["key"])
        for e in layout.STAR_DIMENSIONS
    )
    ids = ", ".join(e["id"] for e in layout.STAR_DIMENSIONS)
    tables["fact_sales"] = (
        f"SELECT {ids}, date_id, {loose_int('r.sale_quantity')} AS sale_quantity, "
        f"{loose_double('r.sale_total_price')} AS sale_total_price FROM stg r {joins} "
        f"LEFT JOIN dim_date ON {loose_date('r.sale_date')} = dim_date.full_date"
    )
    return tables


def checks(total: str, n: str, average: str) -> str:
    return (
        f"{money('sale_total_price')} AS {total}, COUNT(*) AS {n}, "
        f"{mean('sale_total_price')} AS {average}"
    )


def mart_tables(feed: str = FEED, first: tuple = ()) -> dict[str, str]:
    tables = star_tables(feed=feed, first=first)
    revenue = f"{money('sale_total_price')} AS total_revenue"
    quantity = "CAST(SUM(sale_quantity) AS BIGINT) AS total_quantity_sold"
    rating = f"{mean('product_rating')} AS avg_rating"
    reviews = "CAST(SUM(product_reviews) AS BIGINT) AS total_reviews"
    price = f"{mean('product_price')} AS avg_product_price"
    by_product = "FROM fact_sales LEFT JOIN dim_product USING (product_id) GROUP BY ALL"
    tables["mart_product_sales"] = (
        f"SELECT product_name, product_category, {quantity}, {revenue}, {rating}, {reviews} "
        + by_product
    )
    tables["mart_product_quality"] = (
        f"SELECT product_name, product_category, {rating}, {reviews}, {quantity}, {revenue} "
        + by_product
    )
    tables["mart_customer_sales"] = (
        "SELECT concat_ws(' ', customer_first_name, customer_last_name) AS customer_name, "
        f"customer_country, {checks('total_spent', 'num_purchases', 'avg_check')} "
        "FROM fact_sales LEFT JOIN dim_customer USING (customer_id) GROUP BY ALL"
    )
    tables["mart_time_sales"] = (
        f"SELECT year, month, {checks('total_sales', 'num_orders', 'avg_order_size')} "
        "FROM fact_sales LEFT JOIN dim_date USING (date_id) GROUP BY ALL"
    )
    tables["mart_store_sales"] = (
        "SELECT store_name, store_city, store_country, "
        f"{checks('total_revenue', 'num_sales', 'avg_check')} "
        "FROM fact_sales LEFT JOIN dim_store USING (store_id) GROUP BY ALL"
    )
    tables["mart_supplier_sales"] = (
        f"SELECT supplier_name, supplier_country, {revenue}, {price}, "
        "COUNT(*) AS num_products_sold FROM fact_sales "
        "LEFT JOIN dim_supplier USING (supplier_id) LEFT JOIN dim_product USING (product_id) "
        "GROUP BY ALL"
    )
    return tables


def top(mart: str, where: str, measure: str, *ties: str) -> str:
    return (
        f"SELECT * FROM {mart} WHERE {where} "
        f"ORDER BY {measure} DESC NULLS LAST, {', '.join(t + ' NULLS FIRST' for t in ties)} LIMIT 10"
    )


def report_queries() -> dict[str, str]:
    product = "product_name IS NOT NULL"
    stores = (
        "SELECT {by}, COUNT(DISTINCT store_id) AS stores, "
        + checks("total_revenue", "num_sales", "avg_check")
        + " FROM fact_sales JOIN dim_store USING (store_id) GROUP BY {by}"
    )
    return {
        "top_products": top(
            "mart_product_sales", product, "total_revenue", "product_name", "product_category"
        ),
        "revenue_by_category": (
            "SELECT product_category, COUNT(*) AS products, "
            "CAST(SUM(total_quantity_sold) AS BIGINT) AS total_quantity_sold, "
            f"{money('total_revenue')} AS total_revenue "
            f"FROM mart_product_sales WHERE {product} GROUP BY product_category"
        ),
        "avg_rating_by_product": (
            "SELECT product_name, product_category, avg_rating FROM mart_product_sales "
            f"WHERE {product}"
        ),
        "top_customers": top(
            "mart_customer_sales", "customer_name <> ''", "total_spent",
            "customer_name", "customer_country",
        ),
        "customers_by_country": (
            "SELECT customer_country, COUNT(*) AS customers, "
            "CAST(SUM(num_purchases) AS BIGINT) AS num_purchases, "
            f"{money('total_spent')} AS total_spent "
            "FROM mart_customer_sales WHERE customer_name <> '' GROUP BY customer_country"
        ),
        "monthly_trend": (
            "SELECT year, month, total_sales, num_orders FROM mart_time_sales "
            "WHERE year IS NOT NULL"
        ),
        "avg_order_by_month": (
            "SELECT year, month, avg_order_size FROM mart_time_sales WHERE year IS NOT NULL"
        ),
        "yearly_trend": (
            f"SELECT year, {checks('total_sales', 'num_orders', 'avg_order_size')} "
            "FROM fact_sales JOIN dim_date USING (date_id) WHERE year IS NOT NULL GROUP BY year"
        ),
        "top_stores": top(
            "mart_store_sales", "store_name IS NOT NULL", "total_revenue",
            "store_name", "store_city", "store_country",
        ),
        "stores_by_city": stores.format(by="store_city"),
        "stores_by_country": stores.format(by="store_country"),
        "top_suppliers": top(
            "mart_supplier_sales", "supplier_name IS NOT NULL", "total_revenue",
            "supplier_name", "supplier_country",
        ),
        "suppliers_by_country": (
            "SELECT supplier_country, COUNT(DISTINCT supplier_id) AS suppliers, "
            f"{money('sale_total_price')} AS total_revenue, "
            f"{mean('product_price')} AS avg_product_price, "
            "COUNT(*) AS num_products_sold "
            "FROM fact_sales JOIN dim_supplier USING (supplier_id) "
            "LEFT JOIN dim_product USING (product_id) GROUP BY supplier_country"
        ),
        "rating_sales_corr": (
            "SELECT round(corr(avg_rating, total_quantity_sold), 9) AS rating_sales_corr "
            "FROM mart_product_quality"
        ),
        "most_reviewed": top(
            "mart_product_quality", product, "total_reviews", "product_name", "product_category"
        ),
    }


# --- snowflake ----------------------------------------------------------------


def emptied(c: str) -> str:
    return f"COALESCE({c}, '')"


def snowflake_tables(dense: bool = False, feed: str = FEED, audit: bool = False) -> dict[str, str]:
    """Tables ``w_*`` hold values before declared types, ``d_*`` and ``f_sale`` after. For an audit
    what a type cannot hold is NULL after it, where it is an error otherwise."""
    make = numbered if dense else key
    read = WIDE if audit else FIRM
    tables = {"stg": feed}
    subs = {table: (id_, columns) for table, id_, columns in layout.SUB_DIMENSIONS}

    for table, (id_, columns) in subs.items():
        distinct = ", ".join(f"{emptied(c)} AS {n}" for n, c in columns.items())
        tables[f"w_{table}"] = (
            f"SELECT {make(*columns)} AS {id_}, * FROM (SELECT DISTINCT {distinct} FROM stg)"
        )
    details = ", ".join(
        f"{emptied(c) if kind == 'text' else read[kind](c)} AS {n}"
        for n, (c, kind) in layout.DETAILS.items()
    )
    digits = [beyond(c) for c, kind in layout.DETAILS.values() if kind == "decimal"]
    more = f"CASE WHEN concat({', '.join(digits)}) <> '' THEN concat_ws('|', {', '.join(digits)}) ELSE '' END"
    plain, longer = key(*layout.DETAILS), key(*layout.DETAILS, "beyond")
    by = f"CASE WHEN beyond = '' THEN {plain} ELSE {longer} END"
    by = f"row_number() OVER (ORDER BY {by})" if dense else by
    tables["w_d_product_details"] = (
        f"SELECT {by} AS details_id, * FROM (SELECT DISTINCT {details}, {more} AS beyond FROM stg)"
    )
    tables["w_d_date"] = (
        f"SELECT {make('full_date')} AS date_id, full_date, {calendar('full_date')} FROM "
        f"(SELECT DISTINCT {read['date']('sale_date')} AS full_date FROM stg WHERE sale_date <> '') "
        "WHERE full_date IS NOT NULL"
    )
    for name in [*subs, "d_product_details", "d_date"]:
        tables[name] = typed(name, audit=audit)

    for d in layout.DIMENSIONS:
        source = ", ".join(
            f"{emptied(c)} AS {c}" if c in d["emptied"] else c for c in d["key"] + d["payload"]
        )
        values = [
            f"{read['int']('w.' + c) if c in d['parsed'] else 'w.' + c} AS {n}"
            for n, c in d["columns"].items()
        ]
        ids = [f"{s}.{subs[s][0]}" for s in d["points_to"]]
        joins = " ".join(
            f"JOIN {s} ON " + " AND ".join(f"{s}.{n} = w.{c}" for n, c in subs[s][1].items())
            for s in d["points_to"]
        )
        tables[f"w_{d['table']}"] = (
            f"SELECT {make(*['w.' + c for c in d['key']])} AS {d['id']}, {', '.join(values + ids)} "
            f"FROM ({winner(f'(SELECT {source} FROM stg)', d['key'], d['payload'])}) w {joins}"
        )
        tables[d["table"]] = typed(d["table"], audit=audit)

    p = next(e for e in layout.STAR_DIMENSIONS if e["table"] == "dim_product")
    on_details = " AND ".join(
        f"x.{n} = {emptied('w.' + c)}" if kind == "text"
        else f"x.{n} IS NOT DISTINCT FROM ({read[kind]('w.' + c)})"
        for n, (c, kind) in layout.DETAILS.items()
    )
    for c, kind in layout.DETAILS.values():
        if kind == "decimal":  # digits that no stored number has
            on_details += f" AND {beyond('w.' + c)} = ''"
    tables["w_d_product"] = (
        f"SELECT {make('w.product_name', 'w.product_category', 'x.details_id')} AS product_id, "
        f"w.product_name AS name, {read['decimal']('w.product_price')} AS price, "
        f"{read['int']('w.product_quantity')} AS quantity, g.category_id, x.details_id "
        f"FROM ({winner('stg', p['key'], p['payload'])}) w "
        f"JOIN d_product_category g ON g.category_name = {emptied('w.product_category')} "
        f"JOIN d_product_details x ON {on_details}"
    )
    tables["d_product"] = typed("d_product", audit=audit)

    named = " ".join(
        f"JOIN {t} ON " + " AND ".join(f"{t}.{n} = r.{c}" for c, n in on.items())
        for t, on in {
            "d_customer": {
                "customer_first_name": "first_name", "customer_last_name": "last_name",
                "customer_email": "email",
            },
            "d_seller": {
                "seller_first_name": "first_name", "seller_last_name": "last_name",
                "seller_email": "email",
            },
            "d_supplier": {"supplier_name": "name", "supplier_email": "email"},
        }.items()
    )
    tables["product_of_sale"] = (
        "SELECT p.product_id, p.name, g.category_name FROM d_product p "
        "JOIN d_product_category g USING (category_id)"
    )
    tables["store_of_sale"] = (
        "SELECT s.store_id, s.name, g.city, g.state, g.country FROM d_store s "
        "JOIN d_store_location g USING (location_id)"
    )
    tables["w_f_sale"] = (
        f"SELECT {read['int']('r.sale_quantity')} AS sale_quantity, "
        f"{read['decimal']('r.sale_total_price')} AS sale_total_price, "
        "customer_id, seller_id, product_id, store_id, supplier_id, date_id "
        f"FROM stg r {named} "
        f"JOIN d_date ON d_date.full_date = {loose_date('r.sale_date')} "
        "JOIN product_of_sale ps ON ps.name = r.product_name "
        f"AND ps.category_name = {emptied('r.product_category')} "
        "JOIN store_of_sale ss ON ss.name = r.store_name "
        f"AND ss.city = {emptied('r.store_city')} AND ss.state = {emptied('r.store_state')} "
        f"AND ss.country = {emptied('r.store_country')}"
    )
    tables["t_f_sale"] = typed("f_sale", skip=("sale_id",), audit=audit)
    measured = [c for c in layout.SNOWFLAKE_COLUMNS["f_sale"] if c != "sale_id"]
    tables["f_sale"] = f"SELECT {numbered(*measured)} AS sale_id, * FROM t_f_sale"
    return tables


def typed(table: str, skip=(), audit: bool = False) -> str:
    """The declared columns of ``w_table`` in their declared types."""
    def stored(c: str, d: str) -> str:
        if d.startswith("varchar") and audit:
            return f"CASE WHEN length(rtrim({c})) <= {d[8:-1]} THEN {c}[1:{d[8:-1]}] END AS {c}"
        if d in ("key", "string") or d.startswith("varchar"):
            return c
        return f"{'TRY_CAST' if audit else 'CAST'}({c} AS {d}) AS {c}"

    columns = [stored(c, d) for c, d in layout.SNOWFLAKE_COLUMNS[table].items() if c not in skip]
    return f"SELECT {', '.join(columns)} FROM w_{table}"


# --- two feeds, one after the other -----------------------------------------------

# Sales of even orders come first. A description of the first feed stays.
TWO_FEEDS = f"SELECT *, CAST(split_part(id, '-', 1) AS BIGINT) % 2 AS feed_no FROM ({FEED})"


def loaded_tables() -> dict[str, str]:
    """What both loads leave, without ids: each row with the feed that brought it."""
    tables = {"stg": TWO_FEEDS}
    for table, _, columns in layout.SUB_DIMENSIONS:
        distinct = ", ".join(f"{emptied(c)} AS {n}" for n, c in columns.items())
        tables[f"n_{table}"] = f"SELECT {distinct}, MIN(feed_no) AS feed_no FROM stg GROUP BY ALL"
    tables["n_d_date"] = (
        f"SELECT {firm_date('sale_date')} AS full_date, MIN(feed_no) AS feed_no FROM stg "
        "WHERE sale_date <> '' GROUP BY ALL"
    )
    for d in layout.DIMENSIONS:
        source = ", ".join(
            f"{emptied(c)} AS {c}" if c in d["emptied"] else c for c in d["key"] + d["payload"]
        )
        picked = winner(f"(SELECT {source}, feed_no FROM stg)", d["key"], ("feed_no",) + d["payload"])
        tables[f"n_{d['table']}"] = f"SELECT * EXCLUDE (rn) FROM ({picked})"

    values = {
        n: emptied(c) if kind == "text" else FIRM[kind](c) for n, (c, kind) in layout.DETAILS.items()
    }
    digits = [beyond(c) for c, kind in layout.DETAILS.values() if kind == "decimal"]
    more = f"concat_ws('|', {', '.join(digits)}) AS beyond"
    parsed = ", ".join(f"{v} AS {n}" for n, v in values.items())
    tables["unrounded"] = f"SELECT {parsed}, {more}, MIN(feed_no) AS feed_no FROM stg GROUP BY ALL"
    declared = layout.SNOWFLAKE_COLUMNS["d_product_details"]
    stored = ", ".join(
        n if declared[n] == "string" or declared[n].startswith("varchar")
        else f"CAST({n} AS {declared[n]}) AS {n}" for n in layout.DETAILS
    )
    tables["n_d_product_details"] = f"SELECT {stored}, feed_no FROM unrounded"
    product = next(e for e in layout.STAR_DIMENSIONS if e["table"] == "dim_product")
    picked = winner("stg", product["key"], ("feed_no",) + product["payload"])
    same = " AND ".join(f"x.{n} IS NOT DISTINCT FROM w.{n}" for n in layout.DETAILS)
    tables["described"] = (
        f"SELECT product_name, product_category, {firm_decimal('product_price')} AS price, "
        f"{firm_int('product_quantity')} AS quantity, {parsed}, {more}, feed_no FROM ({picked})"
    )
    tables["n_d_product"] = (
        f"SELECT w.product_name AS name, {emptied('w.product_category')} AS category_name, "
        "CAST(w.price AS DECIMAL(10,2)) AS price, w.quantity, x.* EXCLUDE (feed_no), w.feed_no "
        f"FROM described w JOIN n_d_product_details x ON {same} AND w.beyond = '|' "
        "AND x.feed_no <= w.feed_no"
    )
    named = complete(
        "customer_first_name", "customer_last_name", "customer_email", "seller_first_name",
        "seller_last_name", "seller_email", "supplier_name", "supplier_email",
    )
    tables["n_f_sale"] = (
        f"SELECT {firm_int('r.sale_quantity')} AS sale_quantity, "
        f"CAST({firm_decimal('r.sale_total_price')} AS DECIMAL(12,2)) AS sale_total_price, "
        "r.customer_email, r.seller_email, r.supplier_email, "
        f"{loose_date('r.sale_date')} AS full_date, r.product_name, p.category_name, p.weight, "
        "p.color, r.store_name, s.store_city AS city, s.store_state AS state, "
        f"s.store_country AS country, r.feed_no FROM (SELECT * FROM stg WHERE {named} "
        f"AND {loose_date('sale_date')} IS NOT NULL) r "
        f"JOIN n_d_product p ON p.name = r.product_name "
        f"AND p.category_name = {emptied('r.product_category')} AND p.feed_no <= r.feed_no "
        "JOIN n_d_store s ON s.store_name = r.store_name AND s.feed_no <= r.feed_no AND "
        + " AND ".join(f"s.{c} = {emptied('r.' + c)}" for c in ("store_city", "store_state", "store_country"))
    )
    return tables


def load_queries() -> dict[str, str]:
    tables = loaded_tables()
    star = star_tables(feed=TWO_FEEDS, first=("feed_no",))
    marts_ = mart_tables(TWO_FEEDS, ("feed_no",))
    first = "feed_no = 0 AS first_load"
    snow = list(layout.SNOWFLAKE_COLUMNS)
    counts = [
        f"SELECT '{t}' AS table_name, COUNT(*) FILTER (WHERE feed_no = 0) AS rows_before, "
        "COUNT(*) AS rows_after, CAST(1 AS BIGINT) AS lowest_id, COUNT(*) AS highest_id "
        f"FROM n_{t}" for t in snow
    ]
    customer = next(d for d in layout.DIMENSIONS if d["table"] == "d_customer")
    pet, place = [
        next(c for t, _, c in layout.SUB_DIMENSIONS if t == s)
        for s in ("d_customer_pet", "d_customer_location")
    ]
    shown = {**customer["columns"], **pet, **place}
    columns = ", ".join(
        f"{firm_int(c) if c in customer['parsed'] else c} AS {n}" for n, c in shown.items()
    )

    def line(rule: str, table: str, names: str, parent: str, bad: str, rows: str, done: str) -> str:
        return (
            f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{names}' AS column_names, "
            f"'{parent}' AS parent_table, CAST({bad} AS BIGINT) AS violations, "
            f"({rows}) AS rows_readable, {done} AS published"
        )

    star_ids = {e["table"]: e["id"] for e in layout.STAR_DIMENSIONS} | {"dim_date": "date_id"}
    clean = [
        line("unique", t, c, "", "0", f"SELECT COUNT(*) FROM n_{t}", "TRUE")
        for t, c in [*layout.PRIMARY_KEYS.items(), ("d_date", "full_date")] if t in snow
    ] + [
        line("unique", t, c, "", "0", f"SELECT COUNT(*) FROM {t}", "TRUE") for t, c in star_ids.items()
    ] + [
        line("reference", t, c, p, "0", f"SELECT COUNT(*) FROM n_{t}", "TRUE")
        for t, c, p in layout.SNOWFLAKE_REFERENCES
    ] + [
        line("reference", "fact_sales", c, p, "0", "SELECT COUNT(*) FROM fact_sales", "TRUE")
        for c, p in layout.STAR_REFERENCES.items()
    ]
    readable = "SELECT COUNT(*) FROM stg WHERE feed_no = 0"
    by = {e["id"]: e["key"] for e in layout.STAR_DIMENSIONS}
    known = {
        id_: f"SELECT DISTINCT {key(*names)} AS k FROM stg WHERE feed_no = 0 OR '{id_}' = 'customer_id'"
        for id_, names in by.items()
    }
    dated = f"(SELECT *, {loose_date('sale_date')} AS full_date FROM stg)"
    known["date_id"] = f"SELECT DISTINCT {key('full_date')} AS k FROM {dated} WHERE feed_no = 0"
    by["date_id"] = ("full_date",)
    customer_key = key(*by["customer_id"])
    twice = (
        f"(SELECT COUNT(*) FROM (SELECT {customer_key} AS k FROM stg GROUP BY 1 "
        "HAVING COUNT(DISTINCT feed_no) > 1))"
    )
    customers = f"SELECT COUNT(DISTINCT {customer_key}) FROM stg WHERE feed_no = 0"
    broken = [line("unique", "dim_customer", "customer_id", "", twice, customers, "FALSE")] + [
        line(
            "reference", "fact_sales", id_, layout.STAR_REFERENCES[id_],
            f"(SELECT COUNT(*) FROM {dated} WHERE feed_no = 1 AND {complete(*names)} "
            f"AND {key(*names)} NOT IN ({known[id_]}))", readable, "FALSE",
        )
        for id_, names in by.items()
    ]
    queries = {
        "load_row_counts": with_(tables, union(counts)),
        "load_customers": with_(tables, f"SELECT {columns}, {first} FROM n_d_customer"),
        "load_products": with_(tables, f"SELECT * EXCLUDE (feed_no), {first} FROM n_d_product"),
        "load_sales": with_(tables, f"SELECT * EXCLUDE (feed_no), {first} FROM n_f_sale"),
        "publish_clean": with_({**star, **tables}, union(clean)),
        "publish_broken": with_({"stg": TWO_FEEDS}, union(broken)),
    }
    for name in ("product", "customer", "supplier", "time"):
        queries[f"load_mart_{name}_sales"] = with_(marts_, f"SELECT * FROM mart_{name}_sales")
    return queries


# --- audits -------------------------------------------------------------------


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def counted(tables: dict[str, str]) -> str:
    return union(
        f"SELECT '{label}' AS table_name, COUNT(*) AS row_count FROM {name}"
        for label, name in tables.items()
    )


def duplicates(table: str, *keys: str) -> str:
    cols = ", ".join(keys)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns, "
        f"(SELECT COUNT(*) FROM {table}) AS row_count, "
        f"(SELECT COUNT(*) FROM {table} WHERE NOT ({complete(*keys)})) AS null_key_rows, "
        f"(SELECT COUNT(*) FROM (SELECT {cols} FROM {table} WHERE {complete(*keys)} "
        f"GROUP BY {cols} HAVING COUNT(*) > 1)) AS duplicate_keys"
    )


def orphans(table: str, column: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"'{parent}' AS parent_table, "
        f"(SELECT COUNT(*) FROM {table} WHERE {column} IS NULL) AS rows_without_id, "
        f"(SELECT COUNT(*) FROM {table} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{column})) AS orphan_rows"
    )


def contract() -> str:
    lines = []
    for table, columns in layout.SNOWFLAKE_COLUMNS.items():
        for c, declared in columns.items():
            if declared == "key":
                continue
            broken, changed = "FALSE", "FALSE"
            if declared.startswith("varchar"):
                broken = f"length(rtrim({c})) > {declared[8:-1]}"
            elif declared != "string":
                broken = f"{c} IS NOT NULL AND TRY_CAST({c} AS {declared}) IS NULL"
            if declared.startswith("decimal"):
                changed = f"CAST(TRY_CAST({c} AS {declared}) AS DECIMAL(38,18)) <> {c}"
            lines.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                f"'{declared}' AS declared_type, COUNT({c}) AS values_present, "
                f"COUNT(*) FILTER (WHERE {broken}) AS not_storable, "
                f"COUNT(*) FILTER (WHERE {changed}) AS rounded FROM w_{table}"
            )
    return union(lines)


def reconciliation() -> str:
    on = {
        "d_customer": (
            "d_customer", "t.first_name = r.customer_first_name "
            "AND t.last_name = r.customer_last_name AND t.email = r.customer_email"
        ),
        "d_seller": (
            "d_seller", "t.first_name = r.seller_first_name "
            "AND t.last_name = r.seller_last_name AND t.email = r.seller_email"
        ),
        "d_product": (
            "product_of_sale",
            f"t.name = r.product_name AND t.category_name = {emptied('r.product_category')}"
        ),
        "d_store": (
            "store_of_sale",
            f"t.name = r.store_name AND t.city = {emptied('r.store_city')} "
            f"AND t.state = {emptied('r.store_state')} AND t.country = {emptied('r.store_country')}"
        ),
        "d_supplier": (
            "d_supplier", "t.name = r.supplier_name AND t.email = r.supplier_email"
        ),
        "d_date": ("d_date", f"t.full_date = {loose_date('r.sale_date')}"),
    }
    lines = [
        f"SELECT '{name}' AS dimension, COUNT(*) AS staged_sales, "
        "COUNT(*) FILTER (WHERE n = 0) AS unmatched_sales, "
        "COUNT(*) FILTER (WHERE n > 1) AS multiplied_sales, "
        "CAST(SUM(n) AS BIGINT) AS sales_after "
        f"FROM (SELECT r.row_no, COUNT(t.name_or_id) AS n FROM numbered_stg r "
        f"LEFT JOIN (SELECT *, 1 AS name_or_id FROM {table}) t ON {condition} GROUP BY r.row_no)"
        for name, (table, condition) in on.items()
    ]
    lines.append(
        "SELECT 'f_sale' AS dimension, (SELECT COUNT(*) FROM stg) AS staged_sales, "
        "CAST(NULL AS BIGINT) AS unmatched_sales, CAST(NULL AS BIGINT) AS multiplied_sales, "
        "(SELECT COUNT(*) FROM f_sale) AS sales_after"
    )
    return union(lines)


def parse_failures() -> str:
    def line(rule: str, c: str, kind: str) -> str:
        filled = f"{c} IS NOT NULL AND {c} <> ''"
        unreadable, raises, inexact = "FALSE", "FALSE", "FALSE"
        if rule == "permissive":
            unreadable = f"{filled} AND ({LOOSE[kind](c)}) IS NULL"
            if kind == "double":
                inexact = (
                    f"{loose_double(c)} IS DISTINCT FROM CAST(TRY_CAST(CAST({loose_double(c)} "
                    f"AS VARCHAR) AS DECIMAL(28,10)) AS DOUBLE)"
                )
        elif kind == "date":
            raises = f"{filled} AND ({loose_date(c)}) IS NULL"
        else:
            pattern, name = {
                "int": ("[0-9]+", "INTEGER"), "decimal": ("[0-9]+([.][0-9]+)?", "DECIMAL(38,18)"),
            }[kind]
            unreadable = f"{filled} AND NOT regexp_full_match({c}, '{pattern}')"
            raises = f"regexp_full_match({c}, '{pattern}') AND TRY_CAST({c} AS {name}) IS NULL"
            if kind == "decimal":
                inexact = f"regexp_full_match({c}, '{BEYOND}')"
        return (
            f"SELECT '{rule}' AS rule, '{c}' AS column_name, '{kind}' AS read_as, "
            + ", ".join(
                f"COUNT(*) FILTER (WHERE {condition}) AS {name}"
                for name, condition in {
                    "filled": filled, "unreadable": unreadable, "raises": raises,
                    "inexact": inexact,
                }.items()
            )
            + " FROM stg"
        )

    return union(
        [line("strict", c, k) for c, k in layout.STRICT_COLUMNS.items()]
        + [line("permissive", c, k) for c, k in layout.PERMISSIVE_COLUMNS.items()]
    )


def parse_rejects() -> str:
    """Each text that a rule cannot read, told from the patterns and casts one by one."""
    def line(rule: str, c: str, kind: str) -> str:
        filled = f"{c} IS NOT NULL AND {c} <> ''"
        raises = "FALSE"
        if rule == "permissive":
            found = f"{filled} AND ({LOOSE[kind](c)}) IS NULL"
        elif kind == "date":
            found = raises = f"{filled} AND ({loose_date(c)}) IS NULL"
        else:
            pattern, name = {
                "int": ("[0-9]+", "INTEGER"), "decimal": ("[0-9]+([.][0-9]+)?", "DECIMAL(38,18)"),
            }[kind]
            raises = f"(regexp_full_match({c}, '{pattern}') AND TRY_CAST({c} AS {name}) IS NULL)"
            found = f"{filled} AND (NOT regexp_full_match({c}, '{pattern}') OR {raises})"
        return (
            f"SELECT id, '{rule}' AS rule, '{c}' AS column_name, {c} AS text, {raises} AS raises "
            f"FROM stg WHERE {found}"
        )

    return union(
        [line("strict", c, k) for c, k in layout.STRICT_COLUMNS.items()]
        + [line("permissive", c, k) for c, k in layout.PERMISSIVE_COLUMNS.items()]
    )


# --- all ----------------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    feed = {"stg": FEED}
    star, dense_star, mart = star_tables(), star_tables(dense=True), mart_tables()
    snow, dense_snow = snowflake_tables(), snowflake_tables(dense=True)
    numbers = ("customer_age", "product_quantity", "product_reviews", "sale_quantity")
    amounts = ("product_price", "product_weight", "product_rating", "sale_total_price")
    customer = ("customer_first_name", "customer_last_name", "customer_email")

    def parsed(rule_int, rule_number) -> str:
        columns = [f"{rule_int(c)} AS {c}" for c in numbers]
        columns += [f"{rule_number(c)} AS {c}" for c in amounts]
        return with_(feed, f"SELECT id, {', '.join(columns)} FROM stg")

    fact_key = f"CASE WHEN {complete(*customer)} THEN {key(*customer)} END"
    queries = {
        "stg_rows": with_(feed, "SELECT * FROM stg"),
        "parse_strict": parsed(firm_int, firm_decimal),
        "parse_permissive": parsed(loose_int, loose_double),
        "parse_dates": with_(
            feed,
            f"SELECT id, {firm_date('product_release_date')} AS release_date, "
            f"{firm_date('product_expiry_date')} AS expiry_date, sale AS sale_date, "
            f"{calendar('sale')} FROM (SELECT *, {loose_date('sale_date')} AS sale FROM stg)",
        ),
        "null_to_empty": with_(
            feed,
            "SELECT id, " + ", ".join(
                f"{emptied(c)} AS {c}" for c in (
                    "customer_postal_code", "store_city", "store_location", "product_category"
                )
            ) + " FROM stg",
        ),
        "hash_key": with_(
            feed,
            f"SELECT DISTINCT {', '.join(customer)}, {key(*customer)} AS dimension_id, "
            f"{fact_key} AS fact_id FROM stg",
        ),
        "dense_key": with_(
            dense_star, f"SELECT customer_id, {', '.join(customer)} FROM dim_customer"
        ),
    }
    for name, table in {
        "sub_customer_location": "d_customer_location", "sub_customer_pet": "d_customer_pet",
        "sub_seller_location": "d_seller_location", "sub_store_location": "d_store_location",
        "sub_supplier_location": "d_supplier_location",
        "sub_product_category": "d_product_category", "sub_product_details": "d_product_details",
        "snow_date": "d_date", "snow_customer": "d_customer", "snow_seller": "d_seller",
        "snow_product": "d_product", "snow_store": "d_store", "snow_supplier": "d_supplier",
        "snow_fact": "f_sale",
    }.items():
        queries[name] = with_(snow, f"SELECT * FROM {table}")
    queries["snow_fact_lookup"] = with_(dense_snow, "SELECT * FROM t_f_sale")
    for name in ("customer", "seller", "store", "supplier"):
        queries[f"snow_{name}_lookup"] = with_(dense_snow, f"SELECT * FROM d_{name}")
    queries["snow_product_lookup"] = with_(dense_snow, "SELECT * FROM d_product")
    for table in layout.STAR_TABLES:
        queries[table] = with_(star, f"SELECT * FROM {table}")
    queries["fact_sales_lookup"] = with_(dense_star, "SELECT * FROM fact_sales")
    for table in layout.MART_TABLES:
        queries[table] = with_(mart, f"SELECT * FROM {table}")
    for name, sql in report_queries().items():
        queries[name] = with_(mart, sql)

    snow_names = {t: t for t in layout.SNOWFLAKE_COLUMNS}
    queries["dq_duplicate_keys"] = with_(snow, union(
        [duplicates(t, layout.PRIMARY_KEYS[t]) for t in layout.SNOWFLAKE_COLUMNS]
        + [duplicates(t, *k) for t, k in layout.BUSINESS_KEYS.items()]
    ))
    both = {**snow, **{t: sql for t, sql in star.items() if t != "stg"}}
    queries["dq_orphans"] = with_(both, union(
        [orphans(t, c, p, layout.PRIMARY_KEYS[p]) for t, c, p in layout.SNOWFLAKE_REFERENCES]
        + [orphans("fact_sales", c, p, c) for c, p in layout.STAR_REFERENCES.items()]
    ))
    queries["dq_row_counts"] = with_(snow, counted({"raw_data": "stg", **snow_names}))
    star_names = {t: t for t in layout.STAR_TABLES + layout.MART_TABLES}
    queries["dq_row_counts_star"] = with_(mart, counted({"staging": "stg", **star_names}))
    rows = {"numbered_stg": "SELECT *, row_number() OVER () AS row_no FROM stg"}
    broken = snowflake_tables(feed=BROKEN_FEED, audit=True)
    queries["dq_contract"] = with_(snow, contract())
    queries["dq_contract_broken"] = with_(broken, contract())
    queries["dq_reconciliation"] = with_({**snow, **rows}, reconciliation())
    queries["dq_reconciliation_broken"] = with_({**broken, **rows}, reconciliation())
    described = "product_description || chr(13) || chr(10) || 'second \"line\"' || chr(10) || id"
    queries["io_csv"] = with_(
        feed, f"SELECT * REPLACE ({described} AS product_description) FROM stg"
    )
    queries["io_overwrite"] = with_(
        star, "SELECT *, (SELECT COUNT(*) FROM dim_date) AS written FROM dim_date"
    )
    queries["io_append"] = with_(star, "SELECT * FROM dim_date")
    queries["dq_parse_failures"] = with_(feed, parse_failures())
    queries["sale_ids_by_place"] = with_(
        snow, "SELECT *, CAST(1 AS BIGINT) AS lowest_id, COUNT(*) OVER () AS highest_id, "
        "COUNT(*) OVER () AS different_ids FROM t_f_sale",
    )
    queries.update(load_queries())
    queries["parse_rejects"] = with_({"stg": BROKEN_FEED}, parse_rejects())
    order = "CAST(split_part(id, '-', 1) AS BIGINT)"
    queries["csv_rejects"] = with_(feed, union([
        "SELECT id, CAST(NULL AS VARCHAR) AS reason FROM stg",
        *[f"SELECT id, 'number of fields' AS reason FROM stg WHERE {order} % {n} = 0" for n in (89, 97)],
    ]))
    queries["fact_sales_bucketed"] = queries["fact_sales_lookup"]
    queries["fact_sales_packed"] = queries["fact_sales"]
    queries["mart_supplier_sales_packed"] = queries["mart_supplier_sales"]
    months = "CAST(year(d) AS INTEGER) AS sale_year, CAST(month(d) AS INTEGER) AS sale_month"
    ids = ", ".join(
        f"CASE WHEN {complete(*e['key'])} THEN {key(*e['key'])} END AS {e['id']}"
        for e in layout.STAR_DIMENSIONS
    )
    replayed = (
        f"SELECT {ids}, CASE WHEN d IS NOT NULL THEN {key('d')} END AS date_id, "
        f"CASE WHEN year(d) = 1996 AND month(d) = 5 THEN 7 ELSE {loose_int('sale_quantity')} END "
        f"AS sale_quantity, {loose_double('sale_total_price')} AS sale_total_price, {months} "
        f"FROM (SELECT *, {loose_date('sale_date')} AS d FROM stg)"
    )
    queries["replay_month"] = with_(feed, replayed)
    queries["monthly_trend_range"] = with_(
        {**feed, "fact": replayed},
        f"SELECT sale_year AS year, sale_month AS month, {money('sale_total_price')} AS total_sales, "
        "COUNT(*) AS num_orders FROM fact WHERE sale_year * 12 + sale_month "
        "BETWEEN 1995 * 12 + 11 AND 1997 * 12 + 1 GROUP BY ALL",
    )
    return queries
