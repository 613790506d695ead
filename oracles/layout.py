"""Fixed values of the data model for the SQL side, written out here once more.

Nothing is imported from the package, so a key, column, type or order that is changed there
makes its results differ from the SQL. Natural order throughout.
"""

from __future__ import annotations

# Star dimensions: table, id, business key, the order that decides between descriptions,
# columns read as numbers, output columns.
STAR_DIMENSIONS = [{'table': 'dim_customer',
  'id': 'customer_id',
  'key': ('customer_first_name', 'customer_last_name', 'customer_email'),
  'payload': ('customer_age', 'customer_country', 'customer_postal_code', 'customer_pet_type',
              'customer_pet_name', 'customer_pet_breed', 'pet_category'),
  'parsed': {'customer_age': 'int'},
  'columns': ('customer_first_name', 'customer_last_name', 'customer_age', 'customer_email',
              'customer_country', 'customer_postal_code', 'customer_pet_type', 'customer_pet_name',
              'customer_pet_breed', 'pet_category', 'customer_id')},
 {'table': 'dim_seller',
  'id': 'seller_id',
  'key': ('seller_first_name', 'seller_last_name', 'seller_email'),
  'payload': ('seller_country', 'seller_postal_code'),
  'parsed': {},
  'columns': ('seller_first_name', 'seller_last_name', 'seller_email', 'seller_country',
              'seller_postal_code', 'seller_id')},
 {'table': 'dim_product',
  'id': 'product_id',
  'key': ('product_name', 'product_category'),
  'payload': ('product_price', 'product_quantity', 'product_weight', 'product_color',
              'product_size', 'product_brand', 'product_material', 'product_description',
              'product_rating', 'product_reviews', 'product_release_date', 'product_expiry_date'),
  'parsed': {'product_price': 'double',
             'product_quantity': 'int',
             'product_weight': 'double',
             'product_rating': 'double',
             'product_reviews': 'int'},
  'columns': ('product_name', 'product_category', 'product_price', 'product_quantity',
              'product_weight', 'product_color', 'product_size', 'product_brand',
              'product_material', 'product_description', 'product_rating', 'product_reviews',
              'product_release_date', 'product_expiry_date', 'product_id')},
 {'table': 'dim_store',
  'id': 'store_id',
  'key': ('store_name', 'store_city'),
  'payload': ('store_location', 'store_phone', 'store_email', 'store_state', 'store_country'),
  'parsed': {},
  'columns': ('store_name', 'store_location', 'store_city', 'store_state', 'store_country',
              'store_phone', 'store_email', 'store_id')},
 {'table': 'dim_supplier',
  'id': 'supplier_id',
  'key': ('supplier_name', 'supplier_email'),
  'payload': ('supplier_contact', 'supplier_phone', 'supplier_address', 'supplier_city',
              'supplier_country'),
  'parsed': {},
  'columns': ('supplier_name', 'supplier_contact', 'supplier_email', 'supplier_phone',
              'supplier_address', 'supplier_city', 'supplier_country', 'supplier_id')}]

STAR_TABLES = ('dim_customer', 'dim_seller', 'dim_product', 'dim_store', 'dim_supplier', 'dim_date', 'fact_sales')

STAR_REFERENCES = {'customer_id': 'dim_customer',
 'seller_id': 'dim_seller',
 'product_id': 'dim_product',
 'store_id': 'dim_store',
 'supplier_id': 'dim_supplier',
 'date_id': 'dim_date'}

MART_TABLES = ('mart_product_sales', 'mart_customer_sales', 'mart_time_sales', 'mart_store_sales',
 'mart_supplier_sales', 'mart_product_quality')

SNOWFLAKE_REFERENCES = (('d_customer', 'pet_id', 'd_customer_pet'), ('d_customer', 'location_id', 'd_customer_location'),
 ('d_seller', 'location_id', 'd_seller_location'),
 ('d_product', 'category_id', 'd_product_category'),
 ('d_product', 'details_id', 'd_product_details'), ('d_store', 'location_id', 'd_store_location'),
 ('d_supplier', 'location_id', 'd_supplier_location'), ('f_sale', 'customer_id', 'd_customer'),
 ('f_sale', 'seller_id', 'd_seller'), ('f_sale', 'product_id', 'd_product'),
 ('f_sale', 'store_id', 'd_store'), ('f_sale', 'supplier_id', 'd_supplier'),
 ('f_sale', 'date_id', 'd_date'))

SNOWFLAKE_COLUMNS = {'d_customer_location': {'location_id': 'key',
                         'country': 'varchar(200)',
                         'postal_code': 'varchar(50)'},
 'd_customer_pet': {'pet_id': 'key',
                    'pet_type': 'varchar(100)',
                    'pet_name': 'varchar(200)',
                    'pet_breed': 'varchar(200)',
                    'pet_category': 'varchar(100)'},
 'd_seller_location': {'location_id': 'key',
                       'country': 'varchar(200)',
                       'postal_code': 'varchar(50)'},
 'd_store_location': {'location_id': 'key',
                      'city': 'varchar(200)',
                      'state': 'varchar(200)',
                      'country': 'varchar(200)'},
 'd_supplier_location': {'location_id': 'key',
                         'address': 'varchar(300)',
                         'city': 'varchar(200)',
                         'country': 'varchar(200)'},
 'd_product_category': {'category_id': 'key', 'category_name': 'varchar(200)'},
 'd_product_details': {'details_id': 'key',
                       'weight': 'decimal(10,2)',
                       'color': 'varchar(100)',
                       'size': 'varchar(50)',
                       'brand': 'varchar(200)',
                       'material': 'varchar(200)',
                       'description': 'string',
                       'rating': 'decimal(3,1)',
                       'reviews': 'int',
                       'release_date': 'date',
                       'expiry_date': 'date'},
 'd_customer': {'customer_id': 'key',
                'first_name': 'varchar(200)',
                'last_name': 'varchar(200)',
                'age': 'int',
                'email': 'varchar(300)',
                'pet_id': 'key',
                'location_id': 'key'},
 'd_seller': {'seller_id': 'key',
              'first_name': 'varchar(200)',
              'last_name': 'varchar(200)',
              'email': 'varchar(300)',
              'location_id': 'key'},
 'd_product': {'product_id': 'key',
               'name': 'varchar(300)',
               'price': 'decimal(10,2)',
               'quantity': 'int',
               'category_id': 'key',
               'details_id': 'key'},
 'd_store': {'store_id': 'key',
             'name': 'varchar(300)',
             'location_detail': 'varchar(300)',
             'phone': 'varchar(50)',
             'email': 'varchar(300)',
             'location_id': 'key'},
 'd_supplier': {'supplier_id': 'key',
                'name': 'varchar(300)',
                'contact': 'varchar(300)',
                'email': 'varchar(300)',
                'phone': 'varchar(50)',
                'location_id': 'key'},
 'd_date': {'date_id': 'key',
            'full_date': 'date',
            'day': 'int',
            'month': 'int',
            'year': 'int',
            'quarter': 'int'},
 'f_sale': {'sale_id': 'key',
            'sale_quantity': 'int',
            'sale_total_price': 'decimal(12,2)',
            'customer_id': 'key',
            'seller_id': 'key',
            'product_id': 'key',
            'store_id': 'key',
            'supplier_id': 'key',
            'date_id': 'key'}}

PRIMARY_KEYS = {'d_customer_location': 'location_id',
 'd_customer_pet': 'pet_id',
 'd_seller_location': 'location_id',
 'd_store_location': 'location_id',
 'd_supplier_location': 'location_id',
 'd_product_category': 'category_id',
 'd_product_details': 'details_id',
 'd_customer': 'customer_id',
 'd_seller': 'seller_id',
 'd_product': 'product_id',
 'd_store': 'store_id',
 'd_supplier': 'supplier_id',
 'd_date': 'date_id',
 'f_sale': 'sale_id'}

# Sub-dimensions: table, id, output column -> feed column.
SUB_DIMENSIONS = [('d_customer_location', 'location_id',
  {'country': 'customer_country', 'postal_code': 'customer_postal_code'}),
 ('d_customer_pet', 'pet_id',
  {'pet_type': 'customer_pet_type',
   'pet_name': 'customer_pet_name',
   'pet_breed': 'customer_pet_breed',
   'pet_category': 'pet_category'}),
 ('d_seller_location', 'location_id',
  {'country': 'seller_country', 'postal_code': 'seller_postal_code'}),
 ('d_store_location', 'location_id',
  {'city': 'store_city', 'state': 'store_state', 'country': 'store_country'}),
 ('d_supplier_location', 'location_id',
  {'address': 'supplier_address', 'city': 'supplier_city', 'country': 'supplier_country'}),
 ('d_product_category', 'category_id', {'category_name': 'product_category'})]

# Product details: output column -> (feed column, type).
DETAILS = {'weight': ('product_weight', 'decimal'),
 'color': ('product_color', 'text'),
 'size': ('product_size', 'text'),
 'brand': ('product_brand', 'text'),
 'material': ('product_material', 'text'),
 'description': ('product_description', 'text'),
 'rating': ('product_rating', 'decimal'),
 'reviews': ('product_reviews', 'int'),
 'release_date': ('product_release_date', 'date'),
 'expiry_date': ('product_expiry_date', 'date')}

# Snowflake dimensions: table, id, key, order, parsed, output -> feed column, sub-dimensions, emptied.
DIMENSIONS = [{'table': 'd_customer',
  'id': 'customer_id',
  'key': ('customer_first_name', 'customer_last_name', 'customer_email'),
  'payload': ('customer_age', 'customer_country', 'customer_postal_code', 'customer_pet_type',
              'customer_pet_name', 'customer_pet_breed', 'pet_category'),
  'parsed': {'customer_age': 'int'},
  'columns': {'first_name': 'customer_first_name',
              'last_name': 'customer_last_name',
              'age': 'customer_age',
              'email': 'customer_email'},
  'points_to': ['d_customer_pet', 'd_customer_location'],
  'emptied': ('customer_country', 'customer_postal_code', 'customer_pet_type', 'customer_pet_name',
              'customer_pet_breed', 'pet_category')},
 {'table': 'd_seller',
  'id': 'seller_id',
  'key': ('seller_first_name', 'seller_last_name', 'seller_email'),
  'payload': ('seller_country', 'seller_postal_code'),
  'parsed': {},
  'columns': {'first_name': 'seller_first_name',
              'last_name': 'seller_last_name',
              'email': 'seller_email'},
  'points_to': ['d_seller_location'],
  'emptied': ('seller_country', 'seller_postal_code')},
 {'table': 'd_store',
  'id': 'store_id',
  'key': ('store_name', 'store_city'),
  'payload': ('store_location', 'store_phone', 'store_email', 'store_state', 'store_country'),
  'parsed': {},
  'columns': {'name': 'store_name',
              'location_detail': 'store_location',
              'phone': 'store_phone',
              'email': 'store_email'},
  'points_to': ['d_store_location'],
  'emptied': ('store_location', 'store_city', 'store_state', 'store_country')},
 {'table': 'd_supplier',
  'id': 'supplier_id',
  'key': ('supplier_name', 'supplier_email'),
  'payload': ('supplier_contact', 'supplier_phone', 'supplier_address', 'supplier_city',
              'supplier_country'),
  'parsed': {},
  'columns': {'name': 'supplier_name',
              'contact': 'supplier_contact',
              'email': 'supplier_email',
              'phone': 'supplier_phone'},
  'points_to': ['d_supplier_location'],
  'emptied': ('supplier_address', 'supplier_city', 'supplier_country')}]

BUSINESS_KEYS = {'d_date': ('full_date',),
 'd_customer': ('first_name', 'last_name', 'email'),
 'd_seller': ('first_name', 'last_name', 'email'),
 'd_product': ('name', 'category_id'),
 'd_store': ('name', 'location_id'),
 'd_supplier': ('name', 'email')}

STRICT_COLUMNS = {'customer_age': 'int',
 'product_price': 'decimal',
 'product_quantity': 'int',
 'product_weight': 'decimal',
 'product_rating': 'decimal',
 'product_reviews': 'int',
 'product_release_date': 'date',
 'product_expiry_date': 'date',
 'sale_date': 'date',
 'sale_quantity': 'int',
 'sale_total_price': 'decimal'}

PERMISSIVE_COLUMNS = {'customer_age': 'int',
 'product_price': 'double',
 'product_quantity': 'int',
 'product_weight': 'double',
 'product_rating': 'double',
 'product_reviews': 'int',
 'sale_date': 'date',
 'sale_quantity': 'int',
 'sale_total_price': 'double'}

# The staging feed: column -> expression over the joined given tables.
FEED = {
    'id': "concat(cast(l_orderkey as string),'-',cast(l_linenumber as string))",
    'customer_first_name': "split_part(c_name,'#',1)",
    'customer_last_name': "split_part(c_name,'#',2)",
    'customer_age': "CASE WHEN c_custkey%11=0 THEN 'n/a' WHEN c_custkey%13=0 THEN '' WHEN c_custkey%17=0 THEN NULL ELSE cast(18+c_custkey%60 as string) END",
    'customer_email': "CASE WHEN c_custkey%101=0 THEN NULL ELSE concat('c',cast(c_custkey as string),'@x.example') END",
    'customer_country': 'cn.n_name',
    'customer_postal_code': 'CASE WHEN c_custkey%7=0 THEN NULL ELSE cast(10000+c_custkey%90 as string) END',
    'customer_pet_type': 'c_mktsegment',
    'customer_pet_name': "concat('Pet ',cast(l_partkey%5 as string))",
    'customer_pet_breed': "concat('Breed ',cast(l_suppkey%4 as string))",
    'seller_first_name': "'Seller'",
    'seller_last_name': 'cast(o_orderkey%97 as string)',
    'seller_email': "concat('s',cast(o_orderkey%97 as string),'@x.example')",
    'seller_country': 'o_orderpriority',
    'seller_postal_code': "CASE WHEN o_orderkey%5=0 THEN '' ELSE cast(20000+o_orderkey%9 as string) END",
    'product_name': 'p_name',
    'product_category': "CASE WHEN p_size=1 THEN NULL WHEN p_size=2 THEN '' ELSE p_type END",
    'product_price': 'cast(cast(p_retailprice as decimal(12,2)) as string)',
    'product_quantity': "CASE WHEN p_partkey%23=0 THEN '-1' ELSE cast(p_size as string) END",
    'sale_date': "CASE WHEN o_orderkey%211=0 THEN '' WHEN o_orderkey%223=0 THEN NULL ELSE concat(cast(month(o_orderdate) as string),'/',cast(day(o_orderdate) as string),'/',cast(year(o_orderdate) as string)) END",
    'sale_customer_id': 'cast(o_custkey as string)',
    'sale_seller_id': 'cast(o_orderkey%97 as string)',
    'sale_product_id': 'cast(l_partkey as string)',
    'sale_quantity': "CASE WHEN l_orderkey%301=0 THEN '' WHEN l_orderkey%313=0 THEN concat(' +',cast(cast(l_quantity as int) as string),'.9 ') WHEN l_orderkey%317=0 THEN '.5' WHEN l_orderkey%331=0 THEN concat('-',cast(cast(l_quantity as int) as string),'.') ELSE cast(cast(l_quantity as int) as string) END",
    'sale_total_price': "CASE WHEN l_orderkey%307=0 THEN 'bad' WHEN l_orderkey%311=0 THEN concat(cast(l_linenumber as string),'.00000004') ELSE cast(cast(l_extendedprice as decimal(12,2)) as string) END",
    'store_name': "concat('Store ',cast(l_orderkey%13 as string))",
    'store_location': "CASE WHEN l_suppkey%6=0 THEN NULL ELSE concat('Unit ',cast(l_suppkey%6 as string)) END",
    'store_city': "CASE WHEN l_partkey%17=0 THEN '' WHEN l_partkey%17=1 THEN NULL ELSE concat('City ',cast(l_partkey%17 as string)) END",
    'store_state': "CASE WHEN l_suppkey%20=0 THEN 'State X' WHEN l_partkey%17=2 THEN NULL ELSE concat('State ',cast(l_partkey%17%4 as string)) END",
    'store_country': "concat('Country ',cast(l_partkey%17%3 as string))",
    'store_phone': "concat('555-',cast(1000+l_orderkey%13 as string))",
    'store_email': "concat('st',cast(l_orderkey%13 as string),'@x.example')",
    'pet_category': 'l_returnflag',
    'product_weight': "concat(cast(p_size as string),'.',CASE WHEN p_partkey%25=0 THEN '505' ELSE '50' END)",
    'product_color': "split_part(p_name,' ',1)",
    'product_size': "CASE WHEN p_size<17 THEN 'S' WHEN p_size<34 THEN 'M' ELSE 'L' END",
    'product_brand': 'p_brand',
    'product_material': "split_part(p_name,' ',2)",
    'product_description': 'concat(p_name,\', "\',p_type,\'"\')',
    'product_rating': "CASE WHEN p_partkey%19=0 THEN 'N/A' ELSE concat(cast(1+p_partkey%4 as string),'.',cast(p_partkey%10 as string)) END",
    'product_reviews': 'cast(p_partkey%500 as string)',
    'product_release_date': "concat(cast(1+p_partkey%12 as string),'/',cast(1+p_partkey%28 as string),'/2015')",
    'product_expiry_date': "CASE WHEN p_partkey%9=0 THEN '' ELSE concat(cast(1+p_partkey%12 as string),'/',cast(1+p_partkey%28 as string),'/2025') END",
    'supplier_name': 's_name',
    'supplier_contact': "concat('Contact ',cast(l_orderkey%3 as string))",
    'supplier_email': "CASE WHEN s_suppkey%50=0 THEN NULL ELSE concat('su',cast(s_suppkey as string),'@x.example') END",
    'supplier_phone': "concat('777-',cast(s_suppkey as string))",
    'supplier_address': "concat(cast(s_suppkey%40 as string),' High St')",
    'supplier_city': "concat('SCity ',cast(s_suppkey%12 as string))",
    'supplier_country': 'sn.n_name',
}

# What the broken feed has instead.
BROKEN = {
    'customer_first_name': "CASE WHEN c_custkey%37=0 THEN repeat('x',201) ELSE split_part(c_name,'#',1) END",
    'product_quantity': "CASE WHEN p_partkey%29=0 THEN '99999999999' ELSE cast(p_size as string) END",
    'product_price': "CASE WHEN p_partkey%33=0 THEN '123456789012345.5' WHEN p_partkey%31=0 THEN concat(cast(cast(p_retailprice as decimal(12,2)) as string),'5') ELSE cast(cast(p_retailprice as decimal(12,2)) as string) END",
    'product_rating': "CASE WHEN p_partkey%41=0 THEN '1.0000000000000000001' WHEN p_partkey%41=1 THEN '4.55' ELSE concat(cast(1+p_partkey%4 as string),'.',cast(p_partkey%10 as string)) END",
    'sale_date': "CASE WHEN o_orderkey%227=0 THEN '13/45/2021' ELSE concat(cast(month(o_orderdate) as string),'/',cast(day(o_orderdate) as string),'/',cast(year(o_orderdate) as string)) END",
    'sale_quantity': "CASE WHEN l_orderkey%229=0 THEN '99999999999' ELSE cast(cast(l_quantity as int) as string) END",
}
