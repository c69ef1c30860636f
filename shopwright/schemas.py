"""Entity schemas. Reading never infers types.

Inference would turn ``cart_contents`` into one column per product id and would
cost a second pass over the files.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, REAL, FLAG, TIME = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


GEO = record(city=TEXT, state=TEXT, country=TEXT)
SESSION_GEO = record(city=TEXT, state=TEXT, country=TEXT, ip_address=TEXT)
DEVICE = record(type=TEXT, os=TEXT, browser=TEXT)
PAGE_VIEW = record(
    timestamp=TIME, page_type=TEXT, product_id=TEXT, category_id=TEXT, view_duration=LONG
)
ITEM = record(product_id=TEXT, quantity=LONG, unit_price=REAL, subtotal=REAL)
SUBCATEGORY = record(subcategory_id=TEXT, name=TEXT, profit_margin=REAL)
PRICE = record(price=REAL, date=TIME)
CART_LINE = record(quantity=LONG, price=REAL)

USERS = record(user_id=TEXT, geo_data=GEO, registration_date=TIME, last_active=TIME)
CATEGORIES = record(category_id=TEXT, name=TEXT, subcategories=T.ArrayType(SUBCATEGORY))
PRODUCTS = record(
    product_id=TEXT,
    name=TEXT,
    category_id=TEXT,
    base_price=REAL,
    current_stock=LONG,
    is_active=FLAG,
    price_history=T.ArrayType(PRICE),
    creation_date=TIME,
)
TRANSACTIONS = record(
    transaction_id=TEXT,
    session_id=TEXT,
    user_id=TEXT,
    timestamp=TIME,
    items=T.ArrayType(ITEM),
    subtotal=REAL,
    discount=REAL,
    total=REAL,
    payment_method=TEXT,
    status=TEXT,
)
SESSIONS = record(
    session_id=TEXT,
    user_id=TEXT,
    start_time=TIME,
    end_time=TIME,
    duration_seconds=LONG,
    geo_data=SESSION_GEO,
    device_profile=DEVICE,
    viewed_products=T.ArrayType(TEXT),
    page_views=T.ArrayType(PAGE_VIEW),
    cart_contents=T.MapType(TEXT, CART_LINE),
    conversion_status=TEXT,
    referrer=TEXT,
)
CELLS = record(row_key=TEXT, family=TEXT, qualifier=TEXT, value=TEXT, version=LONG, put=TEXT)

# The star-schema tables and the event stream, with the columns that are read.
INT, LOCAL = T.IntegerType(), T.TimestampNTZType()
TABLES = {
    "region": record(r_regionkey=INT, r_name=TEXT),
    "nation": record(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": record(
        c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=REAL, c_mktsegment=TEXT
    ),
    "part": record(
        p_partkey=LONG, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=INT, p_retailprice=REAL
    ),
    "orders": record(
        o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=REAL, o_orderdate=LOCAL
    ),
    "lineitem": record(
        l_orderkey=LONG,
        l_partkey=LONG,
        l_linenumber=INT,
        l_quantity=REAL,
        l_extendedprice=REAL,
        l_discount=REAL,
        l_shipdate=LOCAL,
    ),
    "events": record(
        event_id=LONG, ts=LOCAL, user_id=LONG, event_type=TEXT, value=REAL, props=TEXT
    ),
}

ENTITIES = {
    "users": USERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "transactions": TRANSACTIONS,
    "sessions": SESSIONS,
}
