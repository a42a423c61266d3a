"""Column types of every table the jobs read or write."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**columns):
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


STRING, INT, LONG, DOUBLE, DATE = StringType(), IntegerType(), LongType(), DoubleType(), DateType()

# Raw files. Timestamps and dates stay text until staging parses them, so a bad
# cell becomes a NULL that can be counted instead of changing the column's type.
RAW = {
    "customers": _struct(customer_id=STRING, customer_unique_id=STRING),
    "products": _struct(product_id=STRING, product_category_name=STRING),
    "orders": _struct(
        order_id=STRING, customer_id=STRING, order_status=STRING, order_purchase_timestamp=STRING
    ),
    "order_items": _struct(
        order_id=STRING, order_item_id=INT, product_id=STRING, seller_id=STRING,
        price=DOUBLE, freight_value=DOUBLE,
    ),
    "sellers": _struct(seller_id=STRING, seller_name=STRING, city=STRING, state=STRING),
    "inventory": _struct(
        product_id=STRING, stock_quantity=INT, warehouse_location=STRING, last_updated=STRING
    ),
    "product_metadata": _struct(
        id=STRING, brand=STRING, rating=DOUBLE, stock=INT, category=STRING
    ),
}

STAGING = {
    "customers": _struct(customer_id=STRING, customer_name=STRING, email=STRING, signup_date=DATE),
    "products": _struct(product_id=STRING, product_name=STRING, category=STRING, price=DOUBLE),
    "orders": _struct(order_id=STRING, customer_id=STRING, status=STRING, order_date=DATE),
    "order_items": RAW["order_items"],
    "sellers": RAW["sellers"],
    "inventory": _struct(
        product_id=STRING, stock_quantity=INT, warehouse_location=STRING, last_updated=DATE
    ),
    "product_metadata": _struct(
        product_id=STRING, brand=STRING, rating=DOUBLE, stock=INT, category=STRING
    ),
}

STAR = {
    "dim_customers": STAGING["customers"],
    "dim_sellers": STAGING["sellers"],
    "dim_products": _struct(
        product_id=STRING, product_name=STRING, category=STRING, price=DOUBLE,
        stock_quantity=INT, warehouse_location=STRING, last_updated=DATE,
        brand=STRING, rating=DOUBLE, api_stock=INT, api_category=STRING, stock_status=STRING,
    ),
    "fact_sales": _struct(
        order_id=STRING, product_id=STRING, customer_id=STRING, quantity=INT, order_date=DATE,
        status=STRING, unit_price=DOUBLE, freight_value=DOUBLE, sale_amount=DOUBLE,
        year=INT, month=INT,
    ),
}

# One element of the product service's answer, and the answer itself. The id is
# text whether it is sent as text or number. Callers that need more of the
# element pass a wider struct; staging keeps every column.
PRODUCT_ELEMENT = RAW["product_metadata"]


def payload_of(element: StructType) -> StructType:
    return _struct(products=ArrayType(element))


# How each table of files is landed.
MODES = _struct(table_name=STRING, mode=STRING)

# One row per committed load of an incremental source: its number, the load that
# is the base, the rows of that base, and the changed rows loaded since.
CONTROL = _struct(
    source=STRING, watermark=TimestampNTZType(), version=LONG,
    base=LONG, base_rows=LONG, changes=LONG,
)

# One row per folder that a published version of a layer is made of.
MANIFEST = _struct(
    layer=STRING, version=LONG, built_from=LONG, table_name=STRING, partition=STRING,
    path=STRING, row_count=LONG, keyless=LONG,
)

# Where the rows of an order lie, as of the version that put them there.
ORDER_MONTHS = _struct(order_id=STRING, year=INT, month=INT, since=LONG)

# One row per finished step of a run.
JOURNAL = _struct(run=STRING, number=LONG, step=STRING, fingerprint=STRING, metrics=STRING)

# One row per column of a version of a delivered table's types.
TYPE_VERSIONS = _struct(table_name=STRING, version=LONG, position=INT, column_name=STRING, form=STRING)
