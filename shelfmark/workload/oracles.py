"""DuckDB SQL for every registered query."""

from __future__ import annotations

from shelfmark.operators.quality import KEY_RULES, RANGES, REFERENCES, UNIQUE_KEYS
from shelfmark.schemas import STAGING
from shelfmark.schemas import STAR as STAR_TYPES
from shelfmark.workload.inputs import UNCATEGORIZED_TYPE, UNCOUNTED_SIZE, UNLISTED_BRAND

# --- the raw tables, as in inputs.py

RAW = {
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id
        FROM customer""",
    "products": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               NULLIF(p_type, '{UNCATEGORIZED_TYPE}') AS product_category_name
        FROM part""",
    "orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp
        FROM orders""",
    "order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
        FROM lineitem""",
    "sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_name,
               n_name AS city, r_name AS state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "inventory": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               NULLIF(p_size, {UNCOUNTED_SIZE}) - 1 AS stock_quantity,
               'WH' || CAST(p_partkey % 5 + 1 AS VARCHAR) AS warehouse_location,
               DATE '2017-01-01' + CAST(p_partkey % 10 AS INTEGER) AS last_updated
        FROM part""",
    "product_metadata": f"""
        SELECT CASE WHEN p_brand <> '{UNLISTED_BRAND}' THEN p_partkey END AS id,
               p_brand AS brand, p_size / CAST(10.0 AS DOUBLE) AS rating, p_size AS stock,
               lower(p_type) AS category
        FROM part""",
}


def one_per_key(source: str, columns: str, keys: str, order: str, where: str = "TRUE") -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
            FROM {source} WHERE {where}
        ) WHERE rn = 1"""


def nulls_last(*columns: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns)


MEAN_PRICE = (
    "CAST(SUM(CAST(CAST(price AS VARCHAR) AS DECIMAL(38,8))) AS DOUBLE) / NULLIF(COUNT(price), 0)"
)

AVG_PRICE = f"SELECT product_id, {MEAN_PRICE} AS price FROM raw_order_items GROUP BY product_id"

STATUS = """CASE WHEN stock_quantity IS NULL THEN 'UNKNOWN'
                 WHEN stock_quantity = 0 THEN 'OUT_OF_STOCK'
                 WHEN stock_quantity < 20 THEN 'LOW_STOCK'
                 ELSE 'IN_STOCK' END"""

STAGED = {
    "customers": f"""
        SELECT customer_id, customer_unique_id AS customer_name,
               customer_unique_id || '@email.com' AS email, DATE '2017-01-01' AS signup_date
        FROM ({one_per_key("raw_customers", "*", "customer_id",
                           nulls_last("customer_unique_id"), "customer_id IS NOT NULL")})""",
    "products": f"""
        SELECT p.product_id,
               product_category_name || '_' || substr(p.product_id, 1, 8) AS product_name,
               product_category_name AS category, a.price
        FROM ({one_per_key("raw_products", "*", "product_id",
                           nulls_last("product_category_name"), "product_id IS NOT NULL")}) p
        LEFT JOIN ({AVG_PRICE}) a ON p.product_id = a.product_id""",
    "orders": f"""
        SELECT order_id, customer_id, order_status AS status,
               CAST(order_purchase_timestamp AS DATE) AS order_date
        FROM ({one_per_key("raw_orders", "*", "order_id",
                           nulls_last("customer_id", "order_status", "order_purchase_timestamp"),
                           "order_id IS NOT NULL")})""",
    "order_items": one_per_key(
        "raw_order_items",
        "order_id, order_item_id, product_id, seller_id, price, freight_value",
        "order_id, order_item_id",
        nulls_last("product_id", "seller_id", "price", "freight_value"),
        "order_item_id IS NOT NULL",
    ),
    "sellers": one_per_key(
        "raw_sellers", "seller_id, seller_name, city, state", "seller_id",
        nulls_last("seller_name", "city", "state"),
        "seller_id IS NOT NULL AND seller_name IS NOT NULL",
    ),
    "inventory": one_per_key(
        "raw_inventory", "product_id, stock_quantity, warehouse_location, last_updated",
        "product_id",
        "last_updated DESC NULLS LAST, " + nulls_last("stock_quantity", "warehouse_location"),
        "product_id IS NOT NULL AND stock_quantity IS NOT NULL",
    ),
    "product_metadata": f"""
        SELECT CAST(id AS VARCHAR) AS product_id, brand, rating, stock, category
        FROM ({one_per_key("raw_product_metadata", "*", "id",
                           nulls_last("brand", "rating", "stock", "category"),
                           "id IS NOT NULL")})""",
}

PRODUCT_COLUMNS = """p.product_id, p.product_name, p.category, p.price,
               i.stock_quantity, i.warehouse_location, i.last_updated"""

STAR = {
    "dim_customers": "SELECT customer_id, customer_name, email, signup_date FROM customers",
    "dim_sellers": "SELECT seller_id, seller_name, city, state FROM sellers",
    "dim_products": f"""
        SELECT {PRODUCT_COLUMNS}, m.brand, m.rating, m.stock AS api_stock,
               m.category AS api_category, {STATUS} AS stock_status
        FROM products p
        LEFT JOIN inventory i ON p.product_id = i.product_id
        LEFT JOIN product_metadata m ON p.product_id = m.product_id""",
    "fact_sales": """
        SELECT oi.order_id, oi.product_id, o.customer_id, oi.order_item_id AS quantity,
               o.order_date, o.status, oi.price AS unit_price, oi.freight_value,
               oi.order_item_id * oi.price AS sale_amount,
               CAST(year(o.order_date) AS INTEGER) AS year,
               CAST(month(o.order_date) AS INTEGER) AS month
        FROM order_items oi JOIN orders_staged o ON oi.order_id = o.order_id""",
}

# Staged tables as they are named inside WITH; ``orders`` is a test table already.
_WITH_NAMES = {**{name: name for name in STAGED}, "orders": "orders_staged"}


def with_raw(body: str) -> str:
    ctes = ",\n".join(f"raw_{name} AS ({sql})" for name, sql in RAW.items())
    return f"WITH {ctes}\n{body}"


def with_staged(body: str, raw: dict[str, str] = RAW) -> str:
    ctes = [f"raw_{name} AS ({sql})" for name, sql in raw.items()]
    ctes += [f"{_WITH_NAMES[name]} AS ({sql})" for name, sql in STAGED.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)



DQ = _union(
    f"""SELECT '{t}' AS table_name, '{k}' AS key_column, 'not_empty' AS rule,
               COUNT(*) AS metric, COUNT(*) > 0 AS passed FROM {_WITH_NAMES[t]}
        UNION ALL
        SELECT '{t}', '{k}', 'key_not_null', COUNT(*) FILTER ({k} IS NULL),
               COUNT(*) FILTER ({k} IS NULL) = 0 FROM {_WITH_NAMES[t]}"""
    for t, k in KEY_RULES
)

EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"
LATEST_EVENTS = one_per_key(
    "events", EVENT_COLUMNS, "user_id",
    "ts DESC NULLS LAST, " + nulls_last("event_id", "event_type", "value", "props"),
)


def _mixed_text(text: str) -> str:
    return f"SELECT event_id, CASE WHEN event_type = 'error' THEN props ELSE {text} END AS text FROM events"


def _drawn(first_digit: int, span: int) -> str:
    return f"CAST('0x' || substr(md5(product_id), {first_digit}, 8) AS BIGINT) % {span}"


FIRST_PRODUCTS = """
    SELECT DISTINCT product_id FROM raw_order_items WHERE product_id IS NOT NULL
    ORDER BY product_id LIMIT 500"""


def _inferred(table: str, column: str, expected: str, actual: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
        '{expected}' AS expected_type, {actual} AS actual_type,
        CASE WHEN {actual} = '{expected}' THEN 'same' ELSE 'changed' END AS status
        FROM raw_{table}"""


def _whole(column: str) -> str:
    return (
        f"CASE WHEN max(CAST({column} AS BIGINT)) <= 2147483647 THEN 'int' ELSE 'bigint' END"
    )


def _always(kind: str) -> str:
    return f"CASE WHEN count(*) > 0 THEN '{kind}' END"


_DRIFT = [
    ("customers", "customer_id", "string", _whole("customer_id")),
    ("customers", "customer_unique_id", "string", _always("string")),
    ("products", "product_id", "string", _whole("product_id")),
    ("products", "product_category_name", "string", _always("string")),
    ("orders", "order_id", "string", _whole("order_id")),
    ("orders", "customer_id", "string", _whole("customer_id")),
    ("orders", "order_status", "string", _always("string")),
    ("orders", "order_purchase_timestamp", "string", _always("timestamp")),
    ("order_items", "order_id", "string", _whole("order_id")),
    ("order_items", "order_item_id", "int", _whole("order_item_id")),
    ("order_items", "product_id", "string", _whole("product_id")),
    ("order_items", "seller_id", "string", _whole("seller_id")),
    ("order_items", "price", "double", _always("double")),
    ("order_items", "freight_value", "double", _always("double")),
    ("sellers", "seller_id", "string", _whole("seller_id")),
    ("sellers", "seller_name", "string", _always("string")),
    ("sellers", "city", "string", _always("string")),
    ("sellers", "state", "string", _always("string")),
    ("inventory", "product_id", "string", _whole("product_id")),
    ("inventory", "stock_quantity", "int", _whole("stock_quantity")),
    ("inventory", "warehouse_location", "string", _always("string")),
    ("inventory", "last_updated", "string", _always("date")),
    ("product_metadata", "id", "string", _whole("id")),
    ("product_metadata", "brand", "string", _always("string")),
    ("product_metadata", "rating", "double", _always("double")),
    ("product_metadata", "stock", "int", _whole("stock")),
    ("product_metadata", "category", "string", _always("string")),
]

_MISSING = [
    ("customers", "customer_unique_id", "'Customer#000000000'"),
    ("products", "product_category_name", "''"),
    ("orders", "order_status", "'P'"),
    ("order_items", "order_item_id", "1"),
    ("sellers", "state", "'ASIA'"),
    ("inventory", "stock_quantity", "0"),
    ("product_metadata", "id", "0"),
]

def _checksum(schema) -> str:
    """The sum, over all rows, of a number made from the row's values as text."""
    texts = [
        f"CAST(CAST(floor({f.name} * 10000 + 0.5) AS DECIMAL(38,0)) AS VARCHAR)"
        if f.dataType.simpleString() == "double"
        else f"CAST({f.name} AS VARCHAR)"
        for f in sorted(schema, key=lambda f: f.name)
    ]
    row = ", ".join(f"coalesce({t}, '-')" for t in texts)
    return f"CAST(SUM(CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 8) AS BIGINT)) AS BIGINT)"


def _finding(table: str, column: str, rule: str, metric: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS key_column, '{rule}' AS rule,
        CAST(metric AS BIGINT) AS metric, metric = 0 AS passed FROM ({metric})"""


# The staged tables as the integrity query changes them.
_CHANGED = {
    **_WITH_NAMES,
    "orders": "(SELECT * FROM orders_staged WHERE status <> 'P')",
    "products": "(SELECT * FROM products UNION ALL SELECT * FROM products WHERE category IS NULL)",
    "product_metadata": "(SELECT * REPLACE (rating + 1 AS rating) FROM product_metadata)",
}
_ORPHANS = [
    _finding(
        child, column, "orphan",
        f"SELECT COUNT(*) AS metric FROM {_CHANGED[child]} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {key} FROM {_CHANGED[parent]} WHERE {key} IS NOT NULL)",
    )
    for child, column, parent, key in REFERENCES
]
_REPEATED = [
    _finding(
        table, ",".join(keys), "unique",
        f"SELECT COUNT(*) - COUNT(DISTINCT ({', '.join(keys)})) AS metric FROM {_CHANGED[table]} "
        f"WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)}",
    )
    for table, keys in UNIQUE_KEYS
]
_OUTSIDE = [
    _finding(
        table, column, "range",
        f"SELECT COUNT(*) FILTER (NOT {column} BETWEEN {low} AND CAST('{high}' AS DOUBLE)) AS metric "
        f"FROM {_CHANGED[table]}",
    )
    for table, column, low, high in RANGES
]

# The columns whose loads are profiled.
PROFILED = {
    "l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "l_extendedprice": "l_extendedprice",
    "l_returnflag": "NULLIF(l_returnflag, 'R')",
}

_TABLE_CHECKSUMS = _union(
    [
        f"SELECT 'staging.{t}' AS table_name, COUNT(*) AS row_count, {_checksum(STAGING[t])} AS checksum "
        f"FROM {_WITH_NAMES[t]}"
        for t in STAGED
    ]
    + [
        f"SELECT 'star.{t}' AS table_name, COUNT(*) AS row_count, {_checksum(STAR_TYPES[t])} AS checksum "
        f"FROM ({sql})"
        for t, sql in STAR.items()
    ]
)

# The raw tables as they are after both deliveries of ``delivery_refresh``.
DELIVERED = {
    **RAW,
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               c_name || CASE WHEN c_custkey % 100 = 3 THEN ' II' ELSE '' END AS customer_unique_id
        FROM customer""",
    "orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE WHEN o_orderkey % 100 = 7 THEN 'M' ELSE o_orderstatus END AS order_status,
               CASE WHEN o_orderkey % 100 = 7 THEN o_orderdate + INTERVAL 40 DAY
                    WHEN o_orderkey % 100 <> 8 THEN o_orderdate END AS order_purchase_timestamp
        FROM orders""",
    "order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CASE WHEN l_orderkey % 100 = 7 THEN l_extendedprice + 1 ELSE l_extendedprice END AS price,
               l_extendedprice * l_tax AS freight_value
        FROM lineitem""",
}

# --- three deliveries of orders, as text

DELIVERED_TEXT = """
    WITH numbered AS (
        SELECT *, CAST(o_orderkey % 3 + 1 AS INTEGER) AS delivery,
               CAST(o_totalprice AS DECIMAL(15, 2)) AS cents, strftime(o_orderdate, '%Y-%m-%d') AS day
        FROM orders),
    delivered AS (
        SELECT delivery, CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN delivery = 3 AND o_orderkey % 100 = 7 THEN 'n/a'
                    WHEN delivery = 1 THEN CAST(CAST(floor(cents) AS BIGINT) AS VARCHAR)
                    ELSE CAST(cents AS VARCHAR) END AS total,
               CASE WHEN delivery = 3 THEN day || ' 12:30:00' ELSE day END AS ordered,
               CASE delivery WHEN 1 THEN CAST(o_orderkey % 10 AS VARCHAR) WHEN 3 THEN o_orderstatus END AS note
        FROM numbered)"""

# The least type of the cells of each column so far; versions are kept where a type is new.
TYPE_VERSIONS = f"""{DELIVERED_TEXT},
    cells AS (
        SELECT delivery, column_name, cell
        FROM (UNPIVOT delivered ON order_id, total, ordered, note INTO NAME column_name VALUE cell)),
    forms AS (
        SELECT DISTINCT delivery, column_name,
               CASE WHEN regexp_full_match(cell, '[+-]?[0-9]{{1,18}}') THEN 'long'
                    WHEN regexp_full_match(cell, '[+-]?[0-9]+[.][0-9]*') THEN 'double'
                    WHEN regexp_full_match(cell, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'date'
                    WHEN regexp_full_match(cell, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} .*') THEN 'timestamp'
                    ELSE 'text' END AS form
        FROM cells),
    upto AS (
        SELECT n.delivery, f.column_name, list(DISTINCT f.form) AS seen
        FROM (SELECT DISTINCT delivery FROM delivered) n JOIN forms f ON f.delivery <= n.delivery
        GROUP BY n.delivery, f.column_name),
    types AS (
        SELECT delivery, column_name,
               CASE WHEN column_name = 'note' AND list_contains(seen, 'text') THEN 'text'
                    WHEN column_name = 'ordered' AND list_contains(seen, 'timestamp') THEN 'timestamp'
                    WHEN column_name = 'ordered' THEN 'date'
                    WHEN list_contains(seen, 'double') THEN 'double' ELSE 'long' END AS form
        FROM upto),
    wholes AS (
        SELECT delivery, string_agg(column_name || ' ' || form, ',' ORDER BY column_name) AS whole
        FROM types GROUP BY delivery),
    versions AS (
        SELECT delivery, ROW_NUMBER() OVER (ORDER BY delivery) AS version
        FROM (SELECT *, LAG(whole) OVER (ORDER BY delivery) AS earlier FROM wholes)
        WHERE whole IS DISTINCT FROM earlier)
    SELECT version, column_name, form FROM types JOIN versions USING (delivery)"""

ORACLES: dict[str, str] = {
    # sources
    "src_csv": RAW["order_items"],
    "src_csv_multiline": with_raw(
        """SELECT CAST(id AS VARCHAR) AS id, brand, rating, stock, category,
                  brand || chr(10) || '"' || category || '", boxed' AS description
           FROM raw_product_metadata"""
    ),
    "src_csv_multiline_split": with_raw(
        """SELECT order_id, order_item_id, product_id, seller_id, price, freight_value,
                  'said "' || seller_id || '",' || chr(13) || chr(10) || chr(10) || 'then "' || product_id || '"' AS remark
           FROM raw_order_items"""
    ),
    "src_parquet": "SELECT * FROM lineitem",
    "api_products_explode": """
        SELECT CAST(p_partkey * 3 + i AS VARCHAR) AS id, p_brand AS brand,
               p_size / CAST(10.0 AS DOUBLE) AS rating, CAST(p_size + i AS INTEGER) AS stock,
               lower(p_type) AS category, p_name AS title, CAST(p_size AS BIGINT) AS box_width,
               p_brand AS box_made_by
        FROM part, (VALUES (0), (1), (2)) AS copies(i)""",
    "land_files": with_raw(
        """SELECT order_id, customer_id, order_status,
                  strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S')
                      AS order_purchase_timestamp
           FROM raw_orders"""
    ),
    "schema_drift": with_raw(_union(_inferred(*row) for row in _DRIFT)),
    "delivered_types": TYPE_VERSIONS,
    "delivered_rows_typed": f"""{DELIVERED_TEXT}
        SELECT delivery, CAST(order_id AS BIGINT) AS order_id, CAST(total AS DOUBLE) AS total,
               CAST(ordered AS TIMESTAMP) AS ordered, note
        FROM delivered WHERE total <> 'n/a'""",
    "delivered_rows_quarantined": f"""{DELIVERED_TEXT}
        SELECT delivery, order_id, total, ordered, note, 'total' AS columns
        FROM delivered WHERE total = 'n/a'""",
    # sinks
    "sink_parquet_roundtrip": with_raw(STAGED["orders"]),
    "sink_partitioned_roundtrip": with_staged(STAR["fact_sales"]),
    "sink_csv_roundtrip": with_raw(
        """SELECT product_id, stock_quantity, warehouse_location,
                  CAST(last_updated AS VARCHAR) AS last_updated
           FROM raw_inventory"""
    ),
    "observed_write_metrics": with_staged(
        _union(
            f"""SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count,
                       COUNT(*) FILTER ({c} IS NULL) AS null_count FROM {_WITH_NAMES[t]}"""
            for t, c in (
                ("orders", "order_date"), ("order_items", "order_id"), ("products", "category")
            )
        )
    ),
    # projections and filters
    "avg_price_per_product": with_raw(AVG_PRICE),
    "metadata_conform": with_staged(
        "SELECT product_id, rating, stock AS api_stock, category AS api_category "
        "FROM product_metadata"
    ),
    "filter_not_null_key": with_raw("SELECT * FROM raw_product_metadata WHERE id IS NOT NULL"),
    "join_mixed_type_key": with_raw(
        """SELECT p.product_id, p.product_category_name, m.brand
           FROM raw_products p
           LEFT JOIN raw_product_metadata m ON p.product_id = CAST(m.id AS VARCHAR)"""
    ),
    # aggregation and dedup
    "row_counts_all_tables": with_raw(
        _union(
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM raw_{t}" for t in RAW
        )
    ),
    "null_counts_all_keys": with_raw(
        _union(
            f"""SELECT '{t}' AS table_name, '{c}' AS key_column, COUNT(*) AS row_count,
                       COUNT(*) FILTER (NULLIF({c}, {v}) IS NULL) AS null_count FROM raw_{t}"""
            for t, c, v in _MISSING
        )
    ),
    "dedup_single_key": LATEST_EVENTS,
    "dedup_composite_key": with_raw(
        f"SELECT order_id, order_item_id, product_id, price FROM ({STAGED['order_items']})"
    ),
    "distinct_products_topn": with_raw(FIRST_PRODUCTS),
    # scalar functions
    "fn_concat_null": with_raw(
        """SELECT product_id,
                  product_category_name || '_' || substr(product_id, 1, 8) AS product_name
           FROM raw_products"""
    ),
    "fn_substring_prefix": "SELECT o_orderkey, substr(o_orderpriority, 1, 8) AS prefix FROM orders",
    "fn_try_cast": f"""
        SELECT event_id, TRY_CAST(text AS DOUBLE) AS number
        FROM ({_mixed_text("CAST(user_id AS VARCHAR)")})""",
    "fn_parse_ts_to_date": f"""
        SELECT event_id, CAST(TRY_STRPTIME(text, '%Y-%m-%d %H:%M:%S') AS DATE) AS day
        FROM ({_mixed_text("strftime(ts, '%Y-%m-%d %H:%M:%S')")})""",
    "fn_parse_date": f"""
        SELECT event_id, CAST(TRY_STRPTIME(text, '%Y-%m-%d') AS DATE) AS day
        FROM ({_mixed_text("strftime(ts, '%Y-%m-%d')")})""",
    "fn_year_month": with_raw(
        """SELECT order_id, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
                  CAST(month(order_purchase_timestamp) AS INTEGER) AS month
           FROM raw_orders"""
    ),
    "stock_status": with_raw(
        f"SELECT product_id, stock_quantity, {STATUS} AS stock_status FROM raw_inventory"
    ),
    "synth_sellers": with_raw(
        """SELECT seller_id, 'Seller_' || substr(seller_id, 1, 8) AS seller_name, city, state
           FROM raw_sellers"""
    ),
    "synth_inventory": with_raw(
        f"""SELECT product_id, CAST({_drawn(1, 491)} + 10 AS INTEGER) AS stock_quantity,
                   'WH' || CAST({_drawn(9, 5)} + 1 AS VARCHAR) AS warehouse_location,
                   DATE '2017-01-01' AS last_updated
            FROM (SELECT DISTINCT product_id FROM raw_order_items WHERE product_id IS NOT NULL)"""
    ),
    # incremental load
    "delta_since_watermark": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'",
    "delta_or_full": _union(
        f"""SELECT *, '{mark}' AS since FROM events
            WHERE ts > TIMESTAMP '{mark}'
               OR (SELECT COUNT(*) FROM events WHERE ts > TIMESTAMP '{mark}') = 0"""
        for mark in ("2024-01-15", "2100-01-01")
    ),
    "read_watermark_default": _union(
        f"""SELECT '{source}' AS source,
                   COALESCE(MAX(ts), TIMESTAMP '1900-01-01') AS watermark
            FROM events WHERE event_type = '{source}'"""
        for source in ("purchase", "returns")
    ),
    "advance_watermark": _union(
        f"""SELECT GREATEST(COALESCE(MAX(ts), TIMESTAMP '{mark}'), TIMESTAMP '{mark}')
                       AS watermark, '{mark}' AS since
            FROM events WHERE ts > TIMESTAMP '{mark}'"""
        for mark in ("2024-01-15", "2100-01-01")
    ),
    "upsert_snapshot": LATEST_EVENTS,
    "upsert_small_delta": LATEST_EVENTS,
    "seller_changes": with_raw(
        """SELECT seller_id, CASE WHEN state <> 'ASIA' THEN seller_name END AS seller_name,
                  CASE WHEN state = 'AMERICA' THEN 'ELSEWHERE' WHEN state <> 'ASIA' THEN city END AS city,
                  CASE WHEN state <> 'ASIA' THEN state END AS state,
                  CASE state WHEN 'EUROPE' THEN 'insert' WHEN 'ASIA' THEN 'delete' ELSE 'update' END AS change
           FROM raw_sellers WHERE state IN ('EUROPE', 'ASIA', 'AMERICA')"""
    ),
    "seller_history": with_raw(
        """SELECT seller_id, seller_name, city, state, DATE '2024-01-01' AS valid_from,
                  CASE WHEN state IN ('ASIA', 'AMERICA') THEN DATE '2024-01-02' END AS valid_to
           FROM raw_sellers WHERE state <> 'EUROPE'
           UNION ALL
           SELECT seller_id, seller_name, CASE WHEN state = 'AMERICA' THEN 'ELSEWHERE' ELSE city END, state,
                  DATE '2024-01-02', DATE '2024-01-03'
           FROM raw_sellers WHERE state IN ('EUROPE', 'AMERICA')
           UNION ALL
           SELECT seller_id, seller_name, city, state, DATE '2024-01-03', NULL
           FROM raw_sellers WHERE state IN ('ASIA', 'AMERICA')"""
    ),
    "fact_sales_colocated": with_staged(STAR["fact_sales"]),
    "stage_products_colocated": with_raw(STAGED["products"]),
    # data quality
    "dq_report": with_staged(DQ),
    "dq_gate": with_staged(DQ),
    # composite jobs
    **{f"stage_{name}": with_raw(sql) for name, sql in STAGED.items()},
    **{name: with_staged(sql) for name, sql in STAR.items()},
    "dim_products_no_metadata_cols": with_staged(
        f"""SELECT {PRODUCT_COLUMNS}, p.product_id AS brand,
                   TRY_CAST(p.product_id AS DOUBLE) AS rating, i.stock_quantity AS api_stock,
                   p.category AS api_category, {STATUS} AS stock_status
            FROM products p
            LEFT JOIN inventory i ON p.product_id = i.product_id
            LEFT JOIN product_metadata m ON p.product_id = m.product_id"""
    ),
    "profile_history": _union(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER ({v} IS NULL) AS null_count,
                   TRUE AS distinct_fits, TRUE AS median_fits FROM lineitem"""
        for c, v in PROFILED.items()
    ),
    "profile_drift": f"""
        WITH p AS ({_union(
            f"""SELECT CAST(year(l_shipdate) AS VARCHAR) AS load, '{c}' AS column_name, COUNT(*) AS n,
                       COUNT(*) FILTER ({v} IS NULL) AS gone FROM lineitem GROUP BY 1"""
            for c, v in PROFILED.items()
        )}), m AS (
            SELECT load, column_name, n / AVG(n) OVER b AS rows_,
                   gone / n - SUM(gone) OVER b / SUM(n) OVER b AS nulls_
            FROM p WINDOW b AS (PARTITION BY column_name ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        )
        SELECT load, column_name, 'rows' AS rule, rows_ AS metric, COALESCE(rows_ BETWEEN 0.5 AND 2, TRUE) AS passed FROM m
        UNION ALL
        SELECT load, column_name, 'nulls', nulls_, COALESCE(nulls_ BETWEEN -0.05 AND 0.05, TRUE) FROM m""",
    "dq_rejects": with_raw(
        """SELECT 'order_items' AS table_name, 'order_item_id' AS key_column, 'key_readable' AS rule,
                  COUNT(*) FILTER (order_item_id = 7) AS metric,
                  COUNT(*) FILTER (order_item_id = 7) = 0 AS passed,
                  COUNT(*) FILTER (order_item_id IN (3, 7)) AS bad_records
           FROM raw_order_items"""
    ),
    "dq_orphans": with_staged(_union([*_ORPHANS, *_REPEATED, *_OUTSIDE])),
    "fact_sales_by_seller": with_staged(
        """SELECT oi.order_id, oi.order_item_id, oi.seller_id, oi.product_id, o.customer_id,
                  o.order_date, o.status, oi.price AS unit_price, oi.freight_value
           FROM order_items oi JOIN orders_staged o ON oi.order_id = o.order_id"""
    ),
    "fact_line_revenue": with_staged(
        """SELECT oi.order_id, oi.order_item_id, oi.product_id, o.order_date,
                  oi.order_item_id * oi.price AS sale_amount, 1 AS units, oi.price AS line_revenue
           FROM order_items oi JOIN orders_staged o ON oi.order_id = o.order_id"""
    ),
    "full_refresh": with_staged(_TABLE_CHECKSUMS),
    "delivery_refresh": with_staged(_TABLE_CHECKSUMS, DELIVERED),
}
