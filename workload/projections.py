"""Projections: dictionaries turned into columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.json_values import nested_value, partition_date
from millrace.functions.types import ColumnSpec
from millrace.operators.staging import stage, typed_columns, typed_view
from millrace.plans import raw_stream
from millrace.sources.landing import as_raw_landing
from workload import inputs
from workload.registered import query

ORDERS_SQL = """
    WITH landed AS (
      SELECT o.*, o_orderdate + to_days(n) AS landed_at, o_orderkey || '-' || n AS ab_id
      FROM orders o, (VALUES (0), (1)) v(n)),
    typed AS (
      SELECT o_orderkey AS order_key, o_custkey AS customer_cust_key,
             o_orderpriority AS customer_priority, o_orderstatus AS order_status,
             CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,9)) AS total_price,
             CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate END AS order_date,
             o_orderstatus = 'O' AS is_open,
             '"' || o_orderstatus || '"' || o_custkey || 'null{"z":1,"a":"' || o_orderpriority || '"}'
               AS tags,
             CAST(NULL AS VARCHAR) AS customer, ab_id, landed_at AS ab_emitted_at
      FROM landed WHERE landed_at < DATE '2000-01-02'
      QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY landed_at DESC, ab_id DESC) = 1)"""


@query("staged_events", """
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, DATE '2024-01-15' AS execution_date,
           CAST(event_id AS VARCHAR) AS ab_id, ts AS ab_emitted_at,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS unique_id
    FROM events WHERE ts < DATE '2024-01-16'
    QUALIFY row_number() OVER (PARTITION BY props ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""")
def staged_events(spark, sf_dir):
    return stage(inputs.landed_events(spark, sf_dir), inputs.EVENT_COLUMNS, "2024-01-15")


@query("staged_orders", ORDERS_SQL + """
    SELECT *, DATE '2000-01-01' AS execution_date, order_key AS unique_id FROM typed""")
def staged_orders(spark, sf_dir):
    return stage(inputs.landed_orders(spark, sf_dir), inputs.ORDER_COLUMNS, "2000-01-01")


@query("typed_payload_columns", """
    SELECT o_orderkey AS order_key, o_custkey AS customer_cust_key,
           o_orderpriority AS customer_priority, o_orderstatus AS order_status,
           CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,9)) AS total_price,
           CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate END AS order_date,
           o_orderstatus = 'O' AS is_open,
           '"' || o_orderstatus || '"' || o_custkey || 'null{"z":1,"a":"' || o_orderpriority || '"}'
             AS tags,
           CAST(NULL AS VARCHAR) AS customer, DATE '2000-01-01' AS execution_date,
           o_orderkey || '-' || n AS ab_id, o_orderdate + to_days(n) AS ab_emitted_at
    FROM orders, (VALUES (0), (1)) v(n)""")
def typed_payload_columns(spark, sf_dir):
    return typed_columns(inputs.landed_orders(spark, sf_dir), inputs.ORDER_COLUMNS, "2000-01-01")


@query("staged_from_catalog", """
    SELECT p_partkey AS part_key, CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(38,9)) AS retail_price,
           'Brand ' || p_size AS detail_maker_brand,
           md5(regexp_replace(regexp_replace(
             CAST(CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(38,9)) AS VARCHAR), '0+$', ''), '\\.$', '')
             || '-' || p_partkey) AS unique_id
    FROM part""")
def staged_from_catalog(spark, sf_dir):
    """A stream staged by the dictionary its own catalog entry yields."""
    p = inputs.table(spark, sf_dir, "part")
    catalog = inputs.connections(spark, sf_dir)
    first = p.where("p_partkey = 1").select("p_name", "p_brand").first()
    dictionary = raw_stream.stream_dictionary(catalog, "c-1", first.p_name)
    payload = inputs.text(
        '{"PartKey": ', p.p_partkey, ', "retailPrice": "', p.p_retailprice,
        '", "detail": {"maker": {"', first.p_brand, '": "Brand ', p.p_size, '"}}}',
    )
    raw = inputs.as_raw_landing(
        p, p.p_partkey, F.lit("2024-01-01 00:00:00").cast("timestamp"), payload
    )
    staged = stage(raw, dictionary, "2024-01-01")
    brand = next(c.name for c in dictionary if c.identifier == f"detail.maker.{first.p_brand}")
    return staged.select(
        "part_key", "retail_price", F.col(f"`{brand}`").alias("detail_maker_brand"), "unique_id"
    )


@query("composite_unique_id", ORDERS_SQL + """
    SELECT order_key, md5(concat_ws('-', order_key, order_status,
             coalesce(strftime(order_date, '%Y-%m-%d %H:%M:%S') || '+00',
                      '_dbt_utils_surrogate_key_null_'))) AS unique_id
    FROM typed""")
def composite_unique_id(spark, sf_dir):
    staged = stage(
        inputs.landed_orders(spark, sf_dir), inputs.ORDER_COLUMNS, "2000-01-01",
        key=["order_key", "order_status", "order_date"],
    )
    return staged.select("order_key", "unique_id")


@query("whole_row_unique_id", ORDERS_SQL + """
    SELECT order_key, md5(concat_ws('-', order_key, customer_cust_key, customer_priority, order_status,
             CASE WHEN is_open THEN 'true' ELSE 'false' END, tags)) AS unique_id
    FROM typed""")
def whole_row_unique_id(spark, sf_dir):
    names = {"order_key", "customer_cust_key", "customer_priority", "order_status", "is_open", "tags"}
    columns = [
        ColumnSpec(c.name, c.identifier, c.data_type)
        for c in inputs.ORDER_COLUMNS if c.name in names
    ]
    staged = stage(inputs.landed_orders(spark, sf_dir), columns, "2000-01-01")
    return staged.select("order_key", "unique_id")


@query("staged_documents", """
    SELECT text, lang, n_chars, DATE '2100-01-01' AS execution_date, CAST(doc_id AS VARCHAR) AS ab_id,
           TIMESTAMP '1970-01-01' + to_seconds(doc_id) AS ab_emitted_at,
           md5(concat_ws('-', text, lang, n_chars)) AS unique_id
    FROM documents QUALIFY row_number() OVER (PARTITION BY text, lang, n_chars ORDER BY doc_id DESC) = 1""")
def staged_documents(spark, sf_dir):
    return stage(inputs.landed_documents(spark, sf_dir), inputs.DOCUMENT_COLUMNS, "2100-01-01")


@query("typed_projection", """
    SELECT o_orderkey AS order_key, o_orderdate AS order_date, o_custkey AS customer_cust_key,
           o_orderpriority AS customer_terms_order_priority, o_totalprice AS total_price
    FROM orders""")
def typed_projection(spark, sf_dir):
    return typed_view(inputs.typed_orders(spark, sf_dir), inputs.TYPED_ORDER_IDENTIFIERS)


@query("path_accessors", """
    SELECT o_custkey AS by_field, CAST(o_custkey AS VARCHAR) AS by_path, o_custkey || '' AS by_key,
           o_orderpriority AS by_deep_key, CAST(NULL AS VARCHAR) AS by_whole_key
    FROM orders""")
def path_accessors(spark, sf_dir):
    typed = inputs.typed_orders(spark, sf_dir)
    held = typed.select(
        F.col("customer").alias("s"), F.parse_json(F.to_json("customer")).alias("v"),
        F.to_json("customer").alias("j"),
    )
    at = lambda identifier, **how: nested_value(held.schema, identifier, **how)
    return held.select(
        at("s.custKey").alias("by_field"),
        F.try_variant_get(at("v.custKey"), "$", "string").alias("by_path"),
        at("j.custKey").alias("by_key"),
        at("j.terms.orderPriority").alias("by_deep_key"),
        at("j.terms.orderPriority", split="first").alias("by_whole_key"),
    )


@query("payload_partition_date", """
    SELECT CAST(o_orderkey AS VARCHAR) || '-0' AS ab_id, o_orderdate::DATE AS by_format,
           o_orderdate AS by_cast
    FROM orders""")
def payload_partition_date(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    payload = inputs.text(
        '{"day": "', F.date_format("o_orderdate", "dd/MM/yyyy"), '", "at": {"time": "',
        o.o_orderdate, '"}}',
    )
    return o.select(
        inputs.text(o.o_orderkey, "-0").alias("ab_id"),
        partition_date(payload, "day", "dd/MM/yyyy").alias("by_format"),
        partition_date(payload, "at.time").alias("by_cast"),
    )


EXACT_COLUMNS = [
    ColumnSpec("line_key", "lineKey", "string", is_key=True),
    ColumnSpec("big", "big", "numeric"), ColumnSpec("big_text", "bigText", "string"),
    ColumnSpec("inner_big", "inner.big", "numeric"), ColumnSpec("path_big", "path.big", "numeric"),
    ColumnSpec("path", "path", "string"), ColumnSpec("members", "members", "array"),
]


@query("exact_numbers", """
    WITH l AS (
      SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_extendedprice AS line_key,
             CAST(l_orderkey + 10000000000000000 AS VARCHAR) || '.' || CAST(l_partkey % 9 + 1 AS VARCHAR) AS few,
             CAST(l_orderkey + 10000000000000000 AS VARCHAR) || CAST(l_partkey % 1000 + 1000 AS VARCHAR)
               || '.' || CAST(l_suppkey % 1000 + 1000 AS VARCHAR) || '0001' AS many
      FROM lineitem)
    SELECT DISTINCT line_key, CAST(many AS DECIMAL(38,9)) AS big, few AS big_text,
           CAST(few AS DECIMAL(38,9)) AS inner_big, CAST(many AS DECIMAL(38,9)) AS path_big,
           CAST(NULL AS VARCHAR) AS path, few || many || '{"z":1,"n":2}' AS members
    FROM l""")
def exact_numbers(spark, sf_dir):
    """Numbers of 18 to 29 digits, more than a double holds, in every place that is read."""
    l = inputs.table(spark, sf_dir, "lineitem")  # noqa: E741
    high = inputs.text(l.l_orderkey + 10_000_000_000_000_000)
    few = inputs.text(high, ".", l.l_partkey % 9 + 1)
    many = inputs.text(high, l.l_partkey % 1000 + 1000, ".", l.l_suppkey % 1000 + 1000, "0001")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    payload = inputs.text(
        '{"lineKey": "', key, '", "big": ', many, ', "bigText": ', few, ', "inner": {"big": ', few,
        '}, "path": {"big": ', many, '}, "members": [', few, ", ", many, ', {"z": 1, "n": 2}]}',
    )
    raw = as_raw_landing(l, key, F.lit("1998-12-01").cast("timestamp"), payload)
    columns = [c.name for c in EXACT_COLUMNS]
    return stage(raw, EXACT_COLUMNS, "1998-12-31", key=[]).select(*columns)
