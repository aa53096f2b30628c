"""Landing tables, catalogs, manifests and project files derived from the given tables.

Every input keeps one row or document per row of its table, so the work of a query grows
with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import NAME_RULES
from millrace.functions.types import ColumnSpec as C
from millrace.sources import documents
from millrace.sources.landing import TYPED_TIME, as_raw_landing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts: str | Column) -> Column:
    """Pieces of text and columns as one text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# --- raw landing tables -------------------------------------------------------------------

EVENT_COLUMNS = [C("k", "k", "integer")]


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return as_raw_landing(df, F.col("event_id"), F.col("ts"), F.col("props"))


ORDER_COLUMNS = [
    C("order_key", "orderKey", "integer", is_key=True),
    C("customer_cust_key", "customer.custKey", "integer"),
    C("customer_priority", "customer.priority", "string"),
    C("order_status", "orderStatus", "string"),
    C("total_price", "totalPrice", "numeric"),
    C("order_date", "orderDate", "timestamp"),
    C("is_open", "isOpen", "bool"),
    C("tags", "tags", "array"),
    C("customer", "customer", "string"),
    C("execution_date", "execution_date", "date"),
    C("ab_id", "_airbyte_ab_id", "string"),
    C("ab_emitted_at", "_airbyte_emitted_at", "timestamp"),
    C("unique_id", "unique_id", "string"),
]


def order_payload(df: DataFrame) -> Column:
    """Orders with nesting, an array, a boolean, and dates written four ways."""
    date = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("")
    )
    return text(
        '{"orderKey": ', df.o_orderkey, ', "customer": {"custKey": "', df.o_custkey,
        '", "priority": "', df.o_orderpriority, '"}, "orderStatus": "', df.o_orderstatus,
        '", "totalPrice": ', df.o_totalprice, ', "orderDate": "', date,
        '", "isOpen": ', df.o_orderstatus == "O",
        ', "tags": ["', df.o_orderstatus, '", ', df.o_custkey, ', null, {"z": 1, "a": "',
        df.o_orderpriority, '"}]}',
    )


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order landed on its day and once more, unchanged, on the next."""
    df = table(spark, sf_dir, "orders")
    copies = df.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    return as_raw_landing(
        copies,
        text(copies.o_orderkey, "-", copies.n),
        F.col("o_orderdate") + F.make_dt_interval(F.col("n")),
        order_payload(copies),
    )


CHANGED_ORDER_COLUMNS = [
    C("order_key", "orderKey", "integer", is_key=True),
    C("order_status", "orderStatus", "string"),
    C("total_price", "totalPrice", "numeric"),
    C("ab_cdc_cursor", "_ab_cdc_cursor", "integer"),
    C("ab_cdc_updated_at", "_ab_cdc_updated_at", "timestamp"),
]


def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change data: every order as placed and, 40 days on, with its final status."""
    df = table(spark, sf_dir, "orders").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    at = F.col("o_orderdate") + F.make_dt_interval(F.col("n") * 40)
    payload = text(
        '{"orderKey": ', df.o_orderkey, ', "orderStatus": "',
        F.when(df.n == 0, F.lit("N")).otherwise(df.o_orderstatus),
        '", "totalPrice": ', df.o_totalprice, ', "_ab_cdc_cursor": ', df.n,
        ', "_ab_cdc_updated_at": "', at, '"}',
    )
    return as_raw_landing(df, text(df.o_orderkey, "-", df.n), at, payload)


LINE_COLUMNS = [
    C("order_key", "orderKey", "integer", is_key=True),
    C("line_number", "lineNumber", "integer", is_key=True),
    C("part_key", "partKey", "integer"),
    C("quantity", "quantity", "numeric"),
    C("extended_price", "extendedPrice", "numeric"),
    C("return_flag", "flags.returned", "string"),
    C("line_status", "flags.status", "string"),
    C("ab_cdc_cursor", "_ab_cdc_cursor", "integer"),
    C("ab_cdc_updated_at", "_ab_cdc_updated_at", "timestamp"),
]


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as change data; keys repeat, each time with another ship date."""
    df = table(spark, sf_dir, "lineitem")
    payload = text(
        '{"orderKey": ', df.l_orderkey, ', "lineNumber": ', df.l_linenumber,
        ', "partKey": ', df.l_partkey, ', "suppKey": ', df.l_suppkey,
        ', "quantity": ', df.l_quantity, ', "extendedPrice": ', df.l_extendedprice,
        ', "flags": {"returned": "', df.l_returnflag, '", "status": "', df.l_linestatus,
        '"}, "_ab_cdc_cursor": ', df.l_partkey,
        ', "_ab_cdc_updated_at": "', F.date_format("l_shipdate", "yyyy-MM-dd"), '"}',
    )
    row_id = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_extendedprice")
    return as_raw_landing(df, row_id, F.col("l_shipdate"), payload)


USER_COLUMNS = [
    C("user_id", "userId", "integer", is_key=True),
    C("event_type", "eventType", "string"),
    C("value", "value", "numeric"),
    C("ab_cdc_cursor", "_ab_cdc_cursor", "integer"),
    C("ab_cdc_updated_at", "_ab_cdc_updated_at", "timestamp"),
]


def landed_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of their user: few keys, many rows each."""
    df = table(spark, sf_dir, "events")
    payload = text(
        '{"userId": ', df.user_id, ', "eventType": "', df.event_type, '", "value": ', df.value,
        ', "_ab_cdc_cursor": ', df.event_id, ', "_ab_cdc_updated_at": "', df.ts, '"}',
    )
    return as_raw_landing(df, F.col("event_id"), F.col("ts"), payload)


DOCUMENT_COLUMNS = [
    C("text", "text", "string"), C("lang", "lang", "string"), C("n_chars", "nChars", "integer"),
]


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as payloads; exact copies are copies of a payload."""
    df = table(spark, sf_dir, "documents")
    payload = F.to_json(F.struct("text", "lang", F.col("n_chars").alias("nChars")))
    return as_raw_landing(df, F.col("doc_id"), F.timestamp_seconds("doc_id"), payload)


TURN_COLUMNS = [
    C("conv_id", "convId", "integer", is_key=True), C("turn", "turn", "integer"),
    C("role", "role", "string"), C("text", "text", "string"),
    C("ab_cdc_cursor", "_ab_cdc_cursor", "integer"),
    C("ab_cdc_updated_at", "_ab_cdc_updated_at", "timestamp"),
]


def landed_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "conversations")
    at = F.timestamp_seconds(F.col("turn") * 60)
    payload = F.to_json(F.struct(
        F.col("conv_id").alias("convId"), "turn", "role", "text",
        F.col("turn").alias("_ab_cdc_cursor"), at.cast("string").alias("_ab_cdc_updated_at"),
    ))
    return as_raw_landing(df, text(df.conv_id, "-", df.turn), at, payload)


# --- typed landing tables -----------------------------------------------------------------

TYPED_ORDER_IDENTIFIERS = [
    "orderKey", "orderDate", "customer.custKey", "customer.terms.orderPriority", "TotalPrice",
]


def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with typed columns, the customer nested in a struct of structs."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderKey"), F.col("o_orderdate").alias("orderDate"),
        F.struct(
            F.col("o_custkey").alias("custKey"),
            F.struct(F.col("o_orderpriority").alias("orderPriority")).alias("terms"),
        ).alias("customer"),
        F.col("o_totalprice").alias("TotalPrice"),
        F.col("o_orderdate").cast("timestamp").alias(TYPED_TIME),
    )


# --- connector catalogs -------------------------------------------------------------------

def connection_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exported connection per part: two streams, nested property schemas."""
    p = table(spark, sf_dir, "part")
    namespace_format = (
        F.when(F.col("p_size") % 3 == 0, F.lit('"namespaceFormat": "ns_${SOURCE_NAMESPACE}", '))
        .when(F.col("p_size") % 3 == 1, F.lit('"namespaceFormat": "landing", '))
        .otherwise("")
    )
    document = text(
        '{"connections": [{"connectionId": "c-', p.p_partkey, '", "destinationId": "d-', p.p_size,
        '", ', namespace_format, '"prefix": "', F.lower(F.translate("p_brand", "#", "_")),
        '_", "syncCatalog": {"streams": ['
        '{"stream": {"name": "', p.p_name, '", "namespace": "', F.lower("p_type"),
        '", "jsonSchema": {"properties": {'
        '"PartKey": {"type": ["null", "integer"]}, '
        '"retailPrice": {"type": "number", "description": "', p.p_type, '"}, '
        '"shipDate": {"type": "string"}, '
        '"madeAt": {"type": "string", "airbyte_type": "timestamp_with_timezone"}, '
        '"detail": {"type": "object", "properties": {'
        '"sizeCm": {"type": "integer"}, '
        '"maker": {"type": ["null", "object"], "properties": {"', p.p_brand,
        '": {"type": "string"}, "updateDate": {"type": "string"}}}, '
        '"free": {"type": "object", "description": "any"}}}, '
        '"choice": {"anyOf": [{"type": "object", "properties": {"isOn": {"type": "boolean"}}}, '
        '{"type": "string"}]}, '
        '"either": {"anyOf": [{"type": "string"}, {"type": "integer"}]}, '
        '"tags": {"type": "array"}, "mixed": {"type": ["string", "integer"]}, "bare": {}}}}, '
        '"config": {"primaryKey": [["retailPrice"], ["PartKey"]]}}, '
        '{"stream": {"name": "', F.initcap("p_type"), 'Stock", "jsonSchema": {"properties": {'
        '"_id": {"type": "string"}, "stockLevel": {"type": ["integer", "null"]}}}}, '
        '"config": {}}]}}]}',
    )
    return p.select(document.alias("document"))


# The same leaves as rows, for the SQL side: stream, position, identifier, type as declared.
CATALOG_SQL = """
    WITH names AS (
      SELECT p_partkey, p_size, p_brand, p_type, p_name, 'c-' || p_partkey AS "connectionId",
             p_name AS s1, upper(p_type[1]) || lower(p_type[2:]) || 'Stock' AS s2
      FROM part),
    leaves AS (
      SELECT n.*, CASE WHEN l.s = 1 THEN s1 ELSE s2 END AS stream, l.s, l.ord,
             replace(l.ident, '@', n.p_brand) AS identifier, l.kind,
             CASE WHEN l.ident = 'retailPrice' THEN n.p_type
                  WHEN l.ident = 'detail.free' THEN 'any' ELSE '' END AS description
      FROM names n, (VALUES
        (1, 0, 'PartKey', 'integer'), (1, 1, 'retailPrice', 'numeric'),
        (1, 2, 'shipDate', 'string'), (1, 3, 'madeAt', 'timestamp'),
        (1, 4, 'detail.sizeCm', 'integer'), (1, 5, 'detail.maker.@', 'string'),
        (1, 6, 'detail.maker.updateDate', 'string'), (1, 7, 'detail.free', 'string'),
        (1, 8, 'choice.isOn', 'bool'), (1, 9, 'either', 'array'), (1, 10, 'tags', 'array'),
        (1, 11, 'mixed', 'string'), (1, 12, 'bare', 'string'),
        (2, 0, '_id', 'string'), (2, 1, 'stockLevel', 'integer')) l(s, ord, ident, kind))"""


def sql_standard_name(value: str) -> str:
    """The name rules as SQL over an expression."""
    for pattern, replacement in NAME_RULES:
        value = f"regexp_replace({value}, '{pattern}', '{replacement}', 'g')"
    return f"lower({value})"


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.connections(connection_documents(spark, sf_dir))


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exported destination per supplier."""
    s = table(spark, sf_dir, "supplier")
    document = text(
        '{"destinations": [{"destinationId": "d-', s.s_suppkey, '", "workspaceId": "w-',
        s.s_nationkey % 5, '", "destinationDefinitionId": "def-', s.s_nationkey,
        '", "connectionConfiguration": {"project_id": "project-', s.s_nationkey,
        '", "database": "db_', s.s_nationkey, '", "dataset_id": "set_', s.s_suppkey, '"}}]}',
    )
    return documents.destinations(s.select(document.alias("document")))


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One destination definition per nation; region 4 publishes no readable version."""
    n = table(spark, sf_dir, "nation")
    tag = F.when(n.n_regionkey == 4, F.lit("dev")).otherwise(text("1.", n.n_nationkey, ".2"))
    document = text(
        '{"destinationDefinitionId": "def-', n.n_nationkey, '", "dockerImageTag": "', tag, '"}'
    )
    return documents.definitions(n.select(document.alias("document")))


# --- manifests and catalog listings -------------------------------------------------------

def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One compiled manifest per part, with as many nodes as the part's size."""
    kinds = F.array(*[F.lit(k) for k in ("model", "seed", "test", "snapshot", "analysis")])
    members = lambda count, build: F.map_from_entries(
        F.transform(F.sequence(F.lit(1), count), build)
    )

    def node(i: Column) -> Column:
        code = F.when(i % 10 == 0, F.lit("SELECT * FROM ML.PREDICT(m)")).when(
            i % 10 == 1, F.lit("ALTER TABLE t ADD CONSTRAINT c")
        ).otherwise(F.concat(F.lit("select * from "), F.col("p_name")))
        return F.struct(
            text("node.", i),
            F.struct(
                F.get(kinds, ((i + F.col("p_partkey")) % 5).cast("int")).alias("resource_type"),
                F.when(i % 7 == 0, F.lit("re_data")).otherwise(F.lit("own")).alias("package_name"),
                text("n_", i).alias("name"),
                F.when(i % 3 == 0, text("a_", i)).alias("alias"),
                F.lit("db").alias("database"), F.lower("p_brand").alias("schema"),
                code.alias("raw_code"),
            ),
        )

    def source(i: Column) -> Column:
        return F.struct(
            text("source.", i),
            F.struct(F.lit("source").alias("resource_type"), F.lit("own").alias("package_name"),
                     text("s_", i).alias("name")),
        )

    document = F.to_json(F.struct(
        members(F.col("p_size"), node).alias("nodes"),
        F.when(F.col("p_size") % 4 > 0, members(F.col("p_size") % 4, source)).alias("sources"),
    ))
    p = table(spark, sf_dir, "part")
    return p.select(text("prj_", p.p_partkey).alias("project"), document.alias("document"))


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.manifests(manifest_documents(spark, sf_dir), F.col("project"))


NODES_SQL = """
    WITH nodes AS (
      SELECT 'prj_' || p_partkey AS project, i,
             ['model', 'seed', 'test', 'snapshot', 'analysis'][(i + p_partkey) % 5 + 1] AS resource_type,
             CASE WHEN i % 7 = 0 THEN 're_data' ELSE 'own' END AS package_name,
             CASE WHEN i % 3 = 0 THEN 'a_' || i ELSE 'n_' || i END AS relation,
             'n_' || i AS name, lower(p_brand) AS schema_name,
             CASE WHEN i % 10 = 0 THEN 'SELECT * FROM ML.PREDICT(m)'
                  WHEN i % 10 = 1 THEN 'ALTER TABLE t ADD CONSTRAINT c'
                  ELSE 'select * from ' || p_name END AS raw_code
      FROM (SELECT *, unnest(range(1, p_size + 1)) AS i FROM part))"""


def catalog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of three databases, one of which the projects own; one entry per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(o.o_orderkey % 5 == 0, F.lit("user")).when(o.o_orderkey % 5 == 1, F.lit("db2"))
        .otherwise("db").alias("table_catalog"),
        text("brand#", o.o_custkey % 30).alias("table_schema"),
        text(F.when(o.o_orderkey % 2 == 0, F.lit("n_")).otherwise("a_"), o.o_orderkey % 61).alias("table_name"),
        F.when(o.o_orderstatus == "O", F.lit("BASE TABLE"))
        .when(o.o_orderstatus == "F", F.lit("VIEW")).otherwise("EXTERNAL").alias("table_type"),
    )


LISTING_SQL = """
    listing AS (
      SELECT CASE o_orderkey % 5 WHEN 0 THEN 'user' WHEN 1 THEN 'db2' ELSE 'db' END AS table_catalog,
             'brand#' || (o_custkey % 30) AS table_schema,
             CASE WHEN o_orderkey % 2 = 0 THEN 'n_' ELSE 'a_' END || (o_orderkey % 61) AS table_name,
             CASE o_orderstatus WHEN 'O' THEN 'BASE TABLE' WHEN 'F' THEN 'VIEW' ELSE 'EXTERNAL' END
               AS table_type
      FROM orders)"""


# --- projects -----------------------------------------------------------------------------

def project_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of every customer's project, already as columns."""
    c = table(spark, sf_dir, "customer")
    project = text("prj_", c.c_custkey)
    flags = {
        "DAG_ID": text("api_operator_", project), "DBT_PROJECT_NAME": project,
        "DBT_PROJECT_DIRECTORY": project, "MANIFEST_NAME": text(project, "_manifest"),
        "PROJECT_LEVEL": c.c_mktsegment,
        "DATA_QUALITY": F.when(c.c_nationkey % 2 == 0, F.lit("True")).otherwise("false"),
        "AIRBYTE_CONNECTION_ID": text("c-", c.c_custkey),
        "AIRBYTE_REPLICATION_FLAG": F.when(c.c_acctbal >= 0, F.lit("True")).otherwise("False"),
    }
    vars_ = F.create_map(*[x for k, v in flags.items() for x in (F.lit(k), v)])
    vars_ = F.when(
        c.c_acctbal >= 0, F.map_concat(vars_, F.create_map(F.lit("DAG_OWNER"), c.c_mktsegment))
    ).otherwise(vars_)
    return c.select(
        project.alias("project"), text("API_SECRETS_DBT_PRJ_", F.upper(project)).alias("config_key"),
        vars_.alias("vars"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with one record per customer."""
    c = table(spark, sf_dir, "customer")
    at = F.timestamp_seconds(c.c_custkey * 3600)
    return c.select(
        c.c_custkey.cast("int").alias("id"), F.lit(None).cast("string").alias("avatars_url"),
        text("prj_", c.c_nationkey).alias("dbt_project_name"),
        text("1.", c.c_nationkey).alias("dbt_project_version"),
        c.c_mktsegment.alias("dbt_project_owner"), F.lit(None).cast("string").alias("dbt_project_tags"),
        text("https://example.com/", c.c_custkey).alias("dbt_project_endpoint_link"),
        c.c_name.alias("dbt_project_deployment_name"),
        at.alias("created_at"), at.alias("updated_at"), (c.c_acctbal >= 0).alias("online_status"),
    )


REGISTRY_SQL = """
    WITH registry AS (
      SELECT CAST(c_custkey AS INTEGER) AS id, CAST(NULL AS VARCHAR) AS avatars_url,
             'prj_' || c_nationkey AS dbt_project_name, '1.' || c_nationkey AS dbt_project_version,
             c_mktsegment AS dbt_project_owner, CAST(NULL AS VARCHAR) AS dbt_project_tags,
             'https://example.com/' || c_custkey AS dbt_project_endpoint_link,
             c_name AS dbt_project_deployment_name,
             TIMESTAMP '1970-01-01' + to_hours(c_custkey) AS created_at,
             TIMESTAMP '1970-01-01' + to_hours(c_custkey) AS updated_at,
             c_acctbal >= 0 AS online_status
      FROM customer)"""


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit log with one commit per event; sign-ups add files."""
    e = table(spark, sf_dir, "events")
    return e.select(
        text("prj_", e.user_id).alias("project"), e.ts.cast("timestamp").alias("ts"),
        F.when(e.event_type == "signup", F.lit("A")).otherwise("M").alias("kind"),
        text("commit-", e.event_id).alias("commit_id"),
    )


def project_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects found on disk, one per customer, with the dates of their files."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        text("prj_", c.c_custkey).alias("project"),
        F.timestamp_seconds(c.c_custkey * 60).alias("file_created"),
        F.timestamp_seconds(c.c_custkey * 60 + 1).alias("file_modified"),
    )
