"""Sinks and writes: every query writes into the shared folder and reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import configs, merge, months, registry as registry_ops
from millrace.operators.staging import stage, typed_view
from millrace.plans import raw_stream, schema_docs
from millrace.session import shared_folder, stored
from workload import inputs
from workload.registered import query

# Orders as change data: loaded up to the first date, then merged from the day before the
# second one on.
CHANGED_SQL = """
    WITH changes AS (
      SELECT o_orderkey AS order_key, CASE n WHEN 0 THEN 'N' ELSE o_orderstatus END AS order_status,
             CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,9)) AS total_price,
             CAST(n AS BIGINT) AS ab_cdc_cursor, o_orderdate + to_days(CAST(n * 40 AS INTEGER)) AS landed,
             o_orderkey || '-' || n AS ab_id
      FROM orders, (VALUES (0), (1)) v(n)),
    target AS (
      SELECT *, DATE '1998-01-01' AS execution_date FROM changes WHERE landed < DATE '1998-01-02'
      QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY landed DESC, ab_id DESC) = 1),
    source AS (
      SELECT *, DATE '1998-03-01' AS execution_date FROM changes WHERE landed >= DATE '1998-02-28'
      QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY landed DESC, ab_id DESC) = 1),
    merged AS (
      SELECT * FROM target WHERE order_key NOT IN (SELECT order_key FROM source)
      UNION ALL SELECT * FROM source)"""
CHANGED_COLUMNS_SQL = """
    SELECT order_key, order_status, total_price, ab_cdc_cursor, landed AS ab_cdc_updated_at,
           execution_date, ab_id, landed AS ab_emitted_at, order_key AS unique_id"""
FIRST, SECOND = "1998-01-01", "1998-03-01"


@query("merge_by_key", CHANGED_SQL + CHANGED_COLUMNS_SQL + " FROM merged")
def merge_by_key(spark, sf_dir):
    raw, columns = inputs.changed_orders(spark, sf_dir), inputs.CHANGED_ORDER_COLUMNS
    target = stored(stage(raw, columns, FIRST), "merge-target")
    source = stored(stage(raw, columns, SECOND, incremental=True), "merge-source")
    return merge.merge(target, source)


@query("merge_into_months", CHANGED_SQL + CHANGED_COLUMNS_SQL + """,
           strftime(execution_date, '%Y-%m') AS _month FROM merged""")
def merge_into_months(spark, sf_dir):
    raw, columns = inputs.changed_orders(spark, sf_dir), inputs.CHANGED_ORDER_COLUMNS
    path = shared_folder(spark, "changed-orders")
    raw_stream.load_stream(raw, columns, FIRST, path, full_refresh=True)
    raw_stream.load_stream(raw, columns, SECOND, path)
    return months.read_months(spark, path)


@query("merge_latest_duplicate", """
    WITH lines AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC,
               l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem)
    SELECT o_orderkey AS unique_id, coalesce(l_shipdate, o_orderdate) AS "at",
           l_partkey AS part_key
    FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey AND rn = 1
    UNION ALL
    SELECT l_orderkey, l_shipdate, l_partkey FROM lines
    WHERE rn = 1 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def merge_latest_duplicate(spark, sf_dir):
    target = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("unique_id"), F.col("o_orderdate").alias("at"),
        F.lit(None).cast("bigint").alias("part_key"),
    )
    source = inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("unique_id"), F.col("l_shipdate").alias("at"),
        F.col("l_partkey").alias("part_key"), "l_suppkey", "l_linenumber", "l_extendedprice",
    )
    return merge.merge(
        target, source, on_duplicate="latest",
        order_by=("at", "part_key", "l_suppkey", "l_linenumber", "l_extendedprice"),
    )


@query("month_partitions", """
    SELECT strftime(o_orderdate, '%Y-%m') AS _month, count(*) AS n_orders,
           min(o_orderdate) AS first_day, max(o_orderdate) AS last_day
    FROM orders GROUP BY ALL""")
def month_partitions(spark, sf_dir):
    path = shared_folder(spark, "orders-by-month")
    months.write_months(inputs.table(spark, sf_dir, "orders"), path, "o_orderdate")
    return months.read_months(spark, path).groupBy("_month").agg(
        F.count("*").alias("n_orders"), F.min("o_orderdate").alias("first_day"),
        F.max("o_orderdate").alias("last_day"),
    )


UNDATED = "CASE WHEN {key} % 5 = 0 THEN NULL ELSE {date} END"


@query("merge_undated", f"""
    WITH lines AS (
      SELECT l_orderkey AS unique_id, {UNDATED.format(key="(l_orderkey + 1)", date="max(l_shipdate)")} AS day,
             CAST(max(l_partkey) AS BIGINT) AS part_key
      FROM lineitem GROUP BY l_orderkey),
    merged AS (
      SELECT o_orderkey AS unique_id, {UNDATED.format(key="o_orderkey", date="o_orderdate")} AS day,
             CAST(NULL AS BIGINT) AS part_key
      FROM orders WHERE o_orderkey NOT IN (SELECT unique_id FROM lines)
      UNION ALL SELECT * FROM lines)
    SELECT *, strftime(day, '%Y-%m') AS _month FROM merged""")
def merge_undated(spark, sf_dir):
    """Orders merged with those that have lines; on both sides some have no date."""
    undated = lambda key, date: F.when(key % 5 != 0, date)
    orders, lines = inputs.table(spark, sf_dir, "orders"), inputs.table(spark, sf_dir, "lineitem")
    target = orders.select(
        F.col("o_orderkey").alias("unique_id"), undated(orders.o_orderkey, orders.o_orderdate).alias("day"),
        F.lit(None).cast("bigint").alias("part_key"),
    )
    newest = lines.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("shipped"), F.max("l_partkey").cast("bigint").alias("part_key")
    )
    source = newest.select(
        F.col("l_orderkey").alias("unique_id"), undated(F.col("l_orderkey") + 1, F.col("shipped")).alias("day"),
        "part_key",
    )
    path = shared_folder(spark, "undated-orders")
    merge.merge_into_months(target, path, "day")
    merge.merge_into_months(source, path, "day")
    return months.read_months(spark, path)


@query("full_refresh_load", CHANGED_SQL + CHANGED_COLUMNS_SQL + """,
           strftime(execution_date, '%Y-%m') AS _month FROM target""")
def full_refresh_load(spark, sf_dir):
    raw, columns = inputs.changed_orders(spark, sf_dir), inputs.CHANGED_ORDER_COLUMNS
    path = shared_folder(spark, "changed-orders")
    raw_stream.load_stream(raw, columns, SECOND, path)
    raw_stream.load_stream(raw, columns, FIRST, path, full_refresh=True)
    return months.read_months(spark, path)


@query("staging_view", """
    SELECT o_orderkey AS order_key, o_orderdate AS order_date, o_custkey AS customer_cust_key,
           o_orderpriority AS customer_terms_order_priority, o_totalprice AS total_price
    FROM orders""")
def staging_view(spark, sf_dir):
    view = typed_view(inputs.typed_orders(spark, sf_dir), inputs.TYPED_ORDER_IDENTIFIERS)
    view.createOrReplaceTempView("stg_orders")
    return spark.table("stg_orders")


@query("schema_documents", inputs.CATALOG_SQL + f"""
    , own AS (
      SELECT DISTINCT "connectionId", stream, 1 AS section, v.ord, v.name, v.identifier, v.data_type,
             false AS is_key
      FROM leaves, (VALUES (0, 'execution_date', 'execution_date', 'date'),
        (1, 'ab_id', '_airbyte_ab_id', 'string'), (2, 'ab_emitted_at', '_airbyte_emitted_at', 'timestamp'),
        (3, 'unique_id', 'unique_id', 'string')) v(ord, name, identifier, data_type))
    SELECT *, 'stg_' || {inputs.sql_standard_name("stream")} AS model FROM (
      SELECT "connectionId", stream, 0 AS section, ord, {inputs.sql_standard_name("identifier")} AS name,
             identifier, kind AS data_type, s = 1 AND ord < 2 AS is_key
      FROM leaves UNION ALL SELECT * FROM own)""")
def schema_documents(spark, sf_dir):
    folder = shared_folder(spark, "schema-documents")
    documents = schema_docs.raw_documents(
        inputs.connections(spark, sf_dir), inputs.destinations(spark, sf_dir)
    )
    schema_docs.write_documents(documents, folder)
    models = spark.read.parquet(f"{folder}/models")
    columns = spark.read.parquet(f"{folder}/model_columns").select(
        "connectionId", "stream", "section", "ord", "name", "identifier", "data_type", "is_key"
    )
    return columns.join(models, ["connectionId", "stream"])


RECORD = {
    "dbt_project_name": "new", "dbt_project_version": "1.0", "dbt_project_owner": "someone",
    "dbt_project_endpoint_link": "https://example.com/new",
}


@query("registry_insert", inputs.REGISTRY_SQL + """
    SELECT * FROM registry UNION ALL
    SELECT max(id) + 1, NULL, 'new', '1.0', 'someone', NULL, 'https://example.com/new', NULL,
           TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:00', true FROM registry""")
def registry_insert(spark, sf_dir):
    return registry_ops.insert(inputs.registry(spark, sf_dir), RECORD, now="2024-01-01 00:00:00")


@query("registry_update", inputs.REGISTRY_SQL + """
    SELECT id, avatars_url,
           CASE WHEN id = 12 THEN 'new' ELSE dbt_project_name END AS dbt_project_name,
           CASE WHEN id = 12 THEN '1.0' ELSE dbt_project_version END AS dbt_project_version,
           CASE WHEN id = 12 THEN 'someone' ELSE dbt_project_owner END AS dbt_project_owner,
           dbt_project_tags,
           CASE WHEN id = 12 THEN 'https://example.com/new' ELSE dbt_project_endpoint_link END
             AS dbt_project_endpoint_link,
           CASE WHEN id = 12 THEN NULL ELSE dbt_project_deployment_name END
             AS dbt_project_deployment_name,
           created_at,
           CASE WHEN id IN (12, 13, 14) THEN TIMESTAMP '2024-02-01' ELSE updated_at END AS updated_at,
           CASE WHEN id IN (12, 13) THEN false WHEN id = 14 THEN true ELSE online_status END
             AS online_status
    FROM registry""")
def registry_update(spark, sf_dir):
    at = "2024-02-01 00:00:00"
    record = dict.fromkeys(registry_ops.WRITABLE) | RECORD | {"updated_at": at, "online_status": False}
    registry = registry_ops.update(inputs.registry(spark, sf_dir), 12, record)
    registry = registry_ops.set_online(registry, 13, False, at)
    return registry_ops.refresh(registry, 14, at)


@query("registry_delete", inputs.REGISTRY_SQL + " SELECT * FROM registry WHERE id <> 12")
def registry_delete(spark, sf_dir):
    return registry_ops.delete(inputs.registry(spark, sf_dir), 12)


def _shown(changed, *more):
    """Flags a change may touch, as columns."""
    value = F.col("vars")
    return changed.select(
        *[value[flag].alias(flag.lower()) for flag in more],
        "project", "config_key", value["DAG_OWNER"].alias("owner"), value["DAG_ID"].alias("dag_id"),
        value["MANIFEST_NAME"].alias("manifest"), value["PROJECT_LEVEL"].alias("level"),
    )


@query("config_override", """
    SELECT 'prj_' || c_custkey AS project, 'API_SECRETS_DBT_PRJ_PRJ_' || c_custkey AS config_key,
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS owner,
           'api_operator_prj_' || c_custkey AS dag_id, 'prj_' || c_custkey || '_manifest' AS manifest,
           c_mktsegment AS level, CAST(NULL AS VARCHAR) AS note
    FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
    UNION ALL
    SELECT 'prj_' || s_suppkey, 'API_SECRETS_DBT_PRJ_PRJ_' || s_suppkey, NULL, 'None', NULL, s_name, NULL
    FROM supplier
    UNION ALL
    SELECT 'prj_' || s_suppkey, 'EXTRA', NULL, 'None', NULL, s_name, NULL FROM supplier
    UNION ALL
    SELECT 'prj_' || c_custkey, 'OTHER', NULL, NULL, NULL, NULL,
           CASE WHEN c_custkey IN (SELECT s_suppkey FROM supplier) THEN 'None' END FROM customer""")
def config_override(spark, sf_dir):
    s = inputs.table(spark, sf_dir, "supplier")
    project = inputs.text("prj_", s.s_suppkey)
    keys = F.array(inputs.text("API_SECRETS_DBT_PRJ_PRJ_", s.s_suppkey), F.lit("EXTRA"))
    given = s.select(
        project.alias("project"), F.explode(keys).alias("config_key"),
        F.create_map(
            F.lit("DAG_ID"), F.lit(None).cast("string"), F.lit("PROJECT_LEVEL"), s.s_name
        ).alias("vars"),
    )
    c = inputs.table(spark, sf_dir, "customer")
    empty = F.create_map(F.lit("NOTE"), F.lit(None).cast("string"))
    other = c.select(inputs.text("prj_", c.c_custkey).alias("project"), F.lit("OTHER").alias("config_key"), empty.alias("vars"))
    held = inputs.project_vars(spark, sf_dir).unionByName(other)
    return _shown(configs.override(held, given), "NOTE")


@query("profiles_replace", """
    SELECT 'prj_' || c_custkey AS project, 'dev' AS target, c_mktsegment AS dataset
    FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
    UNION ALL SELECT 'prj_' || s_suppkey, 'prod', s_name FROM supplier""")
def profiles_replace(spark, sf_dir):
    c, s = inputs.table(spark, sf_dir, "customer"), inputs.table(spark, sf_dir, "supplier")
    profiles = c.select(
        inputs.text("prj_", c.c_custkey).alias("project"),
        F.explode(F.array(F.lit("dev"))).alias("target"), c.c_mktsegment.alias("dataset"),
    )
    given = s.select(
        inputs.text("prj_", s.s_suppkey).alias("project"), F.lit("prod").alias("target"),
        s.s_name.alias("dataset"),
    )
    return configs.replace_profiles(profiles, given)


@query("owner_update", """
    SELECT 'prj_' || c_custkey AS project, 'API_SECRETS_DBT_PRJ_PRJ_' || c_custkey AS config_key,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'new owner'
                WHEN c_acctbal >= 0 THEN c_mktsegment END AS owner,
           'api_operator_prj_' || c_custkey AS dag_id, 'prj_' || c_custkey || '_manifest' AS manifest,
           c_mktsegment AS level
    FROM customer""")
def owner_update(spark, sf_dir):
    chosen = F.col("vars")["PROJECT_LEVEL"] == "MACHINERY"
    return _shown(
        configs.set_owner(inputs.project_vars(spark, sf_dir), chosen, F.lit("new owner"))
    )


@query("project_rename", """
    SELECT 'shop_' || c_custkey AS project, 'API_SECRETS_DBT_PRJ_SHOP_' || c_custkey AS config_key,
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS owner,
           'api_operator_shop_' || c_custkey AS dag_id,
           'shop_' || c_custkey || '_manifest' AS manifest, c_mktsegment AS level
    FROM customer UNION ALL
    SELECT 'shop_' || c_custkey, 'UNUSED', CASE WHEN c_acctbal >= 0 THEN c_mktsegment END,
           'api_operator_prj_' || c_custkey, 'prj_' || c_custkey || '_manifest', c_mktsegment
    FROM customer""")
def project_rename(spark, sf_dir):
    """Each project has a second key, which does not belong to its name."""
    new = F.concat(F.lit("shop_"), F.substring_index("project", "_", -1))
    own = inputs.project_vars(spark, sf_dir)
    both = own.unionByName(own.withColumn("config_key", F.lit("UNUSED")))
    return _shown(configs.rename(both, F.col("project"), new))


@query("profile_rename", """
    SELECT 'shop_' || c_custkey AS project, p AS profile,
           CASE p WHEN 'other' THEN c_name ELSE c_mktsegment END AS dataset
    FROM customer, LATERAL (VALUES ('shop_' || c_custkey), ('other')) v(p)""")
def profile_rename(spark, sf_dir):
    c = inputs.table(spark, sf_dir, "customer")
    old, new = inputs.text("prj_", c.c_custkey), inputs.text("shop_", c.c_custkey)
    profiles = c.select(
        old.alias("project"), new.alias("new_name"),
        F.create_map(old, c.c_mktsegment, F.lit("other"), c.c_name).alias("profiles"),
    )
    renamed = configs.rename_profiles(profiles, F.col("project"), F.col("new_name"))
    return renamed.select("project", F.explode("profiles").alias("profile", "dataset"))


@query("project_file_rename", """
    SELECT 'shop_' || c_custkey AS name, 'shop_' || c_custkey AS profile,
           c_mktsegment AS own_models, c_name AS meta
    FROM customer""")
def project_file_rename(spark, sf_dir):
    c = inputs.table(spark, sf_dir, "customer")
    old, new = inputs.text("prj_", c.c_custkey), inputs.text("shop_", c.c_custkey)
    files = c.select(
        old.alias("name"), new.alias("new_name"),
        F.create_map(old, c.c_mktsegment, F.lit("+meta"), c.c_name).alias("models"),
    )
    renamed = configs.rename_project_file(files, F.col("name"), F.col("new_name"))
    return renamed.select(
        "name", "profile", F.col("models")[F.col("name")].alias("own_models"),
        F.col("models")["+meta"].alias("meta"),
    )
