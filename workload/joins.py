"""Joins."""

from __future__ import annotations

from millrace.operators import dictionary, projects, registry as registry_ops, relations
from millrace.sources import documents
from workload import inputs
from workload.registered import query

FORMATS_SQL = """
    formats AS (
      SELECT 'c-' || p_partkey AS "connectionId", CAST(CASE WHEN n_regionkey = 4 THEN NULL
             WHEN n_nationkey > 10 THEN 2 WHEN n_nationkey IS NOT NULL THEN 1 END AS INTEGER) AS init_version
      FROM part LEFT JOIN supplier ON s_suppkey = p_size LEFT JOIN nation ON n_nationkey = s_nationkey)"""


@query("connection_destinations", """
    SELECT 'c-' || p_partkey AS "connectionId", 'd-' || s_suppkey AS "destinationId",
           'w-' || (s_nationkey % 5) AS "workspaceId", 'project-' || s_nationkey AS project_id,
           'db_' || s_nationkey AS warehouse_database, 'set_' || s_suppkey AS dataset_id
    FROM part JOIN supplier ON s_suppkey = p_size""")
def connection_destinations(spark, sf_dir):
    return dictionary.with_destination(
        inputs.connections(spark, sf_dir), inputs.destinations(spark, sf_dir)
    ).select("connectionId", "destinationId", "workspaceId", "project_id", "warehouse_database",
             "dataset_id")


@query("landing_format_chain", "WITH" + FORMATS_SQL + " SELECT * FROM formats")
def landing_format_chain(spark, sf_dir):
    return dictionary.landing_formats(
        inputs.connections(spark, sf_dir), inputs.destinations(spark, sf_dir),
        inputs.definitions(spark, sf_dir),
    )


@query("relations_in_catalog", inputs.NODES_SQL + "," + inputs.LISTING_SQL + """
    SELECT * FROM listing WHERE (table_catalog, table_schema, table_name) IN (
      SELECT ('db', schema_name, relation) FROM nodes WHERE resource_type IN ('model', 'seed', 'snapshot'))""")
def relations_in_catalog(spark, sf_dir):
    nodes = documents.manifest_nodes(inputs.manifests(spark, sf_dir))
    return relations.listed_relations(inputs.catalog_listing(spark, sf_dir), nodes)


@query("key_flags", inputs.CATALOG_SQL + """
    SELECT "connectionId", stream, identifier, s = 1 AND ord < 2 AS is_key FROM leaves""")
def key_flags(spark, sf_dir):
    columns = dictionary.stream_columns(dictionary.streams(inputs.connections(spark, sf_dir)))
    return columns.select("connectionId", "stream", "identifier", "is_key")


DATES_SQL = """
    WITH dates AS (
      SELECT user_id, min(ts) FILTER (event_type = 'signup') AS created_at, max(ts) AS last_modified
      FROM events GROUP BY ALL),
    list AS (
      SELECT 'prj_' || c_custkey AS project,
             CASE WHEN d.created_at IS NULL OR d.last_modified IS NULL
                  THEN TIMESTAMP '1970-01-01' + to_minutes(c_custkey) ELSE d.created_at END AS created_at,
             CASE WHEN d.created_at IS NULL OR d.last_modified IS NULL
                  THEN TIMESTAMP '1970-01-01' + to_seconds(c_custkey * 60 + 1)
                  ELSE d.last_modified END AS last_modified
      FROM customer LEFT JOIN dates d ON user_id = c_custkey)"""


@query("projects_with_dates", DATES_SQL + " SELECT * FROM list")
def projects_with_dates(spark, sf_dir):
    return projects.with_dates(
        inputs.project_folders(spark, sf_dir), projects.project_dates(inputs.commits(spark, sf_dir))
    )


@query("replication_info", "WITH" + FORMATS_SQL + """
    SELECT 'prj_' || c_custkey AS project, 'c-' || c_custkey AS connection_id,
           c_acctbal >= 0 AS enabled, init_version
    FROM customer LEFT JOIN formats ON "connectionId" = 'c-' || c_custkey""")
def replication_info(spark, sf_dir):
    formats = dictionary.landing_formats(
        inputs.connections(spark, sf_dir), inputs.destinations(spark, sf_dir),
        inputs.definitions(spark, sf_dir),
    )
    return projects.replication(inputs.project_vars(spark, sf_dir), formats)


@query("orphaned_access", """
    SELECT CAST(o_orderkey AS INTEGER) AS access_id, CAST(o_custkey % 40 AS INTEGER) AS group_id,
           CAST(o_custkey + o_orderkey % 2 AS INTEGER) AS resource_id, o_orderpriority AS access_type,
           o_custkey % 40 >= 25 AS missing_group,
           o_custkey + o_orderkey % 2 NOT IN (SELECT c_custkey FROM customer) AS missing_resource
    FROM orders WHERE missing_group OR missing_resource""")
def orphaned_access(spark, sf_dir):
    o, n = inputs.table(spark, sf_dir, "orders"), inputs.table(spark, sf_dir, "nation")
    access = o.select(
        o.o_orderkey.cast("int").alias("access_id"), (o.o_custkey % 40).cast("int").alias("group_id"),
        (o.o_custkey + o.o_orderkey % 2).cast("int").alias("resource_id"),
        o.o_orderpriority.alias("access_type"),
    )
    groups = n.select(n.n_nationkey.alias("group_id"), n.n_name.alias("group_name"))
    return registry_ops.orphaned_access(access, groups, inputs.registry(spark, sf_dir))
