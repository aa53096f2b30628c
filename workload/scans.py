"""Sources and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import registry as registry_ops
from millrace.session import shared_folder
from millrace.sources import documents, resolver
from millrace.sources.landing import raw_landing, typed_landing
from millrace.sources.registry import read_registry
from workload import inputs
from workload.registered import query

TEST_TARGET = resolver.Target("bigquery", "e2e_test", "proj", "e2e_branch")
PROD_TARGET = resolver.Target("bigquery", "prod", "proj", "main")


@query("raw_landing_scan", """
    SELECT CAST(event_id AS VARCHAR) AS _airbyte_ab_id, ts AS _airbyte_emitted_at,
           props AS _airbyte_data
    FROM events""")
def raw_landing_scan(spark, sf_dir):
    path = shared_folder(spark, "raw-landing")
    inputs.landed_events(spark, sf_dir).write.parquet(path)
    return raw_landing(spark, path)


@query("typed_landing_scan", """
    SELECT o_orderkey AS "orderKey", o_orderdate AS "orderDate", o_totalprice AS "TotalPrice",
           o_orderdate AS _airbyte_extracted_at
    FROM orders""")
def typed_landing_scan(spark, sf_dir):
    path = shared_folder(spark, "typed-landing")
    inputs.typed_orders(spark, sf_dir).write.parquet(path)
    return typed_landing(spark, path).drop("customer")


@query("source_redirect", inputs.NODES_SQL + """
    SELECT project, name,
           CASE WHEN contains(raw_code, 'CREATE MODEL') OR contains(raw_code, 'PREDICT')
                  OR contains(raw_code, 'TRAIN') OR contains(raw_code, 'ML.')
                THEN schema_name || '.' || relation
                ELSE '`proj.e2e_branch_' || schema_name || '.' || relation || '`' END AS test_relation,
           schema_name || '.' || relation AS prod_relation
    FROM nodes WHERE resource_type = 'model'""")
def source_redirect(spark, sf_dir):
    nodes = documents.manifest_nodes(inputs.manifests(spark, sf_dir)).where(
        "resource_type = 'model'"
    )
    relation = F.coalesce("alias", "name")
    plain = F.concat("schema", F.lit("."), relation)
    resolved = lambda target: resolver.resolved_relation(
        F.col("schema"), relation, plain, F.col("raw_code"), target
    )
    return nodes.select(
        "project", "name", resolved(TEST_TARGET).alias("test_relation"),
        resolved(PROD_TARGET).alias("prod_relation"),
    )


@query("repeatable_sample", """
    SELECT * FROM orders
    WHERE CAST('0x' || md5(CAST(o_orderkey AS VARCHAR))[1:8] AS BIGINT) < 429496729""")
def repeatable_sample(spark, sf_dir):
    return resolver.repeatable_sample(inputs.table(spark, sf_dir, "orders"), ["o_orderkey"], 0.1)


@query("random_sample", """
    SELECT count(*) AS n_orders, true AS all_known, true AS none_twice, true AS share_fits FROM orders""")
def random_sample(spark, sf_dir):
    """What holds for any sample: rows of the table, none twice, and about the share asked for."""
    orders = inputs.table(spark, sf_dir, "orders")
    sample = resolver.random_sample(orders, 0.1, seed=7).select("o_orderkey")
    times = sample.groupBy("o_orderkey").agg(F.count("*").alias("taken"))
    marked = orders.select("o_orderkey", F.lit(1).alias("there")).join(times, "o_orderkey", "full")
    taken = F.coalesce(F.sum("taken"), F.lit(0))
    n = F.count("there")
    # five standard deviations of a binomial share, and room for the smallest tables
    room = 5 * F.sqrt(n * 0.09) + 5
    return marked.agg(
        n.alias("n_orders"), (n == F.count("*")).alias("all_known"),
        (F.coalesce(F.max("taken"), F.lit(0)) <= 1).alias("none_twice"),
        F.abs(taken - n * 0.1).between(0, room).alias("share_fits"),
    )


@query("ml_model_guard", inputs.NODES_SQL + """
    SELECT project, name,
           contains(raw_code, 'CREATE MODEL') OR contains(raw_code, 'PREDICT')
             OR contains(raw_code, 'TRAIN') OR contains(raw_code, 'ML.') AS uses_ml,
           regexp_matches(raw_code, '\\b(CREATE MODEL|PREDICT|TRAIN)\\b|\\bML\\.') AS uses_ml_words
    FROM nodes""")
def ml_model_guard(spark, sf_dir):
    nodes = documents.manifest_nodes(inputs.manifests(spark, sf_dir)).where("section = 'nodes'")
    return nodes.select(
        "project", "name", resolver.uses_ml(F.col("raw_code")).alias("uses_ml"),
        resolver.uses_ml(F.col("raw_code"), whole_words=True).alias("uses_ml_words"),
    )


@query("connection_scan", """
    SELECT 'c-' || p_partkey AS "connectionId", 'd-' || p_size AS "destinationId",
           CASE p_size % 3 WHEN 0 THEN 'ns_${SOURCE_NAMESPACE}' WHEN 1 THEN 'landing' END
             AS "namespaceFormat",
           lower(replace(p_brand, '#', '_')) || '_' AS prefix, CAST(2 AS INTEGER) AS n_streams
    FROM part""")
def connection_scan(spark, sf_dir):
    return inputs.connections(spark, sf_dir).select(
        "connectionId", "destinationId", "namespaceFormat", "prefix",
        F.size("syncCatalog.streams").alias("n_streams"),
    )


@query("destination_scan", """
    SELECT 'd-' || s_suppkey AS "destinationId", 'w-' || (s_nationkey % 5) AS "workspaceId",
           'project-' || s_nationkey AS project_id, 'set_' || s_suppkey AS dataset_id
    FROM supplier""")
def destination_scan(spark, sf_dir):
    return inputs.destinations(spark, sf_dir).select(
        "destinationId", "workspaceId", "connectionConfiguration.project_id",
        "connectionConfiguration.dataset_id",
    )


@query("manifest_scan", inputs.NODES_SQL + """
    SELECT project, 'nodes' AS section, 'node.' || i AS id, resource_type, name, raw_code FROM nodes
    UNION ALL
    SELECT 'prj_' || p_partkey, 'sources', 'source.' || i, 'source', 's_' || i, NULL
    FROM (SELECT *, unnest(range(1, p_size % 4 + 1)) AS i FROM part)""")
def manifest_scan(spark, sf_dir):
    return documents.manifest_nodes(inputs.manifests(spark, sf_dir)).select(
        "project", "section", "id", "resource_type", "name", "raw_code"
    )


@query("registry_scan", inputs.REGISTRY_SQL + " SELECT * FROM registry")
def registry_scan(spark, sf_dir):
    path = shared_folder(spark, "registry")
    inputs.registry(spark, sf_dir).write.parquet(f"{path}/data_catalog_metadata")
    return read_registry(spark, path, "data_catalog_metadata")


@query("registry_by_id", inputs.REGISTRY_SQL + " SELECT * FROM registry WHERE id = 77")
def registry_by_id(spark, sf_dir):
    return registry_ops.by_id(inputs.registry(spark, sf_dir), 77)


@query("registry_by_project", inputs.REGISTRY_SQL + """
    SELECT * FROM registry WHERE dbt_project_name = 'prj_7' ORDER BY id LIMIT 1""")
def registry_by_project(spark, sf_dir):
    return registry_ops.by_project(inputs.registry(spark, sf_dir), "prj_7")
