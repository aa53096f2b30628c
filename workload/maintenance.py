"""Catalog maintenance and project reads."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import functions as F

from millrace.operators import projects, relations
from millrace.plans import cleanup
from millrace.session import shared_folder, stored
from millrace.sources import documents
from workload import inputs
from workload.joins import DATES_SQL
from workload.registered import query


def _plan_sql(relation: str, schema: str) -> str:
    return inputs.NODES_SQL + "," + inputs.LISTING_SQL + f""",
    found AS (
      SELECT * FROM listing WHERE (table_catalog, table_schema, table_name) IN (
        SELECT ('db', schema_name, relation) FROM nodes
        WHERE resource_type IN ('model', 'seed', 'snapshot')))
    SELECT DISTINCT command FROM (
      SELECT 'DROP ' || CASE table_type WHEN 'BASE TABLE' THEN 'TABLE' WHEN 'VIEW' THEN 'VIEW' END
               || ' ' || {relation} || ';' AS command FROM found
      UNION ALL SELECT 'DROP SCHEMA IF EXISTS ' || {schema} || ' CASCADE;' FROM found)
    WHERE command IS NOT NULL ORDER BY 1 DESC"""


def _plan(spark, sf_dir, dialect):
    nodes = documents.manifest_nodes(inputs.manifests(spark, sf_dir))
    return relations.drop_plan(inputs.catalog_listing(spark, sf_dir), nodes, dialect)


@query("drop_plan", _plan_sql(
    "'`' || table_catalog || '.' || table_schema || '.' || table_name || '`'",
    "'`' || table_catalog || '.' || table_schema || '`'"))
def drop_plan(spark, sf_dir):
    return _plan(spark, sf_dir, "bigquery")


@query("drop_plan_snowflake", _plan_sql(
    "table_catalog || '.' || table_schema || '.' || table_name",
    "table_catalog || '.' || table_schema"))
def drop_plan_snowflake(spark, sf_dir):
    return _plan(spark, sf_dir, "snowflake")


QUOTED = _plan_sql(
    """table_catalog || '."' || table_schema || '".' || table_name""",
    """table_catalog || '."' || table_schema || '"'""")


@query("drop_plan_redshift", QUOTED)
def drop_plan_redshift(spark, sf_dir):
    return _plan(spark, sf_dir, "redshift")


@query("drop_plan_postgres", QUOTED)
def drop_plan_postgres(spark, sf_dir):
    return _plan(spark, sf_dir, "postgres")


@query("drop_plan_fabric", QUOTED)
def drop_plan_fabric(spark, sf_dir):
    return _plan(spark, sf_dir, "fabric")


@query("clean_up_dry_run", _plan_sql(
    "'`' || replace(table_catalog, '`', '``') || '`.`' || table_schema || '`.`' || table_name || '`'",
    "'`' || table_catalog || '`.`' || table_schema || '`'"))
def clean_up_dry_run(spark, sf_dir):
    """What a dry run logs, one command a row; nothing is dropped."""
    return cleanup.dry_run_log(_plan(spark, sf_dir, "spark"))


@query("project_info", DATES_SQL + """
    SELECT 'prj_' || c_custkey AS project, 'data/prj_' || c_custkey AS repo_path,
           created_at, last_modified,
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'Default' END AS owner,
           'c-' || c_custkey AS airbyte_id, CAST(NULL AS VARCHAR) AS airbyte_workspace,
           'api_operator_prj_' || c_custkey AS airflow_dag_name,
           CASE WHEN c_nationkey % 2 = 0 THEN 'True' ELSE 'false' END AS data_quality_enabled,
           'True' AS dbt_docs_enabled, c_mktsegment AS dbt_project_level,
           CASE WHEN c_nationkey % 2 = 0 THEN
             'https://acme.example.com/data-quality/live/data-quality.acme.example.com/prj-'
             || c_custkey || '/%23/alerts' END AS data_quality_url,
           'https://acme.example.com/data-catalog/live/data-catalog.acme.example.com/prj-'
             || c_custkey || '/%23!/overview' AS dbt_docs_url
    FROM customer JOIN list ON project = 'prj_' || c_custkey""")
def project_info(spark, sf_dir):
    folders = inputs.project_folders(spark, sf_dir).withColumn("repo_path", F.concat(F.lit("data/"), "project"))
    dated = projects.with_dates(folders, projects.project_dates(inputs.commits(spark, sf_dir)))
    return projects.project_info(inputs.project_vars(spark, sf_dir), dated, "acme", "example.com")


@query("project_status", """
    SELECT 'prj_' || c_custkey AS project,
           CASE WHEN c_nationkey % 2 = 0 THEN 'True' ELSE 'false' END AS data_quality_enabled,
           'False' AS dbt_governance_enabled,
           CASE WHEN c_acctbal >= 0 THEN 'True' ELSE 'False' END AS dbt_airbyte_replication,
           'False' AS dbt_snapshot_sharding, 'False' AS dbt_snapshot, 'False' AS dbt_source_sharding,
           'False' AS dbt_source, 'False' AS dbt_seed_sharding, 'False' AS dbt_seed, 'False' AS debug
    FROM customer""")
def project_status(spark, sf_dir):
    return projects.project_status(inputs.project_vars(spark, sf_dir))


@query("project_owners", """
    SELECT 'prj_' || c_custkey AS project,
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'Default' END AS owner
    FROM customer""")
def project_owners(spark, sf_dir):
    return projects.project_owner(inputs.project_vars(spark, sf_dir))


@query("orchestration_info", """
    SELECT 'prj_' || c_custkey AS project, 'api_operator_prj_' || c_custkey AS dag_name,
           CAST(NULL AS VARCHAR) AS schedule_interval, 'False' AS dag_tags
    FROM customer""")
def orchestration_info(spark, sf_dir):
    return projects.orchestration(inputs.project_vars(spark, sf_dir))


LISTED = ("region", "nation", "customer", "orders")


@query("catalog_drop_plan", """
    SELECT t.name AS table_name, t.kind AS table_type, n_rows, command FROM (VALUES
        ('region', 'BASE TABLE', (SELECT count(*) FROM region), 'DROP TABLE `spark_catalog`.`listed`.`region`;'),
        ('nation', 'BASE TABLE', (SELECT count(*) FROM nation), 'DROP TABLE `spark_catalog`.`listed`.`nation`;'),
        ('customer', 'BASE TABLE', (SELECT count(*) FROM customer), 'DROP TABLE `spark_catalog`.`listed`.`customer`;'),
        ('orders', 'BASE TABLE', (SELECT count(*) FROM orders), NULL),
        ('open_orders', 'VIEW', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O'),
         'DROP VIEW `spark_catalog`.`listed`.`open_orders`;')) t(name, kind, n_rows, command)""")
def catalog_drop_plan(spark, sf_dir):
    """Given tables written to a schema of their own, listed by the catalog reader, and the plan for those that a
    project owns; the schema goes at the end. It has a fresh name, shown as ``listed``."""
    schema = f"listed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{shared_folder(spark, 'listed')}'")
    try:
        for name in LISTED:
            inputs.table(spark, sf_dir, name).write.saveAsTable(f"{schema}.{name}")
        spark.sql(f"CREATE VIEW {schema}.open_orders AS SELECT * FROM {schema}.orders WHERE o_orderstatus = 'O'")
        listing = relations.catalog_listing(spark, [schema])
        owned = [("model", "spark_catalog", schema, n, None) for n in ("region", "nation")]
        owned += [("seed", "spark_catalog", schema, "c", "customer"), ("snapshot", "spark_catalog", schema, "open_orders", ""),
                  ("test", "spark_catalog", schema, "orders", None)]
        nodes = spark.createDataFrame(owned, "resource_type string, database string, schema string, name string, alias string")
        plan = relations.drop_plan(listing, nodes, "spark", schemas=False)
        counts = [
            spark.table(f"{schema}.{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
            for name in (*LISTED, "open_orders")
        ]
        counted = functools.reduce(lambda a, b: a.unionByName(b), counts)
        kind = F.when(F.col("table_type") == "VIEW", "VIEW").otherwise("TABLE")
        own = F.concat(
            F.lit("DROP "), kind, F.lit(" "), relations.qualified("spark", *[F.col(c) for c in relations.LISTING[:3]]), F.lit(";"),
        )
        found = listing.join(counted, "table_name").join(plan, plan["command"] == own, "left")
        return stored(found.select(
            "table_name", "table_type", "n_rows", F.replace("command", F.lit(schema), F.lit("listed")).alias("command"),
        ), "catalog-plan")
    finally:
        spark.sql(f"DROP DATABASE {schema} CASCADE")
