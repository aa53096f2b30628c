"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import dictionary, relations, validation
from millrace.operators.staging import landing_window, latest_payloads
from millrace.sources import documents
from workload import inputs
from workload.registered import query

RAW_SQL = """SELECT CAST(event_id AS VARCHAR) AS _airbyte_ab_id, ts AS _airbyte_emitted_at,
           props AS _airbyte_data FROM events"""


@query("full_load_window", RAW_SQL + " WHERE ts < DATE '2024-01-16' AND ts >= DATE '2024-01-03'")
def full_load_window(spark, sf_dir):
    return landing_window(
        inputs.landed_events(spark, sf_dir), "2024-01-15", incremental=False, date_from="2024-01-03"
    )


@query("lookback_window", RAW_SQL + " WHERE ts >= DATE '2024-01-14'")
def lookback_window(spark, sf_dir):
    return landing_window(inputs.landed_events(spark, sf_dir), "2024-01-15", incremental=True)


@query("newest_payloads", RAW_SQL + """
    QUALIFY row_number() OVER (PARTITION BY props ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""")
def newest_payloads(spark, sf_dir):
    return latest_payloads(inputs.landed_events(spark, sf_dir))


@query("owned_resource_types", inputs.NODES_SQL + """
    SELECT 'db' AS database, schema_name AS schema, relation FROM nodes
    WHERE resource_type IN ('model', 'seed', 'snapshot')""")
def owned_resource_types(spark, sf_dir):
    return relations.project_relations(documents.manifest_nodes(inputs.manifests(spark, sf_dir)))


@query("connections_of_workspace", """
    SELECT 'c-' || p_partkey AS "connectionId", 'd-' || p_size AS "destinationId",
           'project-' || s_nationkey AS project_id
    FROM part JOIN supplier ON s_suppkey = p_size
    WHERE s_nationkey % 5 = 3""")
def connections_of_workspace(spark, sf_dir):
    return dictionary.with_destination(
        inputs.connections(spark, sf_dir), inputs.destinations(spark, sf_dir), "w-3"
    ).select("connectionId", "destinationId", "project_id")


@query("request_validation", """
    WITH requests AS (
      SELECT c_custkey, replace(c_name, 'C', '') AS name,
             CASE c_nationkey % 5 WHEN 0 THEN '@daily' WHEN 1 THEN '0 30 12 * * 1' WHEN 2 THEN '30 12 * * 1'
                  WHEN 3 THEN '@yearly' ELSE 'often' END AS schedule,
             CASE WHEN c_acctbal >= 0 THEN 'PROD' ELSE c_mktsegment END AS level
      FROM customer)
    SELECT c_custkey AS id, concat_ws(',',
      CASE WHEN NOT regexp_matches(name, '^[a-z0-9_]+$') THEN 'new_project_name' END,
      CASE WHEN schedule IN ('30 12 * * 1', 'often') THEN 'dbt_dag_schedule_interval' END,
      CASE WHEN c_custkey % 7 = 0 THEN 'operator' END,
      CASE WHEN c_custkey % 80 NOT BETWEEN 1 AND 68 THEN 'dbt_k8s_pod_name' END,
      CASE WHEN c_custkey % 300 NOT BETWEEN 1 AND 255 THEN 'snowflake_db' END,
      CASE WHEN level <> 'PROD' THEN 'project_level' END,
      CASE WHEN c_custkey % 10 = 0 THEN 'branch_name' END) AS errors
    FROM requests""")
def request_validation(spark, sf_dir):
    c = inputs.table(spark, sf_dir, "customer")
    schedules = F.array(*[F.lit(s) for s in ("@daily", "0 30 12 * * 1", "30 12 * * 1", "@yearly", "often")])
    requests = c.select(
        c.c_custkey.alias("id"),
        F.translate("c_name", "C", "").alias("new_project_name"),
        F.get(schedules, c.c_nationkey % 5).alias("dbt_dag_schedule_interval"),
        F.when(c.c_custkey % 7 == 0, F.lit("gke")).otherwise("k8s").alias("operator"),
        F.repeat(F.lit("p"), (c.c_custkey % 80).cast("int")).alias("dbt_k8s_pod_name"),
        F.repeat(F.lit("d"), (c.c_custkey % 300).cast("int")).alias("snowflake_db"),
        F.when(c.c_acctbal >= 0, F.lit("PROD")).otherwise(c.c_mktsegment).alias("project_level"),
        F.when(c.c_custkey % 10 > 0, F.lit("main")).alias("branch_name"),
    )
    return validation.validate(requests, "k8s").select("id", F.concat_ws(",", "errors").alias("errors"))
