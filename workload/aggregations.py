"""Aggregations."""

from __future__ import annotations

from millrace.operators import dictionary, manifest, projects, quality, relations
from millrace.sources import documents
from workload import inputs
from workload.joins import DATES_SQL
from workload.registered import query


@query("items_by_type", inputs.NODES_SQL + """
    SELECT resource_type, count(*) AS n_items FROM nodes
    WHERE package_name <> 're_data' AND resource_type <> 'analysis' GROUP BY ALL
    UNION ALL SELECT 'source', sum(p_size % 4)::BIGINT FROM part""")
def items_by_type(spark, sf_dir):
    return manifest.counts_by_type(documents.manifest_nodes(inputs.manifests(spark, sf_dir)))


@query("task_totals", inputs.NODES_SQL + """,
    counted AS (
      SELECT project, count(*) FILTER (resource_type = 'model') AS models_count,
             count(*) FILTER (resource_type = 'seed') AS seeds_count,
             count(*) FILTER (resource_type = 'snapshot') AS snapshots_count,
             count(*) FILTER (resource_type = 'test') AS tests_count
      FROM nodes WHERE package_name <> 're_data' GROUP BY ALL)
    SELECT 'prj_' || p_partkey AS project, coalesce(models_count, 0) AS models_count,
           CAST(p_size % 4 AS BIGINT) AS sources_count, coalesce(seeds_count, 0) AS seeds_count,
           coalesce(snapshots_count, 0) AS snapshots_count, coalesce(tests_count, 0) AS tests_count,
           coalesce(models_count + seeds_count + snapshots_count + tests_count, 0) + p_size % 4
             AS total_tasks
    FROM part LEFT JOIN counted ON project = 'prj_' || p_partkey""")
def task_totals(spark, sf_dir):
    return manifest.item_counts(inputs.manifests(spark, sf_dir))


@query("project_dates", DATES_SQL + """
    SELECT 'prj_' || user_id AS project, created_at, last_modified FROM dates""")
def project_dates(spark, sf_dir):
    return projects.project_dates(inputs.commits(spark, sf_dir))


@query("stream_namespaces", """
    SELECT 'c-' || p_partkey AS "connectionId", namespace, CAST(1 AS BIGINT) AS n_streams
    FROM part, LATERAL (VALUES (lower(p_type)), ('unknown')) v(namespace)""")
def stream_namespaces(spark, sf_dir):
    return dictionary.namespaces(dictionary.streams(inputs.connections(spark, sf_dir)))


@query("relations_per_schema", inputs.NODES_SQL + """
    SELECT 'db' AS database, schema_name AS schema, count(*) AS n_relations FROM nodes
    WHERE resource_type IN ('model', 'seed', 'snapshot') GROUP BY ALL""")
def relations_per_schema(spark, sf_dir):
    return relations.relations_per_schema(documents.manifest_nodes(inputs.manifests(spark, sf_dir)))


@query("source_freshness", """
    SELECT user_id, max(ts) AS max_loaded_at,
           CASE WHEN TIMESTAMP '2024-02-01 02:00:00' - max(ts) > INTERVAL 36 HOUR THEN 'error'
                WHEN TIMESTAMP '2024-02-01 02:00:00' - max(ts) > INTERVAL 24 HOUR THEN 'warn'
                ELSE 'pass' END AS status
    FROM events GROUP BY ALL""")
def source_freshness(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    return quality.freshness(events, "ts", "2024-02-01 02:00:00", by=["user_id"])
