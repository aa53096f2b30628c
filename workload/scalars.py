"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import names, types
from millrace.operators import projects
from millrace.operators.relations import qualified, relation_type
from workload import inputs
from workload.registered import query


@query("standard_names", f"""
    WITH i AS (SELECT p_partkey, '__' || p_brand || 'Id.' || p_name || ' ' || p_type || 'X2Go' AS identifier
               FROM part)
    SELECT p_partkey, identifier, {inputs.sql_standard_name("identifier")} AS name FROM i""")
def standard_names(spark, sf_dir):
    p = inputs.table(spark, sf_dir, "part")
    identifier = inputs.text("__", p.p_brand, "Id.", p.p_name, " ", p.p_type, "X2Go")
    return p.select(
        "p_partkey", identifier.alias("identifier"),
        names.standard_name_col(identifier).alias("name"),
    )


@query("type_mapping", """
    WITH t AS (SELECT p_partkey, ['number', 'integer', 'boolean', 'timestamp_with_timezone', 'date',
                      'string', 'object', 'array'][p_size % 8 + 1] AS source_type,
                      CASE WHEN p_size % 3 = 0 THEN 'up_Date_' ELSE '' END || p_type AS identifier FROM part)
    SELECT p_partkey, CASE source_type WHEN 'number' THEN 'numeric' WHEN 'integer' THEN 'integer'
             WHEN 'boolean' THEN 'bool' WHEN 'timestamp_with_timezone' THEN 'timestamp'
             WHEN 'array' THEN 'array' ELSE 'string' END AS raw_type,
           CASE WHEN source_type = 'string' AND lower(identifier) LIKE '%date%' THEN 'timestamp'
             ELSE raw_type END AS typed_type
    FROM t""")
def type_mapping(spark, sf_dir):
    p = inputs.table(spark, sf_dir, "part")
    listed = ("number", "integer", "boolean", "timestamp_with_timezone", "date", "string", "object",
              "array")
    source_type = F.get(F.array(*[F.lit(t) for t in listed]), p.p_size % 8)
    identifier = F.concat(F.when(p.p_size % 3 == 0, F.lit("up_Date_")).otherwise(""), p.p_type)
    return p.select(
        "p_partkey", types.dictionary_type(source_type, identifier).alias("raw_type"),
        types.dictionary_type(source_type, identifier, date_names=True).alias("typed_type"),
    )


@query("single_types", """
    SELECT p_partkey, CASE WHEN p_size % 4 = 1 THEN lower(p_type) WHEN p_size % 4 = 2 THEN p_name
                           ELSE 'string' END AS single
    FROM part""")
def single_types(spark, sf_dir):
    p = inputs.table(spark, sf_dir, "part")
    null, kind = F.lit("null"), F.lower("p_type")
    listed = (
        F.when(p.p_size % 4 == 0, F.array(null)).when(p.p_size % 4 == 1, F.array(null, kind))
        .when(p.p_size % 4 == 2, F.array(F.col("p_name"))).otherwise(F.array(kind, null, F.col("p_name")))
    )
    return p.select("p_partkey", types.single_type(listed).alias("single"))


@query("relation_names", inputs.NODES_SQL + "," + inputs.LISTING_SQL + """
    SELECT DISTINCT CASE table_type WHEN 'BASE TABLE' THEN 'TABLE' WHEN 'VIEW' THEN 'VIEW' END AS kind,
           '`' || table_catalog || '.' || table_schema || '.' || table_name || '`' AS bigquery,
           table_catalog || '.' || table_schema || '.' || table_name AS snowflake,
           CASE table_catalog WHEN 'user' THEN '"user"' ELSE table_catalog END
             || '."' || table_schema || '".' || table_name AS redshift
    FROM listing""")
def relation_names(spark, sf_dir):
    parts = [F.col(c) for c in ("table_catalog", "table_schema", "table_name")]
    return inputs.catalog_listing(spark, sf_dir).select(
        relation_type(F.col("table_type")).alias("kind"),
        *[qualified(d, *parts).alias(d) for d in ("bigquery", "snowflake", "redshift")],
    ).distinct()


@query("dataset_names", """
    SELECT 'c-' || p_partkey AS "connectionId",
           CASE p_size % 3 WHEN 1 THEN 'landing' ELSE 'fallback' END AS raw_dataset,
           CASE p_size % 3 WHEN 0 THEN 'ns_' || lower(p_type) WHEN 1 THEN 'landing' ELSE 'fallback' END
             AS typed_dataset,
           CASE p_size % 3 WHEN 0 THEN 'ns_${SOURCE_NAMESPACE}' WHEN 1 THEN 'landing' ELSE 'fallback' END
             AS typed_dataset_without
    FROM part""")
def dataset_names(spark, sf_dir):
    connections = inputs.connections(spark, sf_dir)
    namespace = F.get(F.col("syncCatalog.streams.stream.namespace"), F.lit(0))
    given, fallback = F.col("namespaceFormat"), F.lit("fallback")
    return connections.select(
        "connectionId", names.raw_dataset(given, fallback).alias("raw_dataset"),
        names.typed_dataset(given, namespace, fallback).alias("typed_dataset"),
        names.typed_dataset(given, F.lit(""), fallback).alias("typed_dataset_without"),
    )


@query("project_links", """
    SELECT c_custkey, 'https://acme.example.com/data-quality/live/data-quality.acme.example.com/prj-'
             || c_custkey || '-x/%23/alerts' AS quality_url,
           'https://acme.example.com/data-catalog/live/data-catalog.acme.example.com/prj-'
             || c_custkey || '-x/%23!/overview' AS docs_url
    FROM customer""")
def project_links(spark, sf_dir):
    c = inputs.table(spark, sf_dir, "customer")
    project = inputs.text("Prj_", c.c_custkey, "_X")
    return c.select(
        "c_custkey", names.quality_url(project, "acme", "example.com").alias("quality_url"),
        names.docs_url(project, "acme", "example.com").alias("docs_url"),
    )


@query("target_schemas", """
    SELECT c_custkey, 'dev_feature_' || c_custkey || '_customer_' || c_name[10:] AS dev_schema,
           'e2e_test_feature_' || c_custkey || '_customer_' || c_name[10:] AS test_schema
    FROM customer""")
def target_schemas(spark, sf_dir):
    c = inputs.table(spark, sf_dir, "customer")
    branch = inputs.text("Feature/", c.c_custkey, "-", c.c_name)
    return c.select(
        "c_custkey", names.target_schema(branch, "dev_").alias("dev_schema"),
        names.target_schema(branch, "e2e_test_").alias("test_schema"),
    )


@query("landing_versions", """
    SELECT p_partkey, CAST(CASE WHEN p_size % 7 = 0 THEN NULL
             WHEN p_size % 7 < 4 AND p_size > 10 THEN 2
             WHEN p_size % 7 = 4 AND p_size = 11 THEN 2
             WHEN p_size % 7 >= 4 AND p_size > 10 THEN 2
             ELSE 1 END AS INTEGER) AS init_version
    FROM part""")
def landing_versions(spark, sf_dir):
    p = inputs.table(spark, sf_dir, "part")
    tag = F.when(p.p_size % 7 == 0, F.lit("latest")).when(
        p.p_size % 7 < 4, inputs.text("1.", p.p_size, ".2")
    ).otherwise(inputs.text("v1.", p.p_size, "-rc1"))
    return p.select("p_partkey", types.landing_format(tag).alias("init_version"))


@query("flag_defaults", """
    SELECT 'prj_' || c_custkey AS project,
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'Default' END AS owner,
           'api_operator_prj_' || c_custkey AS dag, 'False' AS debug, CAST(NULL AS VARCHAR) AS workspace
    FROM customer""")
def flag_defaults(spark, sf_dir):
    return inputs.project_vars(spark, sf_dir).select(
        "project", projects.flag("DAG_OWNER", projects.DEFAULT_OWNER).alias("owner"),
        projects.flag("DAG_ID", projects.default_dag()).alias("dag"),
        projects.flag("DEBUG", "False").alias("debug"),
        projects.flag("AIRBYTE_WORKSPACE_ID").alias("workspace"),
    )


@query("repository_links", """
    SELECT c_custkey, 'https://git.example.com/org/repo_' || c_custkey || '/tree/main/prj?ref_type=heads'
             AS url
    FROM customer""")
def repository_links(spark, sf_dir):
    c = inputs.table(spark, sf_dir, "customer")
    path = inputs.text("org/repo_", c.c_custkey, ".git")
    remote = (
        F.when(c.c_nationkey % 3 == 0, F.concat(F.lit("git@git.example.com:"), path))
        .when(c.c_nationkey % 3 == 1, F.concat(F.lit("https://oauth2:secret@git.example.com/"), path))
        .otherwise(F.concat(F.lit("https://git.example.com/"), path))
    )
    return c.select(
        "c_custkey", names.project_url(remote, F.lit("main"), F.lit("prj")).alias("url")
    )
