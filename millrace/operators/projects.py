"""Reads over projects: dates, list, information, status and integrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import names

# Status columns with the flag behind each; an absent flag reads as False.
STATUS_FLAGS = {
    "data_quality_enabled": "DATA_QUALITY",
    "dbt_governance_enabled": "DATAHUB_ENABLED",
    "dbt_airbyte_replication": "AIRBYTE_REPLICATION_FLAG",
    "dbt_snapshot_sharding": "DBT_SNAPSHOT_SHARDING",
    "dbt_snapshot": "DBT_SNAPSHOT",
    "dbt_source_sharding": "DBT_SOURCE_SHARDING",
    "dbt_source": "DBT_SOURCE",
    "dbt_seed_sharding": "DBT_SEED_SHARDING",
    "dbt_seed": "DBT_SEED",
    "debug": "DEBUG",
}
DEFAULT_OWNER = "Default"


def flag(name: str, default: str | Column | None = None) -> Column:
    """A flag as text, with a default for an absent one."""
    value = F.col("vars")[name]
    if default is None:
        return value
    return F.coalesce(value, F.lit(default) if isinstance(default, str) else default)


def is_true(value: Column) -> Column:
    return F.coalesce(F.lower(value) == "true", F.lit(False))


def default_dag() -> Column:
    return F.concat(F.lit("dbt_"), F.col("project"))


def project_dates(commits: DataFrame) -> DataFrame:
    """Created with the oldest addition, last modified with the newest commit."""
    return commits.groupBy("project").agg(
        F.min(F.when(F.col("kind") == "A", F.col("ts"))).alias("created_at"),
        F.max("ts").alias("last_modified"),
    )


def with_dates(projects: DataFrame, dates: DataFrame) -> DataFrame:
    """Projects with both dates of their history, or both of their files if one is missing."""
    both = F.col("d.created_at").isNotNull() & F.col("d.last_modified").isNotNull()
    kept = [F.col(f"p.`{c}`") for c in projects.columns if c not in ("file_created", "file_modified")]
    return projects.alias("p").join(dates.alias("d"), "project", "left").select(
        *kept,
        F.when(both, F.col("d.created_at")).otherwise(F.col("p.file_created")).alias("created_at"),
        F.when(both, F.col("d.last_modified")).otherwise(F.col("p.file_modified")).alias("last_modified"),
    )


def project_list(projects: DataFrame, dates: DataFrame) -> DataFrame:
    """All projects, newest first."""
    return with_dates(projects, dates).orderBy(F.col("created_at").desc(), "project")


def last_commits(commits: DataFrame) -> DataFrame:
    """The newest commit of each project."""
    rest = [c for c in commits.columns if c not in ("project", "ts")]
    newest = F.max(F.struct("ts", *rest))
    return commits.groupBy("project").agg(newest.alias("m")).select("project", "m.*")


def project_info(flags: DataFrame, dated: DataFrame, customer: str, domain: str) -> DataFrame:
    """What is known of each project: flags with their defaults, dates, path and links.

    ``dated`` holds project, repo_path and the two dates, as ``with_dates`` gives them; a project
    that it lacks has none.
    """
    flags = flags.join(dated.select("project", "repo_path", "created_at", "last_modified"), "project", "left")
    quality, docs = flag("DATA_QUALITY", "False"), flag("DBT_DOCS_ENABLED", "True")
    project = F.col("project")
    return flags.select(
        "project",
        flag("DAG_OWNER", DEFAULT_OWNER).alias("owner"),
        flag("AIRBYTE_CONNECTION_ID").alias("airbyte_id"),
        flag("AIRBYTE_WORKSPACE_ID").alias("airbyte_workspace"),
        flag("DAG_ID", default_dag()).alias("airflow_dag_name"),
        "repo_path", "created_at", "last_modified",
        quality.alias("data_quality_enabled"),
        docs.alias("dbt_docs_enabled"),
        flag("PROJECT_LEVEL").alias("dbt_project_level"),
        F.when(is_true(quality), names.quality_url(project, customer, domain)).alias("data_quality_url"),
        F.when(is_true(docs), names.docs_url(project, customer, domain)).alias("dbt_docs_url"),
    )


def project_status(flags: DataFrame) -> DataFrame:
    return flags.select(
        "project", *[flag(f, "False").alias(column) for column, f in STATUS_FLAGS.items()]
    )


def project_owner(flags: DataFrame) -> DataFrame:
    return flags.select("project", flag("DAG_OWNER", DEFAULT_OWNER).alias("owner"))


def orchestration(flags: DataFrame) -> DataFrame:
    return flags.select(
        "project",
        flag("DAG_ID", default_dag()).alias("dag_name"),
        flag("DAG_SCHEDULE_INTERVAL").alias("schedule_interval"),
        flag("DAG_TAG", "False").alias("dag_tags"),
    )


def replication(flags: DataFrame, formats: DataFrame) -> DataFrame:
    """Connection of each project, whether it replicates, and its landing format."""
    chosen = flags.select(
        "project",
        flag("AIRBYTE_CONNECTION_ID").alias("connection_id"),
        is_true(flag("AIRBYTE_REPLICATION_FLAG")).alias("enabled"),
    )
    return chosen.join(
        formats.select(F.col("connectionId").alias("connection_id"), "init_version"),
        "connection_id", "left",
    ).select("project", "connection_id", "enabled", "init_version")
