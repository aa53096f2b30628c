"""The project registry: records by id, with inserts, updates and deletes as new tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import looked_up

# The columns of both registries, of user groups and of resource access.
METADATA_SCHEMA = (
    "id int, avatars_url string, dbt_project_name string, dbt_project_version string, "
    "dbt_project_owner string, dbt_project_tags string, dbt_project_endpoint_link string, "
    "dbt_project_deployment_name string, created_at timestamp, updated_at timestamp, "
    "online_status boolean"
)
GROUP_SCHEMA = "group_id int, group_name string"
ACCESS_SCHEMA = "access_id int, group_id int, resource_id int, access_type string"
REQUIRED = (
    "dbt_project_name", "dbt_project_version", "dbt_project_owner", "dbt_project_endpoint_link",
)
WRITABLE = (
    "avatars_url", "dbt_project_name", "dbt_project_version", "dbt_project_owner",
    "dbt_project_tags", "dbt_project_endpoint_link", "dbt_project_deployment_name",
)


def by_id(registry: DataFrame, record_id: int) -> DataFrame:
    return registry.where(F.col("id") == record_id)


def by_project(registry: DataFrame, project: str) -> DataFrame:
    """The first record of a project, by id."""
    return registry.where(F.col("dbt_project_name") == project).orderBy("id").limit(1)


def insert(registry: DataFrame, record: Mapping[str, object], now=None) -> DataFrame:
    """The registry with one more record, under the next id and the insert defaults."""
    missing = [c for c in REQUIRED if record.get(c) is None]
    if missing:
        raise ValueError(f"missing: {', '.join(missing)}")
    stamp = F.current_timestamp() if now is None else F.lit(str(now)).cast("timestamp")
    values = {c: F.lit(record.get(c)) for c in WRITABLE}
    values |= {"created_at": stamp, "updated_at": stamp, "online_status": F.lit(True)}
    next_id = registry.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id"))
    fields = registry.schema.fields
    row = next_id.select(*[
        (F.col("id") if f.name == "id" else values[f.name]).cast(f.dataType).alias(f.name)
        for f in fields
    ])
    return registry.unionByName(row)


def _set(registry: DataFrame, record_id: int, values: Mapping[str, object]) -> DataFrame:
    chosen = F.col("id") == record_id
    return registry.select(*[
        F.when(chosen, F.lit(values[f.name]).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if f.name in values else F.col(f.name)
        for f in registry.schema.fields
    ])


def update(registry: DataFrame, record_id: int, record: Mapping[str, object]) -> DataFrame:
    columns = (*WRITABLE, "updated_at", "online_status")
    return _set(registry, record_id, {c: record[c] for c in columns})


def set_online(registry: DataFrame, record_id: int, online: bool, updated_at) -> DataFrame:
    return _set(registry, record_id, {"updated_at": updated_at, "online_status": online})


def refresh(registry: DataFrame, record_id: int, updated_at) -> DataFrame:
    return set_online(registry, record_id, True, updated_at)


def delete(registry: DataFrame, record_id: int) -> DataFrame:
    return registry.where(F.col("id") != record_id)


def orphaned_access(access: DataFrame, groups: DataFrame, registry: DataFrame) -> DataFrame:
    """Access rows whose group or resource does not exist.

    Both are looked up; access rows, of which one group may hold a large part, stay in place
    while the ids measure small.
    """
    group, resource = groups.select("group_id"), registry.select(F.col("id").alias("resource_id"))
    flagged = (
        access.join(looked_up(group.withColumn("_group", F.lit(True))), "group_id", "left")
        .join(looked_up(resource.withColumn("_resource", F.lit(True))), "resource_id", "left")
    )
    return flagged.where(F.col("_group").isNull() | F.col("_resource").isNull()).select(
        "access_id", "group_id", "resource_id", "access_type",
        F.col("_group").isNull().alias("missing_group"),
        F.col("_resource").isNull().alias("missing_resource"),
    )
