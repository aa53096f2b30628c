"""Checks of project requests, many at a time: every record with the rules it breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The request rules. A cron expression has six fields.
PROJECT_NAME = r"^[a-z0-9_]+$"
SCHEDULE_PRESETS = ("@once", "@hourly", "@daily", "@weekly", "@monthly", "@yearly")
CRON = (
    r"^(\*|([0-5]?[0-9])) (\*|([0-5]?[0-9])) (\*|([0-2]?[0-9])) "
    r"(\*|([0-3]?[0-9])) (\*|([0-1]?[0-9])) (\*|([0-6]))$"
)
PROJECT_LEVELS = (
    "DEV", "TEST", "QA", "UAT", "EI", "PRE", "STG", "NON_PROD", "PROD", "CORP", "RVW",
)
WORKLOAD_PLATFORMS = ("Airflow", "Composer")
LENGTHS = {
    "dbt_project_name": (1, 255),
    "dbt_project_owner": (1, 255),
    "dbt_dag_tag": (1, 255),
    "platform_namespace": (1, 255),
    "package": (1, 255),
    "version": (1, 16),
    "branch_name": (1, 255),
    "gcp_project_id": (1, 255),
    "gcp_project_region": (1, 255),
    "gcp_project_sa_email": (1, 255),
    "snowflake_db": (1, 255),
    "snowflake_schema": (1, 255),
    "snowflake_warehouse": (1, 255),
    "snowflake_role": (1, 255),
    "redshift_database": (1, 255),
    "redshift_schema": (1, 255),
    "fabric_database": (1, 255),
    "fabric_schema": (1, 255),
    "network": (1, 255),
    "subnetwork": (1, 255),
    "privatenodes_ip_range": (1, 255),
    "services_secondary_range_name": (1, 255),
    "cluster_secondary_range_name": (1, 255),
}
# Pod names by operator: the cluster operator of the cloud allows longer ones.
POD_NAME, POD_LENGTH, LONG_POD_LENGTH, LONG_POD_OPERATOR = "dbt_k8s_pod_name", 68, 255, "gke"
REQUIRED = (
    "dbt_project_name", "dbt_project_owner", "project_level", "workload_platform", "branch_name",
)


def valid_schedule(value: Column) -> Column:
    return value.isin(*SCHEDULE_PRESETS) | value.rlike(CRON)


def valid_project_name(value: Column) -> Column:
    return value.rlike(PROJECT_NAME)


def broken_rules(columns: list[str], operator: str | None = None) -> Column:
    """Names of the fields at fault, in column order; an optional field may be absent.

    With ``operator`` the requests are for that operator, and one that names another is at fault.
    """
    faults = []
    for c in columns:
        value = F.col(f"`{c}`")
        fault = F.lit(False)
        if c in REQUIRED:
            fault = fault | value.isNull()
        if c in LENGTHS:
            low, high = LENGTHS[c]
            fault = fault | ~F.length(value).between(low, high)
        if c == POD_NAME:
            high = LONG_POD_LENGTH if operator == LONG_POD_OPERATOR else POD_LENGTH
            fault = fault | ~F.length(value).between(1, high)
        if c == "operator" and operator is not None:
            fault = fault | (value != operator)
        if c == "new_project_name":
            fault = fault | ~valid_project_name(value)
        if c == "dbt_dag_schedule_interval":
            fault = fault | ~valid_schedule(value)
        if c == "project_level":
            fault = fault | ~value.isin(*PROJECT_LEVELS)
        if c == "workload_platform":
            fault = fault | ~value.isin(*WORKLOAD_PLATFORMS)
        faults.append(F.when(fault, F.lit(c)))
    return F.array_compact(F.array(*faults))


def validate(requests: DataFrame, operator: str | None = None) -> DataFrame:
    return requests.withColumn("errors", broken_rules(requests.columns, operator))
