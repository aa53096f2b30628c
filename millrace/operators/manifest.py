"""Counts over compiled manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Countable items and the manifest section each lives in; the package whose
# nodes never count.
ITEM_SECTIONS = {
    "models": "nodes",
    "sources": "sources",
    "seeds": "nodes",
    "snapshots": "nodes",
    "tests": "nodes",
}
MONITORING_PACKAGE = "re_data"


def item_count(item: str) -> Column:
    """Items of one kind in a manifest row; counted in place, as a manifest is one row."""
    if item not in ITEM_SECTIONS:
        raise ValueError(f"unknown item type {item!r}: choose from {', '.join(ITEM_SECTIONS)}")
    kind = item[:-1]
    members = F.map_values(F.col(ITEM_SECTIONS[item]))
    counted = F.filter(
        members,
        lambda n: (n["resource_type"] == kind)
        & (F.coalesce(n["package_name"], F.lit("")) != MONITORING_PACKAGE),
    )
    return F.coalesce(F.when(members.isNotNull(), F.size(counted)), F.lit(0)).cast("bigint")


def item_counts(manifests: DataFrame) -> DataFrame:
    """Per project: every kind's count, absent kinds as 0, and the total of tasks."""
    counted = manifests.select(
        "project", *[item_count(i).alias(f"{i}_count") for i in ITEM_SECTIONS]
    )
    total = sum((F.col(f"{i}_count") for i in ITEM_SECTIONS), F.lit(0).cast("bigint"))
    return counted.withColumn("total_tasks", total)


def counts_by_type(nodes: DataFrame) -> DataFrame:
    """Items of each type over all projects, from one row per node; 0 for a type without any."""
    kinds = [i[:-1] for i in ITEM_SECTIONS]
    counted = (
        nodes.where(
            (F.coalesce("package_name", F.lit("")) != MONITORING_PACKAGE)
            & F.col("resource_type").isin(kinds)
            & ((F.col("resource_type") == "source") == (F.col("section") == "sources"))
        )
        .groupBy("resource_type")
        .agg(F.count("*").alias("n_items"))
    )
    # five rows, one for each type
    every = nodes.sparkSession.createDataFrame([(k,) for k in kinds], "resource_type string")
    return F.broadcast(every).join(counted, "resource_type", "left").select(
        "resource_type", F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items")
    )
