"""Exported JSON documents: connections, destinations, their definitions, manifests.

Schemas are given, never inferred: inference would turn maps keyed by name into structs as
wide as the data. Property schemas stay text, since they nest without a fixed depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STREAM = (
    "struct<stream: struct<name: string, namespace: string, "
    "jsonSchema: struct<properties: string>>, "
    "config: struct<primaryKey: array<array<string>>>>"
)
CONNECTION = (
    "struct<connectionId: string, destinationId: string, namespaceFormat: string, "
    f"prefix: string, syncCatalog: struct<streams: array<{STREAM}>>>"
)
DESTINATION = (
    "struct<destinationId: string, workspaceId: string, destinationDefinitionId: string, "
    "connectionConfiguration: struct<project_id: string, database: string, dataset_id: string>>"
)
DEFINITION = "struct<destinationDefinitionId: string, dockerImageTag: string>"
NODE = (
    "struct<resource_type: string, package_name: string, name: string, alias: string, "
    "database: string, schema: string, raw_code: string>"
)
MANIFEST = f"struct<nodes: map<string, {NODE}>, sources: map<string, {NODE}>>"


def document_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path and whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("document")
    )


def _members(documents: DataFrame, document: str, member: str, schema: str) -> DataFrame:
    """Members of the listed array, or the document itself where it is a single one."""
    listed = F.from_json(F.col(document), f"struct<{member}: array<{schema}>>")[member]
    single = F.array(F.from_json(F.col(document), schema))
    return documents.select(F.explode(F.coalesce(listed, single)).alias("d")).select("d.*")


def connections(documents: DataFrame, document: str = "document") -> DataFrame:
    return _members(documents, document, "connections", CONNECTION)


def destinations(documents: DataFrame, document: str = "document") -> DataFrame:
    return _members(documents, document, "destinations", DESTINATION)


def definitions(documents: DataFrame, document: str = "document") -> DataFrame:
    return _members(documents, document, "destinationDefinitions", DEFINITION)


def manifests(documents: DataFrame, project: Column, document: str = "document") -> DataFrame:
    """One row per project: its nodes and sources as maps by id."""
    return documents.select(
        project.alias("project"), F.from_json(F.col(document), MANIFEST).alias("m")
    ).select("project", "m.nodes", "m.sources")


def manifest_nodes(manifests: DataFrame) -> DataFrame:
    """One row per node or source of a manifest."""
    entries = F.concat(
        F.transform(
            F.coalesce(F.map_entries("nodes"), F.array()),
            lambda e: F.struct(F.lit("nodes").alias("section"), e.key.alias("id"), e.value.alias("n")),
        ),
        F.transform(
            F.coalesce(F.map_entries("sources"), F.array()),
            lambda e: F.struct(F.lit("sources").alias("section"), e.key.alias("id"), e.value.alias("n")),
        ),
    )
    return manifests.select("project", F.explode(entries).alias("e")).select(
        "project", "e.section", "e.id", "e.n.*"
    )
