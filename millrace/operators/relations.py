"""Clean-up of a project's relations, computed as a query over the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import quote_ident

# Resource types that own a relation, and catalog types with a drop command.
RELATION_TYPES = ("model", "seed", "snapshot")
DROPPABLE = {"BASE TABLE": "TABLE", "VIEW": "VIEW"}
# Words that no plain name may be in the dialects that quote by need.
RESERVED = (
    "all", "analyse", "analyze", "and", "any", "array", "as", "asc", "asymmetric", "both", "case",
    "cast", "check", "collate", "column", "constraint", "create", "current_date", "current_role",
    "current_time", "current_timestamp", "current_user", "default", "deferrable", "desc",
    "distinct", "do", "else", "end", "except", "false", "fetch", "for", "foreign", "from", "grant",
    "group", "having", "in", "initially", "intersect", "into", "join", "lateral", "leading",
    "limit", "localtime", "localtimestamp", "not", "null", "offset", "on", "only", "or", "order",
    "placing", "primary", "references", "returning", "select", "session_user", "some", "symmetric",
    "table", "then", "to", "trailing", "true", "union", "unique", "user", "using", "variadic",
    "view", "when", "where", "window", "with",
)
DIALECTS = ("bigquery", "snowflake", "redshift", "postgres", "fabric", "spark")


LISTING = ("table_catalog", "table_schema", "table_name", "table_type")
# What the session's catalog calls its tables, and an information schema theirs.
LISTED_TYPES = {"MANAGED": "BASE TABLE", "EXTERNAL": "EXTERNAL", "VIEW": "VIEW"}


def catalog_listing(
    spark: SparkSession, schemas: Sequence[str] | None = None, catalog: str = "spark_catalog"
) -> DataFrame:
    """The relations of a catalog's schemas, all of them unless named, as an information schema lists them.

    What a session alone knows, such as a temporary view, is no relation of the catalog. The listing is
    metadata, which only the driver can ask for: one row per relation, no data.
    """
    if schemas is None:
        schemas = [r[0] for r in spark.sql(f"SHOW SCHEMAS IN `{catalog}`").collect()]
    found = [
        (catalog, schema, table.name, LISTED_TYPES.get(table.tableType, table.tableType))
        for schema in schemas
        for table in spark.catalog.listTables(f"`{catalog}`.`{schema}`")
        if not table.isTemporary
    ]
    return spark.createDataFrame(found, ", ".join(f"{c} string" for c in LISTING))


def exported_listing(export: DataFrame) -> DataFrame:
    """A listing out of an exported information schema, whatever the case of its columns and types."""
    names = {c.lower(): c for c in export.columns}
    missing = [c for c in LISTING if c not in names]
    if missing:
        raise ValueError(f"the export has no {', '.join(missing)}")
    listing = export.select(*[F.col(f"`{names[c]}`").alias(c) for c in LISTING])
    return listing.withColumn("table_type", F.upper(F.trim("table_type")))


def project_relations(nodes: DataFrame) -> DataFrame:
    """Relations a project owns: where each model, seed and snapshot lives."""
    return nodes.where(F.col("resource_type").isin(*RELATION_TYPES)).select(
        "database", "schema", F.coalesce(F.nullif("alias", F.lit("")), "name").alias("relation")
    )


def relations_per_schema(nodes: DataFrame) -> DataFrame:
    return project_relations(nodes).groupBy("database", "schema").agg(
        F.count("*").alias("n_relations")
    )


def listed_relations(listing: DataFrame, nodes: DataFrame) -> DataFrame:
    """Catalog entries that are relations of the project, matched by database, schema and name.

    Owned names are made distinct in the partitioning the join needs anyway, so a name that
    many projects share reaches the join once.
    """
    owned = project_relations(nodes).select(
        F.col("database").alias("table_catalog"), F.col("schema").alias("table_schema"),
        F.col("relation").alias("table_name"),
    ).distinct()
    return listing.join(owned, ["table_catalog", "table_schema", "table_name"], "left_semi")


def relation_type(table_type: Column) -> Column:
    """TABLE or VIEW; NULL for what has no drop command, such as an external table."""
    known = F.when(F.lit(False), F.lit(None).cast("string"))
    for listed, kind in DROPPABLE.items():
        known = known.when(table_type == listed, F.lit(kind))
    return known


def qualified(dialect: str, *parts: Column) -> Column:
    """A dotted name in a warehouse's quoting."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}: choose from {', '.join(DIALECTS)}")
    dotted = lambda columns: F.concat(
        *[x for i, c in enumerate(columns) for x in ((F.lit("."), c) if i else (c,))]
    )
    if dialect == "bigquery":
        return F.concat(F.lit("`"), dotted(parts), F.lit("`"))
    if dialect == "snowflake":
        return dotted(parts)
    if dialect == "spark":
        tick = F.lit("`")
        return dotted([F.concat(tick, F.replace(p, tick, F.lit("``")), tick) for p in parts])
    return dotted([quote_ident(p, RESERVED) for p in parts])


def drop_plan(
    listing: DataFrame, nodes: DataFrame, dialect: str = "bigquery", schemas: bool = True
) -> DataFrame:
    """Drop commands for the project's relations, views first, and for their schemas last.

    Both commands of a relation come from one pass over the listing. ``schemas=False`` leaves
    out the commands that would also drop relations of others.
    """
    found = listed_relations(listing, nodes)
    catalog, schema, table = F.col("table_catalog"), F.col("table_schema"), F.col("table_name")
    drop_relation = F.concat(
        F.lit("DROP "), relation_type(F.col("table_type")), F.lit(" "),
        qualified(dialect, catalog, schema, table), F.lit(";"),
    )
    drop_schema = F.concat(
        F.lit("DROP SCHEMA IF EXISTS "), qualified(dialect, catalog, schema), F.lit(" CASCADE;")
    )
    commands = F.array(drop_relation, drop_schema) if schemas else F.array(drop_relation)
    return (
        found.select(F.explode(commands).alias("command"))
        .where(F.col("command").isNotNull())
        .distinct()
        .orderBy(F.col("command").desc())
    )
