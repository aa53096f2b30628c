"""Column dictionaries out of connector catalogs.

Everything about one stream sits in one row of the catalog: the nested property schemas are
opened inside the row until none is left, and one explode at the end yields the columns in document
order. An export lists all connections in one text, so streams are dealt out to all tasks first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import names
from millrace.functions.types import ColumnSpec, dictionary_type, single_type
from millrace.session import looked_up
from millrace.sources.landing import RAW_DATA, RAW_ID, RAW_TIME, TYPED_TIME

PROPERTY = "type string, airbyte_type string, anyOf array<string>, properties string, description string"
MAP = "map<string,string>"

# The columns every raw staging table ends with, as name, identifier, type
# and description, and the source columns and freshness limits of a landing table.
METADATA_COLUMNS = (
    ("execution_date", "execution_date", "date",
     "The date when the replicated data was normalized into the data destination system."),
    ("ab_id", RAW_ID, "string",
     "A unique ID for the data replication record into the destination system."),
    ("ab_emitted_at", RAW_TIME, "timestamp",
     "The date when the replicated data was loaded into the data destination system."),
    ("unique_id", "unique_id", "string",
     "A Unique_id is a surrogate key from the source system's primary key or keys."),
)
RAW_SOURCE_COLUMNS = (
    (RAW_ID, "Transaction ID", "string"),
    (RAW_TIME, "Transaction Import Time", "timestamp"),
    (RAW_DATA, "Transaction Data", "string"),
)
WARN_AFTER_HOURS = 24
ERROR_AFTER_HOURS = 36
UNKNOWN_NAMESPACE = "unknown"


def streams(connections: DataFrame) -> DataFrame:
    """One row per stream of each connection, spread over all tasks."""
    tasks = connections.sparkSession.sparkContext.defaultParallelism
    return connections.select(
        "connectionId", "destinationId", "namespaceFormat", "prefix",
        F.explode("syncCatalog.streams").alias("s"),
    ).repartition(tasks).select(
        "connectionId", "destinationId", "namespaceFormat",
        F.coalesce("prefix", F.lit("")).alias("prefix"),
        F.col("s.stream.name").alias("stream"),
        F.col("s.stream.namespace").alias("namespace"),
        F.col("s.stream.jsonSchema.properties").alias("properties"),
        F.coalesce(
            F.flatten(F.filter(F.col("s.config.primaryKey"), lambda k: k.isNotNull())),
            F.array().cast("array<string>"),
        ).alias("primary_key"),
    )


def _entry(identifier: Column, source_type: Column, description: Column, inner: Column) -> Column:
    return F.struct(
        identifier.alias("identifier"),
        source_type.cast("string").alias("source_type"),
        F.coalesce(description, F.lit("")).alias("description"),
        inner.cast("string").alias("inner"),
    )


def _settled(identifier: Column, source_type: Column, description: Column) -> Column:
    return _entry(identifier, source_type, description, F.lit(None))


def _open(identifier: Column, description: Column, inner: Column) -> Column:
    return _entry(identifier, F.lit(None), description, inner)


def _declared_type(schema: Column) -> Column:
    listed = F.from_json(schema["type"], "array<string>")
    return F.when(schema["type"].startswith("["), single_type(listed)).otherwise(schema["type"])


def _properties(text: Column) -> Column:
    """Properties of an object schema, in order: name, parsed schema and plain type.

    Each property is parsed once here; what follows only looks at fields.
    """
    parsed = F.transform(
        F.map_entries(F.from_json(text, MAP)),
        lambda p: F.struct(p.key.alias("name"), F.from_json(p.value, PROPERTY).alias("schema")),
    )
    return F.transform(
        parsed,
        lambda p: F.struct(
            p["name"].alias("name"), p["schema"].alias("schema"),
            _declared_type(p["schema"]).alias("kind"),
        ),
    )


def _object_or_leaf(identifier: Column, schema: Column, kind: Column, missing: str) -> Column:
    """An object with properties stays open; one without is a string; the rest are leaves."""
    return (
        F.when((kind == "object") & schema["properties"].isNotNull(),
               _open(identifier, schema["description"], schema["properties"]))
        .when(kind == "object", _settled(identifier, F.lit("string"), schema["description"]))
        .otherwise(_settled(identifier, F.coalesce(kind, F.lit(missing)), schema["description"]))
    )


def _top_level(name: Column, schema: Column, kind: Column) -> Column:
    """Entries of a top-level property: a declared connector type first, then a choice of
    types, then the plain type."""
    branches = F.filter(
        F.transform(schema["anyOf"], lambda b: F.from_json(b, PROPERTY)["properties"]),
        lambda inner: inner.isNotNull(),
    )
    opened = F.transform(branches, lambda inner: _open(name, schema["description"], inner))
    choice = F.when(F.size(opened) > 0, opened).otherwise(
        F.array(_settled(name, F.lit("array"), schema["description"]))
    )
    return (
        F.when(F.coalesce(schema["airbyte_type"], F.lit("")) != "",
               F.array(_settled(name, schema["airbyte_type"], schema["description"])))
        .when(F.size(schema["anyOf"]) > 0, choice)
        .otherwise(F.array(_object_or_leaf(name, schema, kind, "unknown")))
    )


def _placed(entry: Column, place: Column) -> Column:
    """An entry led by its place in the document: the positions of its ancestors and its own."""
    return F.struct(place.alias("place"), entry.alias("entry"))


def _children(placed: Column) -> Column:
    """An open entry's properties as entries below its path."""
    entry = placed["entry"]
    return F.transform(
        _properties(entry["inner"]),
        lambda p, i: _placed(
            _object_or_leaf(F.concat(entry["identifier"], F.lit("."), p["name"]), p["schema"], p["kind"], "string"),
            F.concat(placed["place"], F.array(i)),
        ),
    )


def _sorted_out(entries: Column, settled: Column | None = None) -> Column:
    """Settled entries beside those still open; ``entries`` is looked at twice but made once."""
    is_open = lambda e: e["entry"]["inner"].isNotNull()

    def split(found: Column) -> Column:
        done = F.filter(found, lambda e: ~is_open(e))
        return F.struct(
            (done if settled is None else F.concat(settled, done)).alias("settled"),
            F.filter(found, is_open).alias("open"),
        )

    return F.transform(F.array(entries), split)[0]


def flattened_properties(properties: Column) -> Column:
    """Leaves of a property schema, in document order, with dotted identifiers.

    Each round opens the entries that are open, and only those: what is settled is carried beside
    them. A level of objects is two pairs of braces, so half as many rounds as the text has opening
    ones always suffice; once nothing is open a round does nothing. Places restore the order.
    """
    top = F.flatten(
        F.transform(
            _properties(properties), lambda p: _top_level(p["name"], p["schema"], p["kind"])
        )
    )
    braces = F.length(properties) - F.length(F.replace(properties, F.lit("{"), F.lit("")))
    return F.aggregate(
        F.sequence(F.lit(0), (braces / 2).cast("int")),
        _sorted_out(F.transform(top, lambda e, i: _placed(e, F.array(i)))),
        lambda state, _: F.when(
            F.size(state["open"]) > 0,
            _sorted_out(F.flatten(F.transform(state["open"], _children)), state["settled"]),
        ).otherwise(state),
        lambda state: F.transform(F.array_sort(state["settled"]), lambda e: e["entry"]),
    )


def stream_columns(
    streams: DataFrame, date_names: bool = False, keep: Sequence[str] = ("connectionId", "stream")
) -> DataFrame:
    """The column dictionary of every stream, in document order.

    ``date_names`` applies the typed-landing rule for names that speak of a date.
    """
    leaves = streams.select(
        *keep, "primary_key",
        F.posexplode(flattened_properties(F.col("properties"))).alias("ord", "leaf"),
    )
    identifier = F.col("leaf.identifier")
    return leaves.select(
        *keep, "ord",
        names.standard_name_col(identifier).alias("name"),
        identifier.alias("identifier"),
        dictionary_type(F.col("leaf.source_type"), identifier, date_names).alias("data_type"),
        F.col("leaf.description").alias("description"),
        F.array_contains("primary_key", identifier).alias("is_key"),
        F.array_position("primary_key", identifier).cast("int").alias("key_position"),
    )


def with_metadata_columns(columns: DataFrame, streams: DataFrame) -> DataFrame:
    """Raw staging tables end with four columns of their own, a section behind the properties."""
    keep = [c for c in columns.columns if c in streams.columns]
    lines = F.array(
        *[
            F.struct(
                F.lit(1).alias("section"), F.lit(i).alias("ord"), F.lit(n).alias("name"),
                F.lit(ident).alias("identifier"), F.lit(dtype).alias("data_type"),
                F.lit(text).alias("description"), F.lit(False).alias("is_key"),
                F.lit(0).alias("key_position"),
            )
            for i, (n, ident, dtype, text) in enumerate(METADATA_COLUMNS)
        ]
    )
    own = streams.select(*keep, F.explode(lines).alias("c")).select(*keep, "c.*")
    return columns.withColumn("section", F.lit(0)).unionByName(own)


def column_specs(columns: DataFrame) -> list[ColumnSpec]:
    """The dictionary of one stream, for building its projection. As wide as the table, no
    longer than a select list."""
    order = [c for c in ("section", "ord") if c in columns.columns]
    rows = columns.orderBy(*order).select(
        "name", "identifier", "data_type", "description", "is_key", "key_position"
    )
    return [ColumnSpec(**row.asDict()) for row in rows.collect()]


def connections_of(connections: DataFrame, connection_ids: Sequence[str]) -> DataFrame:
    return connections.where(F.col("connectionId").isin(list(connection_ids)))


def with_destination(connections: DataFrame, destinations: DataFrame, workspace_id: str | None = None) -> DataFrame:
    """Connections with their destination's settings, optionally of one workspace.

    Destinations that measure small are broadcast, so that the connections stay where they are.
    """
    if workspace_id is not None:
        destinations = destinations.where(F.col("workspaceId") == workspace_id)
    settings = destinations.select(
        "destinationId", "workspaceId",
        F.col("connectionConfiguration.project_id").alias("project_id"),
        F.col("connectionConfiguration.database").alias("warehouse_database"),
        F.col("connectionConfiguration.dataset_id").alias("dataset_id"),
    )
    return connections.join(looked_up(settings), "destinationId")


def raw_sources(streams: DataFrame, destinations: DataFrame) -> DataFrame:
    """Source tables of raw landing data: dataset, logical and physical name, freshness."""
    joined = with_destination(streams, destinations)
    return joined.select(
        "connectionId", "stream",
        names.raw_dataset(F.col("namespaceFormat"), F.col("dataset_id")).alias("source"),
        F.col("project_id").alias("database"),
        F.concat(F.lit("raw_"), names.standard_name_col(F.col("stream"))).alias("name"),
        F.concat(F.lit(names.RAW_TABLE_PREFIX), "prefix", "stream").alias("identifier"),
        *_freshness(RAW_TIME),
        F.array(
            *[
                F.struct(F.lit(n).alias("name"), F.lit(d).alias("description"),
                         F.lit(t).alias("data_type"))
                for n, d, t in RAW_SOURCE_COLUMNS
            ]
        ).alias("columns"),
    )


def typed_sources(streams: DataFrame, destinations: DataFrame, platform: str = "bigquery") -> DataFrame:
    """Source tables of typed landing data; the physical name is also the logical one."""
    database = "project_id" if platform in ("bigquery", "", None) else "warehouse_database"
    joined = with_destination(streams, destinations)
    physical = F.concat("prefix", "stream")
    return joined.select(
        "connectionId", "stream", stream_namespace().alias("namespace"),
        names.typed_dataset(
            F.col("namespaceFormat"), stream_namespace(), F.col("dataset_id")
        ).alias("source"),
        F.col(database).alias("database"),
        physical.alias("name"), physical.alias("identifier"),
        F.concat(F.lit("stg_"), physical).alias("model"),
        *_freshness(TYPED_TIME),
    )


def _freshness(loaded_at: str) -> list[Column]:
    return [
        F.lit(WARN_AFTER_HOURS).alias("warn_after_hours"),
        F.lit(ERROR_AFTER_HOURS).alias("error_after_hours"),
        F.lit(loaded_at).alias("loaded_at_field"),
    ]


def stream_namespace() -> Column:
    """Namespace a stream is grouped under."""
    return F.coalesce("namespace", F.lit(UNKNOWN_NAMESPACE))


def namespaces(streams: DataFrame) -> DataFrame:
    """Streams per connection and namespace, as counts: members stay rows of ``streams``."""
    return streams.groupBy("connectionId", stream_namespace().alias("namespace")).agg(
        F.count("*").alias("n_streams")
    )


def landing_formats(connections: DataFrame, destinations: DataFrame, definitions: DataFrame) -> DataFrame:
    """Landing format of every connection; NULL where a link of the chain is missing."""
    from millrace.functions.types import landing_format

    tags = looked_up(definitions.select("destinationDefinitionId", "dockerImageTag"))
    formats = (
        destinations.select("destinationId", "destinationDefinitionId")
        .join(tags, "destinationDefinitionId", "left")
        .select("destinationId", landing_format(F.col("dockerImageTag")).alias("init_version"))
    )
    return (
        connections.select("connectionId", "destinationId")
        .join(looked_up(formats), "destinationId", "left").select("connectionId", "init_version")
    )
