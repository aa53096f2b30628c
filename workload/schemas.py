"""Semi-structured schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import dictionary
from workload import inputs
from workload.registered import query


@query("catalog_streams", inputs.CATALOG_SQL + """
    SELECT DISTINCT "connectionId", stream, lower(replace(p_brand, '#', '_')) || '_' AS prefix,
           CASE WHEN s = 1 THEN lower(p_type) END AS namespace,
           CASE WHEN s = 1 THEN 'retailPrice,PartKey' ELSE '' END AS primary_key
    FROM leaves""")
def catalog_streams(spark, sf_dir):
    return dictionary.streams(inputs.connections(spark, sf_dir)).select(
        "connectionId", "stream", "prefix", "namespace",
        F.concat_ws(",", "primary_key").alias("primary_key"),
    )


@query("raw_dictionary", inputs.CATALOG_SQL + f"""
    SELECT "connectionId", stream, CAST(ord AS INTEGER) AS ord,
           {inputs.sql_standard_name("identifier")} AS name, identifier,
           kind AS data_type, description, s = 1 AND ord < 2 AS is_key,
           CAST(CASE WHEN s = 1 AND ord < 2 THEN 2 - ord ELSE 0 END AS INTEGER) AS key_position
    FROM leaves""")
def raw_dictionary(spark, sf_dir):
    return dictionary.stream_columns(dictionary.streams(inputs.connections(spark, sf_dir)))


@query("typed_dictionary", inputs.CATALOG_SQL + f"""
    SELECT "connectionId", stream, CAST(ord AS INTEGER) AS ord,
           {inputs.sql_standard_name("identifier")} AS name, identifier,
           CASE WHEN kind = 'string' AND lower(identifier) LIKE '%date%' THEN 'timestamp' ELSE kind END
             AS data_type, description, s = 1 AND ord < 2 AS is_key,
           CAST(CASE WHEN s = 1 AND ord < 2 THEN 2 - ord ELSE 0 END AS INTEGER) AS key_position
    FROM leaves""")
def typed_dictionary(spark, sf_dir):
    return dictionary.stream_columns(
        dictionary.streams(inputs.connections(spark, sf_dir)), date_names=True
    )


@query("dictionary_with_metadata", inputs.CATALOG_SQL + f"""
    , own AS (
      SELECT DISTINCT "connectionId", stream, v.name, v.identifier, v.data_type
      FROM leaves, (VALUES ('execution_date', 'execution_date', 'date'),
        ('ab_id', '_airbyte_ab_id', 'string'), ('ab_emitted_at', '_airbyte_emitted_at', 'timestamp'),
        ('unique_id', 'unique_id', 'string')) v(name, identifier, data_type))
    SELECT "connectionId", stream, {inputs.sql_standard_name("identifier")} AS name, identifier,
           kind AS data_type FROM leaves
    UNION ALL SELECT * FROM own""")
def dictionary_with_metadata(spark, sf_dir):
    streams = dictionary.streams(inputs.connections(spark, sf_dir))
    full = dictionary.with_metadata_columns(dictionary.stream_columns(streams), streams)
    return full.select("connectionId", "stream", "name", "identifier", "data_type")


@query("raw_source_tables", inputs.CATALOG_SQL + f"""
    SELECT DISTINCT "connectionId", stream,
           CASE p_size % 3 WHEN 1 THEN 'landing' ELSE 'set_' || s_suppkey END AS source,
           'project-' || s_nationkey AS database,
           'raw_' || {inputs.sql_standard_name("stream")} AS name,
           '_airbyte_raw_' || lower(replace(p_brand, '#', '_')) || '_' || stream AS identifier,
           24 AS warn_after_hours, 36 AS error_after_hours, '_airbyte_emitted_at' AS loaded_at_field
    FROM leaves JOIN supplier ON s_suppkey = p_size""")
def raw_source_tables(spark, sf_dir):
    return dictionary.raw_sources(
        dictionary.streams(inputs.connections(spark, sf_dir)), inputs.destinations(spark, sf_dir)
    ).drop("columns")


@query("typed_source_tables", inputs.CATALOG_SQL + """
    SELECT DISTINCT "connectionId", stream, CASE WHEN s = 1 THEN lower(p_type) ELSE 'unknown' END AS namespace,
           CASE p_size % 3 WHEN 0 THEN 'ns_' || CASE WHEN s = 1 THEN lower(p_type) ELSE 'unknown' END
                           WHEN 1 THEN 'landing' ELSE 'set_' || s_suppkey END AS source,
           'project-' || s_nationkey AS database,
           lower(replace(p_brand, '#', '_')) || '_' || stream AS name,
           lower(replace(p_brand, '#', '_')) || '_' || stream AS identifier,
           'stg_' || lower(replace(p_brand, '#', '_')) || '_' || stream AS model,
           24 AS warn_after_hours, 36 AS error_after_hours, '_airbyte_extracted_at' AS loaded_at_field
    FROM leaves JOIN supplier ON s_suppkey = p_size""")
def typed_source_tables(spark, sf_dir):
    return dictionary.typed_sources(
        dictionary.streams(inputs.connections(spark, sf_dir)), inputs.destinations(spark, sf_dir)
    )
