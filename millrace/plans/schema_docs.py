"""Schema documents of a catalog: sources, models and their columns, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import standard_name_col
from millrace.operators import dictionary as d


def raw_documents(connections: DataFrame, destinations: DataFrame) -> dict[str, DataFrame]:
    """Documents of raw landing data; every model ends with the metadata columns."""
    streams = d.streams(connections)
    columns = d.with_metadata_columns(d.stream_columns(streams), streams)
    model = F.concat(F.lit("stg_"), standard_name_col(F.col("stream")))
    return {
        "sources": d.raw_sources(streams, destinations),
        "models": streams.select("connectionId", "stream", model.alias("model")),
        "model_columns": columns.withColumn("model", model),
    }


def typed_documents(
    connections: DataFrame, destinations: DataFrame, platform: str = "bigquery"
) -> dict[str, DataFrame]:
    """Documents of typed landing data; source columns keep their identifier as name."""
    streams = d.streams(connections)
    columns = d.stream_columns(
        streams, date_names=True, keep=("connectionId", "prefix", "stream")
    )
    model = F.concat(F.lit("stg_"), "prefix", "stream")
    sources = d.typed_sources(streams, destinations, platform)
    return {
        "sources": sources,
        "source_columns": columns.select(
            "connectionId", "stream", "ord", F.col("identifier").alias("name"),
            "data_type", "description",
        ),
        "models": sources.select("connectionId", "stream", "model"),
        "model_columns": columns.withColumn("model", model).drop("prefix"),
    }


def write_documents(documents: dict[str, DataFrame], folder: str, file_format: str = "parquet") -> None:
    for name, df in documents.items():
        df.write.mode("errorifexists").format(file_format).save(f"{folder}/{name}")
