"""Registry tables: where they are and how they are read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from millrace.operators.registry import ACCESS_SCHEMA, GROUP_SCHEMA, METADATA_SCHEMA

# The registry's tables.
TABLES = {
    "data_catalog_metadata": METADATA_SCHEMA,
    "data_quality_metadata": METADATA_SCHEMA,
    "user_groups": GROUP_SCHEMA,
    "resource_access": ACCESS_SCHEMA,
}


def read_registry(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A registry table; one that was never written is empty."""
    schema = TABLES[table]
    try:
        return spark.read.schema(schema).parquet(f"{folder}/{table}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
