"""Landing tables: raw ones hold a JSON document per row, typed ones hold columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the two landing formats.
RAW_ID = "_airbyte_ab_id"
RAW_TIME = "_airbyte_emitted_at"
RAW_DATA = "_airbyte_data"
TYPED_TIME = "_airbyte_extracted_at"

RAW_SCHEMA = T.StructType(
    [
        T.StructField(RAW_ID, T.StringType()),
        T.StructField(RAW_TIME, T.TimestampType()),
        T.StructField(RAW_DATA, T.StringType()),
    ]
)


def raw_landing(spark: SparkSession, path: str) -> DataFrame:
    """A raw landing table; the fixed schema saves reading any file footer to plan."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def typed_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def as_raw_landing(df: DataFrame, row_id: Column, emitted_at: Column, data: Column) -> DataFrame:
    """Any table in the shape of a raw landing table."""
    return df.select(
        row_id.cast("string").alias(RAW_ID), emitted_at.alias(RAW_TIME), data.alias(RAW_DATA)
    )


def landed_between(df: DataFrame, column: str, first_day=None, last_day=None) -> DataFrame:
    """Rows landed on the given days, both included.

    The bounds are ranges on the stored column, in its own type, so that file statistics
    can skip data.
    """
    dtype = df.schema[column].dataType
    if first_day is not None:
        df = df.where(F.col(column) >= _day(first_day).cast(dtype))
    if last_day is not None:
        df = df.where(F.col(column) < F.date_add(_day(last_day), 1).cast(dtype))
    return df


def _day(value) -> Column:
    return F.lit(str(value)).cast("date")
