"""Seed files: small CSV tables with a header and given types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", escape='"')


def write_seed(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, mode="errorifexists", escape='"')
