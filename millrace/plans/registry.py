"""Change a stored registry table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import stored
from millrace.sources.registry import read_registry


def change_registry(
    spark: SparkSession, folder: str, table: str, change: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Replace a registry table by what ``change`` makes of it.

    The new content is complete in the shared folder before the table is overwritten, so no
    file is read and replaced at once.
    """
    changed = stored(change(read_registry(spark, folder, table)), table)
    changed.write.mode("overwrite").parquet(f"{folder}/{table}")
    return read_registry(spark, folder, table)
