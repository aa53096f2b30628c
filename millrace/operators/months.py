"""Tables partitioned by month, whose months change all at once.

Below the table's folder lie

    _version=<id>/_month=2024-01/...    files, written once and never changed
    _live-00000007                      the pointer

The pointer names the table's columns and for each month the version folder that holds it. A run
writes its months into a version folder of its own and then puts the next pointer in place by one
rename to a name that was not there. So no month is written twice, a reader has the months of one
pointer or of the other, and what a run that died has written is in no pointer.

One generation stays behind each change, for those who read it. What neither of the two last
pointers names is removed by the next change. A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import folder_names, put_text, read_text, remove_folder

MONTH, VERSION, POINTER = "_month", "_version", "_live-"
# Fixed value: Spark's folder for rows without a partition value.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
# Types of keys for which files carry Bloom filters.
HASHED_TYPES = (T.StringType, T.IntegerType, T.LongType, T.DateType, T.BinaryType)


@dataclass(frozen=True)
class Live:
    """A pointer: its number, the columns as JSON, and the version of each month."""

    number: int = 0
    columns: str = ""
    months: dict[str | None, str] = dataclass_field(default_factory=dict)


def month_of(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


def in_order(months: Iterable) -> list:
    """Months in order, the one of rows without a date first."""
    return sorted(months, key=lambda m: (m is not None, m or ""))


def _pointers(spark: SparkSession, path: str) -> list[str]:
    names = folder_names(spark, path)
    found = sorted(n for n in names if n.startswith(POINTER))
    if not found and any(n.startswith(f"{MONTH}=") for n in names):
        raise ValueError(f"{path} holds months, but no pointer: it was not written by write_months")
    return found


def _read(spark: SparkSession, path: str, pointer: str) -> Live:
    held = json.loads(read_text(spark, f"{path}/{pointer}"))
    return Live(int(pointer.removeprefix(POINTER)), held["columns"], {m: v for m, v in held["months"]})


def live(spark: SparkSession, path: str) -> Live | None:
    """The pointer of a table; None if there is no table."""
    found = _pointers(spark, path)
    return _read(spark, path, found[-1]) if found else None


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_pointers(spark, path))


def months_of(spark: SparkSession, path: str) -> list[str | None]:
    """Months of a stored table, in order."""
    now = live(spark, path)
    return in_order(now.months) if now else []


def write_version(
    df: DataFrame, path: str, field: str | Column, key: str | None = None, gather: bool = True
) -> dict[str | None, str]:
    """Write rows as months of a version folder of their own; returns the version of each month.

    ``field`` is the date column whose months they are, or an expression that names each row's part.

    ``gather`` brings the rows of a month together first, so that tasks which hold all months
    do not write a file for each; a month that holds a large part of the rows is still split.
    Rows that lie in one month, or come month by month, need no such shuffle. With a ``key``
    the rows of a file are sorted by it and the file carries a Bloom filter of its values, so that
    a scan for some keys skips row groups which cannot hold them.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    dated = df.withColumn(MONTH, month_of(field) if isinstance(field, str) else field)
    if gather:
        dated = dated.hint("rebalance", MONTH)
    if key is not None:
        dated = dated.sortWithinPartitions(MONTH, key)
    writer = dated.write.mode("errorifexists").partitionBy(MONTH)
    if key is not None and isinstance(df.schema[key].dataType, HASHED_TYPES):
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    folder = f"{path}/{VERSION}={version}"
    writer.parquet(folder)
    written = [n.removeprefix(f"{MONTH}=") for n in folder_names(spark, folder) if n.startswith(f"{MONTH}=")]
    return {None if n == NO_MONTH else n: version for n in written}


def publish(
    spark: SparkSession, path: str, before: Live | None, months: dict[str | None, str], schema: T.StructType
) -> None:
    """Make ``months`` the table, in one step, and remove what is two changes old."""
    before = before or Live()
    held = json.dumps({"columns": schema.json(), "months": [[m, months[m]] for m in in_order(months)]})
    put_text(spark, f"{path}/{POINTER}{before.number + 1:08}", held)
    for pointer in _pointers(spark, path)[:-2]:
        _remove(spark, path, _read(spark, path, pointer).months.items(), set(before.months.items()) | set(months.items()))
        remove_folder(spark, f"{path}/{pointer}")


def _remove(spark: SparkSession, path: str, gone: Iterable[tuple], kept: set[tuple]) -> None:
    versions = {v for _, v in kept}
    for month, version in gone:
        folder = f"{path}/{VERSION}={version}"
        if version not in versions:
            remove_folder(spark, folder)
        elif (month, version) not in kept:
            remove_folder(spark, f"{folder}/{MONTH}={month or NO_MONTH}")


def remove_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Remove version folders that no pointer names, left by runs that died; none may be running."""
    named = {v for p in _pointers(spark, path) for v in _read(spark, path, p).months.values()}
    gone = [n for n in folder_names(spark, path) if n.startswith(f"{VERSION}=") and n.removeprefix(f"{VERSION}=") not in named]
    for name in gone:
        remove_folder(spark, f"{path}/{name}")
    return gone


def write_months(df: DataFrame, path: str, field: str, gather: bool = True, key: str | None = None) -> None:
    """A new table partitioned by month; the arguments are those of ``write_version``."""
    spark = df.sparkSession
    if table_exists(spark, path):
        raise ValueError(f"{path} is a table already")
    publish(spark, path, None, write_version(df, path, field, key, gather), df.schema)


def read_months(spark: SparkSession, path: str, only: str | None = None) -> DataFrame:
    """The table as it is now, or the ``only`` month of it, with its month as a column.

    The columns come from the pointer, so no file is opened to plan; months are partitions.
    """
    now = live(spark, path)
    if now is None:
        raise ValueError(f"{path} is no table")
    schema = T.StructType.fromJson(json.loads(now.columns)).add(MONTH, T.StringType())
    wanted = [m for m in in_order(now.months) if only is None or m == only]
    folders = [f"{path}/{VERSION}={now.months[m]}/{MONTH}={m or NO_MONTH}" for m in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop(VERSION)
