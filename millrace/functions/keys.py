"""Row keys: one key column as it is, several as a digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What stands for NULL inside a digest, and what separates its parts.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def key_text(column: Column, dtype: T.DataType) -> Column:
    """A key part as the warehouse prints it.

    Decimals carry no trailing zeros and instants their UTC offset; Spark's own text differs
    from the warehouse's only there.
    """
    text = column.cast("string")
    if isinstance(dtype, T.DecimalType) and dtype.scale > 0:
        return F.regexp_replace(text, r"\.?0+$", "")
    if isinstance(dtype, T.TimestampType):
        return F.concat(text, F.lit("+00"))
    return text


def surrogate_key(df: DataFrame, columns: Sequence[str]) -> Column:
    parts = [
        F.coalesce(key_text(df[f"`{c}`"], df.schema[c].dataType), F.lit(NULL_MARKER))
        for c in columns
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def unique_id(df: DataFrame, columns: Sequence[str]) -> Column:
    """Key of a row: a single key column keeps its type and value, several are digested."""
    if len(columns) == 1:
        return df[f"`{columns[0]}`"]
    return surrogate_key(df, columns)
