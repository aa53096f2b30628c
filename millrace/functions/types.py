"""Connector types, dictionary types and the Spark types behind them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Connector type -> dictionary type. Anything else is a string.
DICTIONARY_TYPES = {
    "number": "numeric",
    "timestamp_without_timezone": "timestamp",
    "timestamp_with_timezone": "timestamp",
    "object": "string",
    "boolean": "bool",
    "array": "array",
    "integer": "integer",
}

# Dictionary type -> Spark type of the staged column.
SPARK_TYPES = {
    "numeric": "decimal(38,9)",
    "integer": "bigint",
    "bool": "boolean",
    "timestamp": "timestamp",
    "date": "date",
    "string": "string",
}


@dataclass(frozen=True)
class ColumnSpec:
    """One line of a column dictionary.

    ``key_position`` orders the columns of a key, which need not be the order of the table.
    """

    name: str
    identifier: str
    data_type: str
    description: str = ""
    is_key: bool = False
    key_position: int = 0


def dictionary_type(source_type: Column, identifier: Column, date_names: bool = False) -> Column:
    """Dictionary type of a connector type.

    ``date_names`` is the typed-landing rule that a string whose name speaks of a date is a
    timestamp; it holds for the plain ``string`` type only.
    """
    pairs = [F.lit(part) for pair in DICTIONARY_TYPES.items() for part in pair]
    known = F.coalesce(F.create_map(*pairs)[source_type], F.lit("string"))
    if not date_names:
        return known
    dated = (source_type == "string") & F.lower(identifier).contains("date")
    return F.when(dated, F.lit("timestamp")).otherwise(known)


def single_type(types: Column) -> Column:
    """The one non-null member of a type list, or ``string`` if there are none or several."""
    named = F.filter(types, lambda t: t != "null")
    return F.when(F.size(named) == 1, F.get(named, F.lit(0))).otherwise(F.lit("string"))


def landing_format(image_tag: Column) -> Column:
    """Landing format of a destination: 2 after release 1.10.2, else 1, NULL if unreadable.

    Orders version tags the public way: epoch, release numbers, then pre- and development
    releases before and post-releases and local builds after the plain release.
    """
    tag = F.lower(F.trim(image_tag))
    part = lambda group: F.regexp_extract(tag, VERSION_PATTERN, group)
    release = F.transform(F.split(part(2), r"\."), lambda n: n.cast("decimal(38,0)"))
    padded = F.concat(release, F.array_repeat(F.lit(0).cast("decimal(38,0)"), 3))
    last_v1 = F.array(*[F.lit(n).cast("decimal(38,0)") for n in LAST_V1_RELEASE])
    head, rest = F.slice(padded, 1, 3), F.slice(padded, F.lit(4), F.size(padded))
    longer = F.exists(rest, lambda n: n > 0)
    # Equal release numbers: later only as a post-release or a local build of the final one.
    after_final = (part(3) == "") & ((part(4) != "") | ((part(5) == "") & (part(6) != "")))
    newer = (
        (F.coalesce(F.nullif(part(1), F.lit("")).cast("decimal(38,0)"), F.lit(0)) > 0)
        | (head > last_v1)
        | ((head == last_v1) & (longer | after_final))
    )
    return F.when(
        tag.rlike(VERSION_PATTERN), F.when(newer, F.lit(2)).otherwise(F.lit(1))
    )


# The last release that writes raw JSON tables, and the public version syntax
# as epoch, release, pre-release, post-release, development release and local build.
LAST_V1_RELEASE = (1, 10, 2)
VERSION_PATTERN = (
    r"^v?(?:([0-9]+)!)?([0-9]+(?:\.[0-9]+)*)"
    r"([-_.]?(?:alpha|beta|preview|pre|a|b|c|rc)[-_.]?[0-9]*)?"
    r"(-[0-9]+|[-_.]?(?:post|rev|r)[-_.]?[0-9]*)?"
    r"([-_.]?dev[-_.]?[0-9]*)?"
    r"(\+[a-z0-9]+(?:[-_.][a-z0-9]+)*)?$"
)
