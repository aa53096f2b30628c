"""Names: column and table identifiers, dataset and schema names, slugs and links."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rewrite rules behind every staged name, applied in this order before
# the result is lower-cased.
NAME_RULES = (
    (r"(.)([A-Z][a-z]+)", r"\1_\2"),
    (r"\s", r"_"),
    (r"_+", r"_"),
    (r"\b_+", r""),
    (r"\.", r"_"),
    (r"([a-z0-9])([A-Z])", r"\1_\2"),
)

RAW_TABLE_PREFIX = "_airbyte_raw_"
NAMESPACE_PLACEHOLDER = "${SOURCE_NAMESPACE}"


def standard_name(value: str) -> str:
    """The staged name of one identifier, for aliases built on the driver."""
    for pattern, replacement in NAME_RULES:
        value = re.sub(pattern, replacement, value)
    return value.lower()


def standard_name_col(value: Column) -> Column:
    """The same name for a column of identifiers.

    ``(?Ud)`` gives Java's character classes, word boundaries and ``.`` the Unicode
    meaning they have on the driver side.
    """
    for pattern, replacement in NAME_RULES:
        value = F.regexp_replace(value, "(?Ud)" + pattern, replacement.replace("\\", "$"))
    return F.lower(value)


def quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def quote_ident(name: Column, reserved: Iterable[str] = ()) -> Column:
    """Double-quote a name only where a plain one would not resolve to it."""
    plain = name.rlike("^[a-z_][a-z0-9_$]*$")
    reserved = list(reserved)
    if reserved:
        plain = plain & ~name.isin(reserved)
    return F.when(plain, name).otherwise(
        F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    )


def raw_dataset(namespace_format: Column, default: Column) -> Column:
    """Dataset of a raw landing table: the connection's format unless it holds a variable."""
    return F.when(
        namespace_format.isNotNull() & ~namespace_format.contains("$"), namespace_format
    ).otherwise(default)


def typed_dataset(namespace_format: Column, namespace: Column, default: Column) -> Column:
    """Dataset of a typed landing table: the format with the stream's namespace filled in.

    A connection without a format lands in its destination's dataset.
    """
    has_namespace = F.coalesce(namespace, F.lit("")) != ""
    filled = F.when(
        has_namespace,
        F.replace(namespace_format, F.lit(NAMESPACE_PLACEHOLDER), namespace),
    ).otherwise(namespace_format)
    return F.coalesce(filled, default)


def target_schema(branch: Column, prefix: str) -> Column:
    """Schema of a branch's target, ``prefix`` being ``dev_`` or ``e2e_test_``."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.lower(branch), "[^a-zA-Z0-9]", "_"))


def slug(project: Column) -> Column:
    return F.lower(F.translate(project, "_", "-"))


def quality_url(project: Column, customer: str, domain: str) -> Column:
    host = f"{customer}.{domain}"
    return F.concat(
        F.lit(f"https://{host}/data-quality/live/data-quality.{host}/"),
        slug(project),
        F.lit("/%23/alerts"),
    )


def docs_url(project: Column, customer: str, domain: str) -> Column:
    host = f"{customer}.{domain}"
    return F.concat(
        F.lit(f"https://{host}/data-catalog/live/data-catalog.{host}/"),
        slug(project),
        F.lit("/%23!/overview"),
    )


def repository_base(remote: Column) -> Column:
    """Web address of a repository: no scheme, credentials or ``.git`` suffix."""
    ssh = F.regexp_replace(remote, "^git@([^:]+):", "$1/")
    bare = F.regexp_replace(ssh, "^[a-z+]+://", "")
    return F.regexp_replace(F.regexp_replace(bare, "^.*@", ""), r"\.git/?$", "")


def project_url(remote: Column, branch: Column, project: Column) -> Column:
    return F.concat(
        F.lit("https://"), repository_base(remote),
        F.lit("/tree/"), branch, F.lit("/"), project, F.lit("?ref_type=heads"),
    )
