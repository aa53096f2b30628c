"""Values out of JSON text: one parse per row, scalars, array text, timestamps, paths."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAIN_STEP = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def json_path(identifier: str) -> str:
    """JSON path of a dotted identifier; a step that is not a plain word is quoted."""
    path = "$"
    for step in identifier.split("."):
        if PLAIN_STEP.match(step):
            path += "." + step
        else:
            path += "['" + step.replace("'", "\\'") + "']"
    return path


def _is_container_text(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _is_string(value: Column) -> Column:
    return F.to_json(value).startswith('"')


class ParsedJson:
    """The leaves a dictionary asks for, read from a JSON text column in a single parse.

    The parse target is a struct with one VARIANT per leaf, which keeps numbers of up to 38
    digits exact where text would go through a double. Leaves a struct cannot hold, such as
    ``b`` next to ``b.c`` or names that differ in case only, are read by path instead.
    """

    def __init__(self, data: str, leaves: Mapping[str, bool]):
        """``leaves`` maps identifier -> whether it is read as an array."""
        self.data = data
        self.struct_leaves, self.path_leaves = split_leaves(leaves)
        self.schema = struct_schema(self.struct_leaves)

    def column(self, on_error: str = "fail") -> Column:
        """The parsed leaves; with ``fail`` a text that is no JSON object is an error."""
        schema = self.schema if self.schema.fields else T.StructType([T.StructField("_none", T.VariantType())])
        mode = "FAILFAST" if on_error == "fail" else "PERMISSIVE"
        return F.from_json(F.col(self.data), schema, {"mode": mode})

    def _leaf(self, parsed: str, identifier: str) -> Column:
        value = F.col(parsed)
        for step in identifier.split("."):
            value = value.getField(step)
        return value

    def _variant(self, identifier: str) -> Column:
        return F.try_variant_get(
            F.try_parse_json(F.col(self.data)), json_path(identifier), "variant"
        )

    def text(self, parsed: str, identifier: str) -> Column:
        """Text of whatever the leaf holds; NULL for a missing path and a JSON null."""
        return F.try_variant_get(self._value(parsed, identifier), "$", "string")

    def scalar(self, parsed: str, identifier: str, text: Column) -> Column:
        """Text of a scalar; NULL for a missing path, a JSON null, an object or an array.

        ``text`` is a column that holds the leaf's text, so that it is made once. Only one that
        opens like a container needs a second look, to tell a container from a string that
        holds JSON.
        """
        value = self._value(parsed, identifier)
        return F.when(_is_container_text(text), F.when(_is_string(value), text)).otherwise(text)

    def _value(self, parsed: str, identifier: str) -> Column:
        if identifier in self.struct_leaves:
            return self._leaf(parsed, identifier)
        return self._variant(identifier)

    def array_parts(self, parsed: str, identifier: str) -> Column:
        """Elements of an array as JSON text; NULL if the value is not an array."""
        return F.transform(
            F.try_variant_get(self._value(parsed, identifier), "$", "array<variant>"),
            lambda e: F.to_json(e),
        )

    def array_text(self, parts: Column, identifier: str) -> Column:
        """Elements one after the other, nested ones with their keys as the document has them.

        A VARIANT object sorts its keys, so arrays that hold containers are read again; numbers
        inside these are written as a double prints them. Others keep up to 38 digits and lose
        zeros at the end.
        """
        as_written = F.from_json(
            F.get_json_object(F.col(self.data), json_path(identifier)), "array<string>"
        )
        in_order = F.zip_with(
            parts, as_written,
            lambda part, raw: F.when(_is_container_text(part), raw).otherwise(part),
        )
        return F.when(F.exists(parts, _is_container_text), F.concat_ws("", in_order)).when(
            parts.isNotNull(), F.concat_ws("", parts)
        )


def split_leaves(identifiers: Iterable[str]) -> tuple[list[str], list[str]]:
    """Identifiers that fit one struct together, and the rest."""
    fits: list[str] = []
    rest: list[str] = []
    leaves: set[tuple[str, ...]] = set()
    inner: set[tuple[str, ...]] = set()
    spelling: dict[tuple[str, ...], str] = {}
    for identifier in identifiers:
        steps = tuple(identifier.split("."))
        folded = tuple(s.lower() for s in steps)
        prefixes = [folded[:i] for i in range(1, len(folded) + 1)]
        same_spelling = all(
            spelling.get(p, steps[i]) == steps[i] for i, p in enumerate(prefixes)
        )
        clash = (
            folded in inner or folded in leaves or any(p in leaves for p in prefixes[:-1])
        )
        if clash or not same_spelling or "" in steps:
            rest.append(identifier)
            continue
        fits.append(identifier)
        leaves.add(folded)
        inner.update(prefixes[:-1])
        spelling.update(zip(prefixes, steps))
    return fits, rest


def struct_schema(leaves: Iterable[str]) -> T.StructType:
    tree: dict = {}
    for identifier in leaves:
        *parents, leaf = identifier.split(".")
        node = tree
        for step in parents:
            node = node.setdefault(step, {})
        node[leaf] = T.VariantType()

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, build(child) if isinstance(child, dict) else child)
                for name, child in node.items()
            ]
        )

    return build(tree)


def cast_value(value: Column, spark_type: str, on_error: str) -> Column:
    return value.cast(spark_type) if on_error == "fail" else value.try_cast(spark_type)


def _parse_timestamp(text: Column, date_format: str, on_error: str) -> Column:
    if on_error == "fail":
        return F.to_timestamp(text, date_format)
    return F.try_to_timestamp(text, F.lit(date_format))


def timestamp_value(text: Column, on_error: str = "fail") -> Column:
    """An instant from text: compact date, dashed date, blank, or a full timestamp."""
    size = F.length(text)
    return (
        F.when(size == 8, _parse_timestamp(text, "yyyyMMdd", on_error))
        .when(size == 10, _parse_timestamp(text, "yyyy-MM-dd", on_error))
        .when(size < 2, F.lit(None).cast("timestamp"))
        .otherwise(cast_value(text, "timestamp", on_error))
    )


def scalar_value(text: Column, data_type: str, spark_type: str, on_error: str = "fail") -> Column:
    if data_type == "timestamp":
        return timestamp_value(text, on_error)
    if spark_type == "string":
        return text
    return cast_value(text, spark_type, on_error)


# Date directives of the warehouse and Spark's letters for them.
DATE_DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss",
    "%j": "DDD", "%b": "MMM", "%B": "MMMM", "%F": "yyyy-MM-dd", "%T": "HH:mm:ss",
}


def date_pattern(date_format: str) -> str:
    """Spark's pattern for a format in either notation."""
    if "%" not in date_format:
        return date_format
    pattern = re.sub(
        "%.", lambda m: DATE_DIRECTIVES.get(m.group(), m.group()),
        re.sub("(?<!%)[A-Za-z]+", lambda m: f"'{m.group()}'", date_format),
    )
    if "%" in pattern:
        raise ValueError(f"unknown directive in date format {date_format!r}")
    return pattern


def partition_date(data: Column, identifier: str, date_format: str | None = None) -> Column:
    """Partition date read from a field of the payload, by a format or as a timestamp."""
    text = F.get_json_object(data, json_path(identifier))
    if date_format:
        return F.to_date(text, date_pattern(date_format))
    return text.cast("timestamp")


def nested_value(schema: T.StructType, identifier: str, split: str = "each") -> Column:
    """A nested value of a typed row, whatever holds it.

    The first step names a column. Below it a struct is followed by field, a VARIANT by path
    and JSON text by key. ``split='first'`` reads the rest of a dotted name below JSON text
    as one key, which is how key look-up on serialised columns works.
    """
    if identifier in schema.fieldNames():
        return F.col(f"`{identifier}`")
    first, *steps = identifier.split(".")
    value, dtype = F.col(f"`{first}`"), schema[first].dataType
    while steps and isinstance(dtype, T.StructType):
        dtype = dtype[steps[0]].dataType
        value = value.getField(steps.pop(0))
    if not steps:
        return value
    rest = ".".join(steps)
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(value, json_path(rest), "variant")
    if isinstance(dtype, T.StringType):
        if split == "first":
            return F.get_json_object(value, "$['" + rest.replace("'", "\\'") + "']")
        return F.get_json_object(value, json_path(rest))
    raise ValueError(f"{identifier}: {dtype.simpleString()} has no fields")
