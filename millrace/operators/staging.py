"""Staging: the newest copy of every landed record, typed, renamed and keyed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.json_values import ParsedJson, nested_value, scalar_value
from millrace.functions.keys import unique_id
from millrace.functions.names import standard_name
from millrace.functions.types import SPARK_TYPES, ColumnSpec
from millrace.sources.landing import RAW_DATA, RAW_ID, RAW_TIME, landed_between

# Names with a meaning of their own in a raw staging table.
UNIQUE_ID = "unique_id"
METADATA = ("execution_date", "ab_id", "ab_emitted_at")
CDC_MARK = "ab_cdc_cursor"
CDC_ORDER = "ab_cdc_updated_at"
LOOKBACK_DAYS = 1


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the greatest in ``order``; NULLs order last and NULL keys are one key.

    As an aggregate rather than a ranked window: each task reduces its own rows before the
    shuffle, so a key that holds a large part of the data costs one row per task. The aggregate
    sorts, led by eight bytes of hash: keys that begin alike are compared to their end only
    where they are equal, or share a hash.
    """
    rest = [c for c in df.columns if c not in key]
    keys = [F.col(f"`{c}`") for c in key]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order))
    return (
        df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys)
        .agg(newest.alias("_newest"))
        .select(*[
            F.col(f"`{c}`") if c in key else F.col("_newest").getField(c).alias(c)
            for c in df.columns
        ])
    )


def latest_payloads(raw: DataFrame) -> DataFrame:
    """The newest landing of each distinct payload; equal times fall back to the row id."""
    return latest_by(raw, [RAW_DATA], [F.col(RAW_TIME), F.col(RAW_ID)])


def landing_window(
    raw: DataFrame, execution_date, incremental: bool, date_from=None
) -> DataFrame:
    """Rows a run reads: all up to its date, or from the look-back day on with no upper bound."""
    if incremental:
        first = F.date_sub(F.lit(str(execution_date)).cast("date"), LOOKBACK_DAYS)
        dtype = raw.schema[RAW_TIME].dataType
        return raw.where(F.col(RAW_TIME) >= first.cast(dtype))
    return landed_between(raw, RAW_TIME, date_from, execution_date)


def source_columns(dictionary: Sequence[ColumnSpec]) -> list[ColumnSpec]:
    """Columns read from the payload. Of two lines under one name the later one counts, in
    the place of the first."""
    own = {UNIQUE_ID, *METADATA}
    return list({c.name: c for c in dictionary if c.name not in own}.values())


def key_columns(dictionary: Sequence[ColumnSpec]) -> list[str]:
    """Names of the key: the declared one in its own order, or else the whole row."""
    columns = source_columns(dictionary)
    declared = sorted((c for c in columns if c.is_key), key=lambda c: c.key_position)
    return [c.name for c in declared or columns]


def _typed(
    raw: DataFrame, columns: Sequence[ColumnSpec], on_error: str
) -> tuple[DataFrame, list[Column]]:
    """Parsed rows, and the typed values of ``columns`` to select from them.

    A leaf's text, and the text of a time, are columns of steps of their own: what follows looks
    at them several times, and the optimizer does not merge such steps.
    """
    parsed = ParsedJson(RAW_DATA, {c.identifier: c.data_type == "array" for c in columns})
    parts = {
        c.identifier: f"_parts{i}" for i, c in enumerate(columns) if c.data_type == "array"
    }

    def value(spec: ColumnSpec) -> Column:
        if spec.data_type == "array":
            return parsed.array_text(F.col(parts[spec.identifier]), spec.identifier)
        spark_type = SPARK_TYPES.get(spec.data_type, "string")
        return scalar_value(F.col(scalars[spec.identifier]), spec.data_type, spark_type, on_error)

    scalars = {
        c.identifier: f"_scalar{i}" for i, c in enumerate(columns) if c.data_type != "array"
    }
    texts = {name: f"_text{name}" for name in scalars.values()}
    rows = raw.withColumn("_parsed", parsed.column(on_error))
    rows = rows.withColumns(
        {name: parsed.array_parts("_parsed", i) for i, name in parts.items()}
        | {texts[name]: parsed.text("_parsed", i) for i, name in scalars.items()}
    )
    rows = rows.withColumns(
        {name: parsed.scalar("_parsed", i, F.col(texts[name])) for i, name in scalars.items()}
    )
    return rows, [value(c).alias(c.name) for c in columns]


def typed_columns(
    raw: DataFrame, dictionary: Sequence[ColumnSpec], execution_date, on_error: str = "fail",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One typed column per dictionary line, from a single parse of each payload.

    Columns of ``raw`` named in ``keep`` come behind them.
    """
    rows, values = _typed(raw, source_columns(dictionary), on_error)
    return rows.select(
        *values,
        F.lit(str(execution_date)).cast("date").alias("execution_date"),
        F.col(RAW_ID).alias("ab_id"),
        F.col(RAW_TIME).cast("timestamp").alias("ab_emitted_at"),
        *keep,
    )


def newest_changes(
    raw: DataFrame, dictionary: Sequence[ColumnSpec], key: Sequence[str], on_error: str = "fail"
) -> DataFrame:
    """The newest landing of each row key, still raw, with its key as ``unique_id``.

    Only the key and the time of the change are typed to tell; equal times fall back to load
    time, row id and then the payload.
    """
    needed = [c for c in source_columns(dictionary) if c.name in key or c.name == CDC_ORDER]
    rows, values = _typed(raw, needed, on_error)
    landed = F.struct(RAW_ID, RAW_TIME, RAW_DATA).alias("_landed")
    keyed = rows.select(*values, landed)
    keyed = keyed.select(unique_id(keyed, key).alias(UNIQUE_ID), CDC_ORDER, "_landed")
    # the row is its own order, so that each value crosses the shuffle once
    at = F.col(f"_landed.{RAW_TIME}").cast("timestamp").alias("_at")
    newest = F.max(F.struct(CDC_ORDER, at, "_landed")).alias("_newest")
    return (
        keyed.groupBy(F.xxhash64(UNIQUE_ID).alias("_hash"), UNIQUE_ID).agg(newest)
        .select("_newest._landed.*", UNIQUE_ID)
    )


def stage(
    raw: DataFrame,
    dictionary: Sequence[ColumnSpec],
    execution_date,
    *,
    incremental: bool = False,
    date_from=None,
    key: Sequence[str] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """A raw landing table as a staging table.

    ``key`` overrides the dictionary's key; an empty one leaves the key column out.
    With change data, the newest change per key also is the newest copy of its payload, so
    one shuffle by key does the work of both steps. Rows are typed in full once the newest are
    known: of changes that a later one replaced, only key and time must be sound.
    """
    landed = landing_window(raw, execution_date, incremental, date_from)
    key = key_columns(dictionary) if key is None else list(key)
    if key and any(c.name == CDC_MARK for c in dictionary):
        newest = newest_changes(landed, dictionary, key, on_error)
        return typed_columns(newest, dictionary, execution_date, on_error, keep=[UNIQUE_ID])
    staged = typed_columns(latest_payloads(landed), dictionary, execution_date, on_error)
    return staged.withColumn(UNIQUE_ID, unique_id(staged, key)) if key else staged


def typed_view(
    landing: DataFrame, identifiers: Sequence[str], split: str = "each"
) -> DataFrame:
    """A typed landing table under standard names, nested values as columns of their own."""
    return landing.select(
        *[nested_value(landing.schema, i, split).alias(standard_name(i)) for i in identifiers]
    )
