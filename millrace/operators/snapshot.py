"""Type-2 history of a table: a row per version of each key, open or closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.months import MONTH, Live, live, publish, read_months, write_version

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
# Parts of a stored history: open versions, and those that one run closed.
OPEN, CLOSED = "open", "closed-"


def first_snapshot(source: DataFrame, valid_from: Column) -> DataFrame:
    return source.withColumn(VALID_FROM, valid_from.cast("timestamp")).withColumn(
        VALID_TO, F.lit(None).cast("timestamp")
    )


def snapshot(
    history: DataFrame,
    source: DataFrame,
    key: str,
    *,
    check: Sequence[str] = (),
    updated_at: str | None = None,
    at=None,
) -> DataFrame:
    """History after one run.

    A key changed if one of the ``check`` columns differs, or if its ``updated_at`` is later
    than the open version's start. Closed versions never enter the join; keys that left the
    source stay open. The source has one row per key; a row without a key matches nothing and
    stays out of the join, where all such rows would meet in one partition.
    """
    if bool(check) == bool(updated_at):
        raise ValueError("give either check columns or updated_at")
    columns = source.columns
    keyless = F.col(key).isNull()
    settled = history.where(F.col(VALID_TO).isNotNull() | keyless)
    started = F.col(updated_at) if updated_at else F.lit(str(at))
    old = history.where(F.col(VALID_TO).isNull() & ~keyless).select(
        F.col(key), F.struct(*columns, VALID_FROM).alias("old")
    )
    new = source.where(~keyless).select(
        F.col(key), F.struct(*columns, started.cast("timestamp").alias(VALID_FROM)).alias("new")
    )
    pairs = old.join(new, key, "full")
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    if updated_at:
        changed = both & (F.col("new")[VALID_FROM] > F.col("old")[VALID_FROM])
    else:
        differs = F.lit(False)
        for c in check:
            differs = differs | ~F.col("old")[c].eqNullSafe(F.col("new")[c])
        changed = both & differs
    start_of_new = F.col("new")[VALID_FROM]
    version = lambda row, end: F.struct(
        *[F.col(row)[c].alias(c) for c in columns],
        F.col(row)[VALID_FROM].alias(VALID_FROM), end.cast("timestamp").alias(VALID_TO),
    )
    never = F.lit(None)
    versions = (
        F.when(F.col("old").isNull(), F.array(version("new", never)))
        .when(changed, F.array(version("old", start_of_new), version("new", never)))
        .otherwise(F.array(version("old", never)))
    )
    current = pairs.select(F.explode(versions).alias("v")).select("v.*")
    return (
        settled.select(*columns, VALID_FROM, VALID_TO)
        .unionByName(current)
        .unionByName(first_snapshot(source.where(keyless), started))
    )


def take_snapshot(
    source: DataFrame, path: str, key: str, *, check: Sequence[str] = (), updated_at: str | None = None, at=None,
) -> None:
    """Bring the history stored at ``path`` up to date with ``source``, or begin it; the arguments are those of ``snapshot``.

    Open versions lie in a part of their own: a run reads that part, not the history, and writes it anew. What it
    closes is written once, as one more part that no later run reads. Rows without a key can never be closed by a
    later one, so they lie with the closed. The new pointer names all parts: readers see the history before or
    after the run, and a run that died has changed nothing.
    """
    if bool(check) == bool(updated_at):
        raise ValueError("give either check columns or updated_at")
    spark = source.sparkSession
    before = live(spark, path)
    if before is None:
        now = first_snapshot(source, F.col(updated_at) if updated_at else F.lit(str(at)))
    else:
        now = snapshot(read_current(spark, path), source, key, check=check, updated_at=updated_at, at=at)
    may_close = F.col(VALID_TO).isNull() & F.col(key).isNotNull()
    before = before or Live()
    part = F.when(may_close, OPEN).otherwise(f"{CLOSED}{before.number + 1:08}")
    settled = {name: version for name, version in before.months.items() if name != OPEN}
    publish(spark, path, before, settled | write_version(now, path, part, gather=False), now.schema)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a stored history, open and closed."""
    return read_months(spark, path).drop(MONTH)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The open versions of rows with a key; no closed one is read."""
    return read_months(spark, path, OPEN).drop(MONTH)
