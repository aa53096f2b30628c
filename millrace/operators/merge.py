"""Incremental merge by key, as a function of two tables and into month partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.months import MONTH, in_order, live, month_of, publish, read_months, write_version
from millrace.operators.staging import latest_by
from millrace.session import stored

# Keys are broadcast up to this many bytes, an allowance per key included.
BROADCAST_BYTES = 256 << 20
BYTES_PER_KEY = 64
# Up to so many keys are named in a scan's filter, so many in a list: longer lists are not
# checked against Bloom filters.
NAMED_KEYS, PUSHED_KEYS = 200, 10


def require_distinct(source: DataFrame, key: str) -> None:
    """Raise if a key comes twice. Reads the key column only, reduced before its shuffle."""
    twice = (
        source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        .where("n > 1").take(1)
    )
    if twice:
        raise ValueError(f"merge: duplicate source key {twice[0][0]}")


def distinct_source(
    source: DataFrame, key: str, on_duplicate: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """The source with one row per key; rows without a key all stay.

    ``fail`` raises when a key comes twice, ``latest`` keeps its newest row and ``trust``
    takes the caller's word that none does.
    """
    if on_duplicate == "trust":
        return source
    if on_duplicate == "fail":
        require_distinct(source, key)
        return source
    if on_duplicate != "latest":
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    if not order_by:
        raise ValueError("on_duplicate='latest' needs order_by")
    keyed, keyless = source.where(F.col(key).isNotNull()), source.where(F.col(key).isNull())
    return latest_by(keyed, [key], [F.col(c) for c in order_by]).unionByName(keyless)


def _few_keys(source: DataFrame, key: str) -> bool:
    """Whether the keys of a stored source measure small enough to broadcast."""
    width = F.octet_length(F.col(key).cast("string")) + BYTES_PER_KEY
    return (source.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES


def _keys(source: DataFrame, key: str, few: bool) -> DataFrame:
    """The keys of a source: broadcast if they are few, joined by shuffle if not."""
    keys = source.where(F.col(key).isNotNull()).select(key)
    return F.broadcast(keys) if few else keys


def merge(
    target: DataFrame,
    source: DataFrame,
    key: str = "unique_id",
    on_duplicate: str = "fail",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The target after a merge: matched rows replaced, all others kept, the rest inserted.

    A NULL key matches nothing. Keyless rows stay out of the join, where they would all meet
    in one partition. Both sides are read more than once, so give it stored tables.
    """
    source = distinct_source(source, key, on_duplicate, order_by)
    if on_duplicate == "latest":
        source = stored(source, "merge-source")  # its keys are measured, joined and its rows added
    unmatched = _unmatched(target, source, key, _few_keys(source, key))
    return unmatched.unionByName(source.select(*target.columns))


def _unmatched(target: DataFrame, source: DataFrame, key: str, few: bool) -> DataFrame:
    keyed = target.where(F.col(key).isNotNull())
    kept = keyed.join(_keys(source, key, few), key, "left_anti").select(*target.columns)
    return kept.unionByName(target.where(F.col(key).isNull()))


def merge_into_months(
    source: DataFrame,
    path: str,
    field: str = "execution_date",
    key: str = "unique_id",
    *,
    full_refresh: bool = False,
    on_duplicate: str = "fail",
    order_by: Sequence[str] = (),
    one_month: bool = False,
) -> list[str | None]:
    """Merge a batch into a table partitioned by month; returns the months written.

    Only months that receive rows or lose a matched one are written, each once, and the table
    changes in one step: readers have it as it was or as it is. A run that died has changed
    nothing and is simply run again. Rows without a date form a month of their own. To find the months
    that lose rows, row groups that cannot hold a key of the batch are skipped. ``one_month``
    says that the batch lies within one month and need not be gathered.
    """
    spark = source.sparkSession
    before = live(spark, path)
    batch = stored(source.withColumn(MONTH, month_of(field)), "merge-batch")
    batch = distinct_source(batch, key, on_duplicate, order_by)
    if on_duplicate == "latest":
        batch = stored(batch, "merge-batch")

    if full_refresh or before is None:
        rows = batch.drop(MONTH)
        written = write_version(rows, path, field, key, gather=not one_month)
        publish(spark, path, before, written, rows.schema)
        return in_order(set(written) | set(before.months if before else ()))

    target = read_months(spark, path)
    few = _few_keys(batch, key)
    touched = target.where(_keys_of(batch, key)).select(key, MONTH).join(_keys(batch, key, few), key, "left_semi")
    months = set(_months(touched)) | set(_months(batch))
    named = F.coalesce(F.col(MONTH).isin([m for m in months if m is not None]), F.lit(False))
    affected = target.where(named | F.col(MONTH).isNull() if None in months else named)
    rewritten = _unmatched(affected, batch, key, few).unionByName(batch).drop(MONTH)
    written = write_version(rewritten, path, field, key)
    kept = {m: v for m, v in before.months.items() if m not in months}
    publish(spark, path, before, kept | written, rewritten.schema)
    return in_order(months)


def _keys_of(batch: DataFrame, key: str) -> Column:
    """What a target row must meet to have a key of the batch, as far as a scan can check it.

    A few keys are named, in lists so short that they reach the files' Bloom filters; more are
    bounded by the smallest and the largest.
    """
    keyed = batch.where(F.col(key).isNotNull())
    low, high, n = keyed.agg(F.min(key), F.max(key), F.count("*")).first()
    if n > NAMED_KEYS:
        return F.col(key).between(low, high)
    named = [row[0] for row in keyed.select(key).distinct().orderBy(key).collect()]
    wanted = F.lit(False)
    for i in range(0, len(named), PUSHED_KEYS):
        wanted = wanted | F.col(key).isin(named[i:i + PUSHED_KEYS])
    return wanted


def _months(df: DataFrame) -> list[str]:
    """Months of a table: as many as the calendar has, never as many as rows."""
    return [row[0] for row in df.select(MONTH).distinct().collect()]
