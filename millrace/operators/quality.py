"""Data tests: not null, unique, primary key, freshness, and the report over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import ColumnSpec
from millrace.operators.dictionary import ERROR_AFTER_HOURS, WARN_AFTER_HOURS

REPORT = ("model", "column", "test", "failures", "status")


def _report(df: DataFrame, model: str, column: Column, test: str) -> DataFrame:
    return df.select(
        F.lit(model).alias("model"), column.alias("column"), F.lit(test).alias("test"),
        F.col("failures"),
        F.when(F.col("failures") > 0, "fail").otherwise("pass").alias("status"),
    )


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column; all columns in one pass without moving a row."""
    counts = df.agg(*[
        F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"n{i}") for i, c in enumerate(columns)
    ])
    lines = F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"n{i}").alias("failures"))
        for i, c in enumerate(columns)
    ])
    return _report(
        counts.select(F.explode(lines).alias("t")).select("t.*"), model, F.col("name"), "not_null"
    )


def duplicated_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values, or combinations of values, that occur more than once; NULLs do not count."""
    for c in columns:
        df = df.where(F.col(f"`{c}`").isNotNull())
    return df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(
        F.count("*").alias("n_records")
    ).where("n_records > 1")


def unique(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Duplicated values per column; each branch reads its one column only."""
    return _union([
        _report(
            duplicated_values(df, [c]).agg(F.count("*").alias("failures")), model, F.lit(c), "unique"
        )
        for c in columns
    ])


def primary_key(df: DataFrame, model: str, columns: Sequence[str], composite: bool = False) -> DataFrame:
    """Not null and unique for every key column on its own, or for the key as a whole."""
    if not composite:
        return not_null(df, model, columns).unionByName(unique(df, model, columns))
    whole = ", ".join(columns)
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])
    nulls = df.agg(F.count(F.when(any_null, 1)).alias("failures"))
    twice = duplicated_values(df, columns).agg(F.count("*").alias("failures"))
    return _report(nulls, model, F.lit(whole), "not_null").unionByName(
        _report(twice, model, F.lit(whole), "unique")
    )


def freshness(
    df: DataFrame,
    loaded_at: str,
    as_of,
    warn_after_hours: int = WARN_AFTER_HOURS,
    error_after_hours: int = ERROR_AFTER_HOURS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Newest load and its status at a given instant; a table without rows is an error."""
    newest = df.groupBy(*by).agg(F.max(loaded_at).cast("timestamp").alias("max_loaded_at"))
    now = F.lit(str(as_of)).cast("timestamp")
    age = F.unix_micros(now) - F.unix_micros("max_loaded_at")
    limit = lambda hours: F.lit(hours * 3_600_000_000)
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > limit(error_after_hours)), "error")
        .when(age > limit(warn_after_hours), "warn")
        .otherwise("pass")
    )
    return newest.select(*by, "max_loaded_at", status.alias("status"))


def freshness_test(df: DataFrame, model: str, loaded_at: str, as_of, **limits: int) -> DataFrame:
    """Freshness as a line of the report."""
    state = freshness(df, loaded_at, as_of, **limits)
    return state.select(
        F.lit(model).alias("model"), F.lit(loaded_at).alias("column"),
        F.lit("freshness").alias("test"),
        F.when(F.col("status") == "pass", 0).otherwise(1).cast("bigint").alias("failures"),
        "status",
    )


def report(tests: Sequence[DataFrame]) -> DataFrame:
    return _union([t.select(*REPORT) for t in tests])


def dictionary_tests(df: DataFrame, model: str, dictionary: Sequence[ColumnSpec]) -> DataFrame:
    """The tests a dictionary declares: its key columns, and the key column of the table."""
    columns = [c.name for c in dictionary if c.is_key]
    if "unique_id" in df.columns:
        columns.append("unique_id")
    return primary_key(df, model, columns)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


COLUMN_METRICS = ("null_count", "min", "max")


def _number(df: DataFrame, column: str, value: Column) -> Column:
    """A value as a number: instants and days in seconds, truth as 0 and 1, text if it is one."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_seconds(value.cast("timestamp")).cast("double")
    return value.try_cast("double") if kind in ("string", "varchar", "char") else value.cast("double")


def monitored_metrics(
    df: DataFrame, time_filter: str, columns: Mapping[str, Sequence[str]] | Sequence[str]
) -> DataFrame:
    """Daily metrics of a monitored table: rows, freshness, and per column NULLs, min, max.

    A mapping lists the metrics wanted of each column; a plain list of columns wants all. The
    least and greatest text that is no number has no value. Integers are exact up to 2^53.
    One aggregate by day; a busy day is reduced in every task before the shuffle.
    """
    wanted = dict(columns) if isinstance(columns, Mapping) else dict.fromkeys(columns, COLUMN_METRICS)
    unknown = {m for metrics in wanted.values() for m in metrics} - set(COLUMN_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {', '.join(sorted(unknown))}")
    columns = list(wanted)
    aggs = [F.count("*").alias("row_count"), F.max(time_filter).alias("latest")]
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [
            F.count(F.when(col.isNull(), 1)).alias(f"nulls{i}"),
            _number(df, c, F.min(col)).alias(f"min{i}"),
            _number(df, c, F.max(col)).alias(f"max{i}"),
        ]
    daily = df.groupBy(F.to_date(time_filter).alias("day")).agg(*aggs)

    def line(column: str | None, metric: str, value: Column) -> Column:
        return F.struct(
            F.lit(column).cast("string").alias("column"), F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
        )

    day_end = F.unix_timestamp(F.date_add("day", 1).cast("timestamp"))
    lines = [
        line(None, "row_count", F.col("row_count")),
        line(None, "freshness", day_end - F.unix_timestamp(F.col("latest").cast("timestamp"))),
    ]
    for i, c in enumerate(columns):
        values = {"null_count": f"nulls{i}", "min": f"min{i}", "max": f"max{i}"}
        lines += [line(c, m, F.col(values[m])) for m in COLUMN_METRICS if m in wanted[c]]
    return daily.select("day", F.explode(F.array(*lines)).alias("m")).select("day", "m.*")
