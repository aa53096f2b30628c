"""What the operators share: their registry, tables of a run, lookups in hot groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: In how many parts the rows of one key are counted, and looked up again.
SALTS = 64


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], name: str) -> str:
    """``name``, longer by underscores as long as a column is called so in any letter case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def equal(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of the columns in which NULL equals NULL."""
    matched = F.lit(True)
    for name in columns:
        matched = matched & left[name].eqNullSafe(right[name])
    return matched


def with_group(
    df: DataFrame, keys: list[str], spread_by: list[str],
    first: dict[str, Column], then: dict[str, Column], salts: int = SALTS,
) -> DataFrame:
    """Each row with the aggregates of its group, however large the group is.

    A group is counted in ``salts`` parts, the parts are added up, and each row meets the
    total through its own part: no task gets more than that share of a hot group.
    ``first`` are the aggregates of a part, ``then`` those over the parts (of columns that
    ``first`` names). ``spread_by`` are columns that differ within a group. Keys hold no NULL.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    parts = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in first.items()])
    totals = parts.groupBy(*keys).agg(*[c.alias(n) for n, c in then.items()])
    lookup = parts.select(*keys, "_salt").join(totals, keys)
    return salted.join(lookup, [*keys, "_salt"]).drop("_salt")
