"""Which table a source stands for, and the samples test targets read instead."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import quoted

# Targets that read samples, their warehouse, and the marks of a model that
# trains or applies machine learning.
SAMPLED_TARGETS = ("test", "e2e", "e2e_test")
SAMPLED_WAREHOUSE = "bigquery"
ML_KEYWORDS = ("CREATE MODEL", "PREDICT", "TRAIN", "ML.")

BUCKETS = 1 << 32


@dataclass(frozen=True)
class Target:
    type: str
    name: str
    database: str
    dataset: str

    @property
    def sampled(self) -> bool:
        return self.type == SAMPLED_WAREHOUSE and self.name in SAMPLED_TARGETS


def uses_ml(code: Column, whole_words: bool = False) -> Column:
    """Whether a model's code mentions machine learning; exact case, anywhere in the text.

    ``whole_words`` keeps ``CONSTRAINT`` from counting as ``TRAIN``.
    """
    found = F.lit(False)
    for keyword in ML_KEYWORDS:
        if whole_words:
            tail = "" if keyword.endswith(".") else r"\b"
            hit = code.rlike(r"\b" + keyword.replace(".", r"\.") + tail)
        else:
            hit = code.contains(keyword)
        found = found | F.coalesce(hit, F.lit(False))
    return found


def resolved_relation(
    source: Column, table: Column, relation: Column, code: Column, target: Target
) -> Column:
    """Relation that each model reads for a source table under a target."""
    if not target.sampled:
        return relation
    sample = F.concat(
        F.lit(f"`{target.database}.{target.dataset}_"), source, F.lit("."), table, F.lit("`")
    )
    return F.when(uses_ml(code), relation).otherwise(sample)


def source_name(source: str, table: str, target: Target, model_uses_ml: bool = False) -> str:
    """Spark name of a source table under a target."""
    if target.sampled and not model_uses_ml:
        return ".".join(quoted(p) for p in (f"{target.dataset}_{source}", table))
    return ".".join(quoted(p) for p in (source, table))


def read_source(
    spark: SparkSession, source: str, table: str, target: Target, model_uses_ml: bool = False
) -> DataFrame:
    return spark.table(source_name(source, table, target, model_uses_ml))


def write_sample(df: DataFrame, source: str, table: str, target: Target) -> None:
    """Store a sample as the table a test target reads for a source table."""
    if not target.sampled:
        raise ValueError(f"target {target.name} does not read samples")
    dataset = quoted(f"{target.dataset}_{source}")
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {dataset}")
    df.write.mode("overwrite").saveAsTable(source_name(source, table, target))


def repeatable_sample(df: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """Rows whose key digest falls into the given share of all digests.

    A key is in or out of every run and of every table that shares it, so samples still
    join. No shuffle: each row decides for itself.
    """
    digest = F.md5(F.concat_ws("-", *[F.col(f"`{k}`").cast("string") for k in keys]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.where(bucket < int(fraction * BUCKETS))


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
