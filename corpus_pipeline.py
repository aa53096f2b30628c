"""From raw documents to token ids.

Toxic texts go, copies go, near copies go, sources are mixed, texts are encoded. Each stage gets the rows
that the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, jaccard_join, mixing, pieces, toxicity
from millrace.llm.common import table
from millrace.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Spark then removes a query's shuffle files when the query ends, not when the driver next collects garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Texts go to Python in batches of so many bytes: a task holds one of them there and one in Spark, several times over.
BATCH_BYTES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def stage(function: Stage) -> Stage:
    """A stage in a session that does not hoard shuffle files, nor large batches: stages shuffle texts several times over."""

    @wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(REMOVE_SHUFFLES, "true")
        spark.conf.set(BATCH_BYTES, str(BATCH))
        return function(spark, docs, sf_dir)

    return staged


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that score below the threshold of the toxicity operator."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that share 80 of 100 shingles of five words: the smallest doc_id."""
    return jaccard_join.keep_first(docs, 5, 80)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows, written in the order in which the sources take turns."""
    return mixing.in_mix_order(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows in the order in which they were written, with ``position`` in it and the ``ids`` of their texts.

    Columns of these names are replaced.
    """
    placed = mixing.with_written_place(docs).repartitionByRange("position").sortWithinPartitions("position")
    return pieces.with_ids(placed, pieces.vocabulary())


STAGES = [
    ("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix), ("pieces", encode),
]

#: Learned scores and piece ids have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, "pipeline-stage")
    return docs
