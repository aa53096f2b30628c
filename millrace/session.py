"""Session settings the results depend on, and the folder jobs share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Results depend on these two: day boundaries are UTC days, and a value that does not
# fit its declared type is an error rather than a silent NULL.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Results do not depend on these: rows that are sorted in one task stay few enough for its share of
# memory. Staging builds payloads and digests of many times the size of what the scan reads, and a
# shuffle's rows are several times the compressed size that adaptive execution goes by.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": 8 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}

# A look-up side that measures at most this much is broadcast, an allowance per row included.
LOOKUP_BYTES = 64 << 20
BYTES_PER_ROW = 64


def pin_session(spark: SparkSession) -> SparkSession:
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in TASK_SETTINGS.items():
        if _bytes(spark, key) > most:
            spark.conf.set(key, str(most))
    return spark


def _bytes(spark: SparkSession, key: str) -> int:
    """A size setting of the session in bytes; a plain number is bytes."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run, below the folder the cluster names for checkpoints.

    Only a local master may fall back to a temporary folder: on a cluster a folder of the
    driver's machine is invisible to the executors.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table written to the shared folder.

    Cuts the lineage for what is used more than once, and outlives any executor.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(df: DataFrame) -> DataFrame:
    """The side of a join that is looked up in: broadcast if it measures small.

    The other side then stays where it is; beyond the limit both are shuffled.
    """
    width = F.octet_length(F.to_json(F.struct(*df.columns))) + BYTES_PER_ROW
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= LOOKUP_BYTES else df


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder of any store that Spark writes to; none without it."""
    place, store = _folder(spark, path)
    return [f.getPath().getName() for f in store.listStatus(place)] if store.exists(place) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    place, store = _folder(spark, path)
    store.delete(place, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there in full or not at all; one of that name must not be there yet."""
    place, store = _folder(spark, path)
    if store.exists(place):
        raise ValueError(f"{path} was written by another run")
    draft, _ = _folder(spark, f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not store.rename(draft, place):
        raise ValueError(f"{path} could not be put in place")


def read_text(spark: SparkSession, path: str) -> str:
    place, store = _folder(spark, path)
    stream = store.open(place)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text
