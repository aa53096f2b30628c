"""Shards under a byte limit, by extendible hashing.

A row's place is the bit string of its key's digest. The directory starts with one bucket, and
only a bucket over the limit is split, on one more bit, so a shard is a prefix of bits: the
shortest one under which no more than ``limit`` bytes lie. Nothing else moves when a
bucket splits. All sums are taken over cells, prefixes some bits longer than needed, and never
over rows that meet in one task: cells are counted in the map tasks first.

A bucket that the bits of one key fill alone cannot split on that key. It splits on the digest of
the whole row, and rows equal in every column, of which not even that tells the copies apart,
are counted and dealt out in runs that fit. A single row over the limit is a shard of its own.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.session import stored

BITS = 128
LIMIT = 64 << 20
#: Cells are so many bits finer than an even split needs.
SPARE_BITS = 6


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def digest_bits(digest: Column) -> Column:
    """The 128 bits of an MD5 in hex, as a string of 0 and 1."""
    halves = [F.lpad(F.conv(F.substring(digest, at, 16), 16, 2), 64, "0") for at in (1, 17)]
    return F.concat(*halves)


def key_bits(key: list[str]) -> Column:
    return digest_bits(F.md5(F.concat_ws(
        "\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    )))


def _common_bits(a: str, b: str) -> Column:
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y)
    differs = F.array_position(same, F.lit(False))
    return F.when(differs == 0, BITS).otherwise(differs - 1)


def _bits_for(size: Column, limit: int) -> Column:
    return F.ceil(F.log2(F.greatest(size / F.lit(limit), F.lit(1.0)))).cast("int") + SPARE_BITS


def _directory(cells: DataFrame, limit: int) -> DataFrame:
    """Cells with the shard they belong to; ``shard`` is NULL where the cell itself is too large."""
    steps = cells.select(
        "_path", "_cell", "bytes", "rows",
        F.explode(F.sequence(F.col("_from"), F.col("_to"))).alias("shard_depth"),
    ).withColumn("prefix", F.expr("substring(_cell, 1, shard_depth)"))
    fitting = (
        steps.groupBy("_path", "shard_depth", "prefix")
        .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        .where(F.col("shard_bytes") <= limit)
    )
    chosen = (
        steps.drop("bytes", "rows").join(fitting, ["_path", "shard_depth", "prefix"])
        .groupBy("_path", "_cell")
        .agg(F.min(F.struct("shard_depth", "prefix", "shard_bytes", "shard_rows")).alias("shard"))
    )
    return cells.join(chosen, ["_path", "_cell"], "left")


def shard(
    docs: DataFrame, size: Column, key: list[str], limit: int = LIMIT,
) -> DataFrame:
    """``docs`` with shard, shard_depth (bits), shard_bytes and shard_rows.

    ``shard`` is the prefix of bits, empty if all fits into one; behind a key's own 128 bits a
    dot and bits of the row's digest follow, behind those a number sign and the run of equal
    rows, depth counting the bits. NULL in a key column reads as an empty text. The
    shards of an empty table are none. Columns of the four names are replaced, any others pass through.
    """
    own = [c for c in docs.columns if c not in ("shard", "shard_depth", "shard_bytes", "shard_rows")]
    # the row travels as one column, so that its names meet none of those used here
    columns = ["_row"]
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), size.alias("_bytes"))
    parts = _split(sized, [f"_row.`{k}`" for k in key], columns, limit)
    return parts.select("_row.*", "shard", "shard_depth", "shard_bytes", "shard_rows")


def _split(sized: DataFrame, key: list[str], columns: list[str], limit: int) -> DataFrame:
    total = sized.agg(F.sum("_bytes")).first()[0] or 0
    depth = min(BITS, ceil(log2(max(1.0, total / limit))) + SPARE_BITS)
    digests = [key_bits(key), digest_bits(F.md5(F.to_json("_row")))]
    rows = sized.select(
        "*", F.lit("").alias("_path"), F.lit(0).alias("_from"), F.lit(depth).alias("_to")
    )
    done = []
    for level, bits in enumerate(digests):
        before = level * BITS
        while True:
            placed = rows.withColumn("_bits", bits).withColumn(
                "_cell", F.expr("substring(_bits, 1, _to)")
            )
            cells = placed.groupBy("_path", "_from", "_to", "_cell").agg(
                F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                F.min("_bits").alias("low"), F.max("_bits").alias("high"),
            )
            directory = stored(_directory(cells, limit), "shard-directory")
            fits = directory.where("shard IS NOT NULL").select("_path", "_cell", "shard.*").withColumnRenamed("prefix", "_prefix")
            done.append(placed.join(fits, ["_path", "_cell"]).select(
                *columns, F.concat("_path", "_prefix").alias("shard"),
                (F.col("shard_depth") + before).alias("shard_depth"), "shard_bytes", "shard_rows",
            ))
            over = directory.where("shard IS NULL")
            if over.isEmpty():
                return _union(done)
            deeper = over.where(F.col("_to") < BITS).select(
                "_path", "_cell", (F.col("_to") + 1).alias("_next"),
                F.least(
                    F.lit(BITS), _common_bits("low", "high") + _bits_for(F.col("bytes"), limit)
                ).cast("int").alias("_deep"),
            )
            spent = over.where(F.col("_to") == BITS).select("_path", "_cell", F.col("bytes").alias("_over"))
            if deeper.isEmpty():
                break
            # a cell that has spent its bits waits at its last bit until the others have, too
            again = deeper.unionByName(spent.select(
                "_path", "_cell", F.lit(BITS).alias("_next"), F.lit(BITS).alias("_deep")
            ))
            rows = placed.join(again, ["_path", "_cell"]).select(
                *columns, "_bytes", "_path", F.col("_next").alias("_from"), F.col("_deep").alias("_to")
            )
        rows = placed.join(spent, ["_path", "_cell"]).select(
            *columns, "_bytes", F.concat("_path", "_cell", F.lit(".")).alias("_path"),
            F.lit(0).alias("_from"),
            F.least(F.lit(BITS), _bits_for(F.col("_over"), limit)).alias("_to"),
        )
    done.append(_runs(rows, columns, limit))
    return _union(done)


def _runs(rows: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """Equal rows, counted and dealt out in runs of as many as fit."""
    fit = F.greatest(F.lit(1), F.expr(f"CAST({limit} DIV greatest(_bytes, 1) AS INT)"))
    return (
        rows.groupBy(*columns, "_bytes", "_path").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_fit", fit)
        .withColumn("_at", F.explode(F.expr("sequence(0L, _n - 1)")))
        .withColumn("_run", F.expr("_at DIV _fit"))
        .withColumn("shard_rows", F.least("_fit", F.col("_n") - F.col("_run") * F.col("_fit")))
        .select(
            *columns, F.concat(F.expr("rtrim('.', _path)"), F.lit("#"), F.col("_run").cast("string")).alias("shard"),
            F.lit(2 * BITS).alias("shard_depth"),
            (F.col("shard_rows") * F.col("_bytes")).alias("shard_bytes"), "shard_rows",
        )
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, each written by one task: its size is under the limit.

    Folders are named by the shard's bits, behind ``b``; long names end in the MD5 of the whole.
    """
    long = F.concat(F.substring("shard", 1, 96), F.lit("-"), F.md5("shard"))
    name = F.concat(F.lit("b"), F.when(F.length("shard") > 128, long).otherwise(F.col("shard")))
    named = sharded.withColumn("shard", name)
    named.repartition("shard").write.partitionBy("shard").parquet(path)


SHARD_SQL = """
    WITH r AS (
        SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
               array_to_string(list_transform(
                   string_split(md5(CAST(doc_id AS VARCHAR)), ''),
                   lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111',
                                    4 * (instr('0123456789abcdef', c) - 1) + 1, 4)), '') AS bits
        FROM documents
    ), p AS (
        SELECT doc_id, bytes, d, substr(bits, 1, d) AS prefix
        FROM r CROSS JOIN (SELECT unnest(range(0, 48)) AS d)
    ), s AS (
        SELECT d, prefix, sum(bytes) AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY d, prefix
    ), f AS (
        SELECT p.doc_id, p.bytes, p.d, p.prefix, s.shard_bytes, s.shard_rows,
               row_number() OVER (PARTITION BY p.doc_id ORDER BY p.d) AS nth
        FROM p JOIN s ON p.d = s.d AND p.prefix = s.prefix WHERE s.shard_bytes <= {limit}
    )
    SELECT doc_id, bytes, prefix AS shard, CAST(d AS INTEGER) AS shard_depth,
           CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows
    FROM f WHERE nth = 1
"""


@query("op9_sharding", SHARD_SQL.format(limit=LIMIT))
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select("doc_id", text_bytes(F.col("text")).alias("bytes"))
    return shard(sizes, F.col("bytes"), ["doc_id"])
