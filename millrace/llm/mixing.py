"""Sources interleaved at target weights, by Pfair scheduling.

The rows of a source, in the order of their digests, form blocks. A source of weight w is owed
w blocks a slot, w being its share among the sources that still have blocks: its block k is released
at the slot in which its due passes k, and due at the end of the one in which it reaches k + 1. Each
slot goes to the released block with the earliest deadline, which meets all deadlines, so after any
number of slots each source is less than one block away from its due, whether or not others ended before.

Every source has a weight of its own, NULL and the empty name too, and dues are exact: weights are taken
as the whole numbers whose ratios they are. The driver gets one count a source and goes through the
slots, one heap entry a source; the slots go out as a table, a bounded piece at a time, and rows
find theirs by a join. Rows never pass the driver.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cmp_to_key
from itertools import islice
from math import ceil, inf, log

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import query, table
from millrace.session import looked_up, shared_folder, stored

BLOCK_ROWS = 4
#: Rows of one source are numbered in parts of about this many.
PART_ROWS = 20_000
#: Blocks that the driver schedules before it writes them out.
PIECE = 1 << 20
SLOTS = "mix_name string, block long, slot long"


def dues(blocks: list[int], weights: list[float]) -> Callable[[int, int], tuple[int, int]]:
    """Of (source, k), the slots in which the due of the source reaches k blocks: whole ones until then, and rounded up.

    Sources share the slots in proportion to their weights and, when one has all its blocks, the others
    go on without it. Over v blocks a unit of weight, min(n, w * v) summed over the sources are dealt, the
    least of the lines that hold between two ends. All numbers are exact.
    """
    if any(not 0 < w < inf for w in weights):
        raise ValueError("weights are positive numbers")
    ratios = [float(w).as_integer_ratio() for w in weights]
    scale = max((below for _, below in ratios), default=1)
    whole = [above * (scale // below) for above, below in ratios]
    by_end = sorted(range(len(blocks)), key=cmp_to_key(lambda a, b: blocks[a] * whole[b] - blocks[b] * whole[a]))
    ends: list[float] = []
    lines: list[tuple[int, int]] = []
    dealt, rate, last = 0, sum(whole), None
    for s in by_end:
        if last is None or blocks[s] * whole[last] != blocks[last] * whole[s]:
            ends.append(blocks[s] / whole[s])
            lines.append((dealt, rate))
            last = s
        dealt += blocks[s]
        rate -= whole[s]

    def reached(s: int, k: int) -> tuple[int, int]:
        w = whole[s]
        # division rounds in order, so the line is among those whose end is the same double, and the next
        at = first = bisect_left(ends, k / w)
        dealt, rate = lines[at]
        least = dealt * w + k * rate
        while ends[at] == ends[first] == k / w and at + 1 < len(ends):
            at += 1
            dealt, rate = lines[at]
            least = min(least, dealt * w + k * rate)
        return least // w, -(-least // w)

    return reached


def schedule(blocks: list[int], weights: list[float]) -> Iterator[tuple[int, int]]:
    """(source, its block) of one slot after the other; of equal deadlines the smaller source comes first."""
    reached = dues(blocks, weights)
    released: list[tuple[int, int, int, int]] = []
    later: dict[int, list[tuple[int, int, int, int]]] = {}
    for s, n in enumerate(blocks):
        if n:
            after, deadline = reached(s, 1)
            released.append((deadline, s, 0, after))
    heapq.heapify(released)
    for slot in range(sum(blocks)):
        for job in later.pop(slot, ()):
            heapq.heappush(released, job)
        _, s, block, release = heapq.heappop(released)
        yield s, block
        if block + 1 < blocks[s]:
            after, deadline = reached(s, block + 2)
            job = deadline, s, block + 1, after
            if release <= slot:
                heapq.heappush(released, job)
            else:
                later.setdefault(release, []).append(job)


def slot_table(sources: DataFrame) -> DataFrame:
    """(mix_name, block, slot) of all blocks, from the (mix_name, blocks, weight) of all sources.

    The driver holds the sources and ``PIECE`` blocks at once, and writes them out.
    """
    spark, path = sources.sparkSession, shared_folder(sources.sparkSession, "slots")
    known = sorted(tuple(r) for r in sources.select("mix_name", "blocks", "weight").collect())
    names = pa.array([name for name, _, _ in known], pa.string())
    jobs = schedule([n for _, n, _ in known], [w for _, _, w in known])
    start = 0
    while True:
        piece = np.array(list(islice(jobs, PIECE)), np.int64).reshape(-1, 2)
        columns = [names.take(pa.array(piece[:, 0])), pa.array(piece[:, 1]), pa.array(np.arange(start, start + len(piece)))]
        spark.createDataFrame(pa.table(columns, ["mix_name", "block", "slot"]), SLOTS).write.mode("append").parquet(path)
        start += len(piece)
        if len(piece) < PIECE:
            return spark.read.schema(SLOTS).parquet(path)


def interleaved(
    docs: DataFrame, source: str = "source", key: str = "doc_id", block_rows: int = BLOCK_ROWS,
    weight: Callable[[Column], Column] = F.sqrt,
) -> DataFrame:
    """``docs`` with mix_source, block, slot and place; sorted by (slot, place) they are the mix.

    All rows stay, and each source has the target weight that ``weight`` makes of its number of rows; NULL
    is a source too. ``block`` numbers the blocks of a source, ``place`` the rows in a block, the last of
    which may be short. Rows are taken in the order of their key's MD5, equal keys by a hash of the
    whole row. Columns of these names in ``docs`` are replaced. An empty table stays empty.
    """
    columns = [c for c in docs.columns if c not in ("mix_source", "block", "slot", "place")]
    own = F.col(source).cast("string")
    # NULL equals nothing in a join: names carry a sign in front
    labelled = docs.select(
        F.struct(*columns).alias("_row"), F.col(key).alias("_key"), F.xxhash64(*columns).alias("_hash"), own.alias("mix_source"), F.coalesce(F.concat(F.lit("="), own), F.lit("")).alias("mix_name"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_digest"),
    )
    sources = stored(
        labelled.groupBy("mix_name").agg(F.count(F.lit(1)).alias("rows"))
        .select("mix_name", "rows", F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"),
                weight(F.col("rows")).cast("double").alias("weight")),
        "sources",
    )
    most = sources.agg(F.max("rows")).first()[0] or 0
    digits = max(1, ceil(log(most / PART_ROWS, 16))) if most > PART_ROWS else 1
    labelled = labelled.withColumn("_part", F.substring("_digest", 1, digits))
    before = Window.partitionBy("mix_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        labelled.groupBy("mix_name", "_part").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    # each part with the slots of its blocks, in order: rows meet their part, where they are, and need not move for their block
    first, last = F.expr(f"_before DIV {block_rows}"), F.expr(f"(_before + _n - 1) DIV {block_rows}")
    parts = (
        parts.withColumn("_first", first).withColumn("block", F.explode(F.sequence(first, last)))
        .join(slot_table(sources), ["mix_name", "block"])
        .groupBy("mix_name", "_part", "_before", "_first").agg(F.sort_array(F.collect_list(F.struct("block", "slot"))).alias("_slots"))
    )
    order = Window.partitionBy("mix_name", "_part").orderBy("_digest", "_key", "_hash")
    return (
        labelled.withColumn("_nth", F.row_number().over(order))
        .join(parts, ["mix_name", "_part"])
        .withColumn("_index", F.col("_before") + F.col("_nth") - 1)
        .withColumn("block", F.expr(f"_index DIV {block_rows}"))
        .withColumn("slot", F.expr("_slots[CAST(block - _first AS INT)].slot"))
        .select("_row.*", "mix_source", "block", "slot", F.expr(f"CAST(_index % {block_rows} AS INT)").alias("place"))
    )


def in_mix_order(docs: DataFrame, source: str = "source") -> DataFrame:
    """The same rows and columns, written out in the order of the mix."""
    order = ["_mix.slot", "_mix.place"]
    found = interleaved(docs.select(F.struct(*docs.columns).alias("_row"), F.col(source).alias("_source"), F.col("doc_id").alias("_key")), "_source", "_key")
    return (
        found.select("_row", F.struct("slot", "place").alias("_mix"))
        .repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*")
    )


def with_written_place(docs: DataFrame, name: str = "position") -> DataFrame:
    """``docs``, read from files, with each row's place in them: files by number, rows as they stand; 0 is the first.

    A table read again comes in no order, but Spark numbers the files it writes, and rows know their file. Rows that
    come from no file are numbered in the order of their partitions, with gaps. A column of that name is replaced.
    """
    row = F.struct(*[c for c in docs.columns if c != name]).alias("_row")
    try:
        origin = docs.metadataColumn("_metadata")
        placed = docs.select(row, origin["file_name"].alias("_file"), origin["row_index"].alias("_index"))
    except AnalysisException:
        return docs.select(row, F.monotonically_increasing_id().alias("_index")).select("_row.*", F.col("_index").alias(name))
    # one row a file
    before = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return placed.join(looked_up(files), "_file").select("_row.*", (F.col("_before") + F.col("_index")).alias(name))


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return interleaved(docs).withColumn("position", F.col("slot") * BLOCK_ROWS + F.col("place"))
