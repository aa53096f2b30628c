"""Nearest vectors by inner product, with inverted lists and an adaptive scan over dimensions.

Vectors get one more component that makes them equally long, so that the largest inner product is the
smallest distance, and are turned by a random rotation, after which any part of the dimensions is a
fair sample of all. A list is scanned in blocks of columns: after each block the distance so far
is extrapolated, and a candidate goes as soon as the test says that its whole distance
would exceed the worst of the query's best so far. What survives all columns is scored exactly.

Lists come from a k-means fit on a documented sample; every vector is put into a list. How many
lists a query probes is fitted on the sample as well: as many as find ``RECALL`` of the true
neighbours there. Lists are cut into blocks of rows and queries into chunks, so a hot list is many
tasks. Each task tests many queries at once, by products of matrices as long as many candidates are left, and
returns the best of its block for each query. The nearest list of each query is scanned first, and what
its best ``k`` there have set is the bound with which the query goes to the other lists.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import query, table
from millrace.session import stored

#: About so many vectors the lists are fitted on (all, if there are fewer), and queries among them.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 400
#: Vectors in a list on average, and lists at most.
LIST_ROWS = 4096
MOST_LISTS = 4096
RECALL = 0.97
#: Rows of a list, and queries, that meet in one task.
BLOCK_ROWS = 8192
CHUNK_QUERIES = 2048
#: Queries that are tested together, and columns.
TOGETHER = 64
COLUMNS = 16
#: What one pair taken by itself costs, in pairs of a product of matrices.
PAIR_COST = 16
#: In standard errors, how far a partial distance must be beyond the bound.
CERTAINTY = 2.1


def usable(vector: Column) -> Column:
    """Whether all components are numbers and one is not 0."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def rotation(size: int, seed: int = 7) -> np.ndarray:
    turned, triangle = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return turned * np.sign(np.diag(triangle))


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component, under which all are ``longest`` long."""
    rest = np.maximum(0, longest ** 2 - np.einsum("ij,ij->i", vectors, vectors))
    return np.concatenate((vectors, np.sqrt(rest)[:, None]), axis=1)


def as_queries(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate((vectors, np.zeros((len(vectors), 1))), axis=1)


def k_means(points: np.ndarray, lists: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    random = np.random.default_rng(seed)
    centers = points[random.choice(len(points), lists, replace=False)]
    for _ in range(rounds):
        own = nearest_lists(points, centers, 1)[:, 0]
        count = np.bincount(own, minlength=lists)
        total = np.zeros_like(centers)
        np.add.at(total, own, points)
        centers = np.where(count[:, None] > 0, total / np.maximum(1, count)[:, None], centers)
    return centers


def nearest_lists(points: np.ndarray, centers: np.ndarray, most: int) -> np.ndarray:
    """The nearest ``most`` lists of each point, nearest first."""
    far = (centers ** 2).sum(axis=1) - 2 * points @ centers.T
    return np.argsort(far, axis=1, kind="stable")[:, :most]


def probes_for(sample: np.ndarray, centers: np.ndarray, longest: float, k: int) -> int:
    """The fewest lists in which ``RECALL`` of the sample's true neighbours lie."""
    queries = sample[:SAMPLE_QUERIES]
    score = queries @ sample.T
    score[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    k = min(k, max(1, len(sample) - 1))
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    own = nearest_lists(lengthened(sample, longest), centers, 1)[:, 0]
    place = np.argsort(nearest_lists(as_queries(queries), centers, len(centers)), axis=1)
    needed = np.take_along_axis(place, own[best], axis=1)
    return int(np.quantile(needed, RECALL, method="higher")) + 1


def apart(rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Squared distances of each query to each row, by one product of matrices."""
    own = np.einsum("ij,ij->i", asked, asked)[:, None] + np.einsum("ij,ij->i", rows, rows)
    return np.maximum(0, own - 2 * asked @ rows.T)


def scan(
    rows: np.ndarray, turned: np.ndarray, ids: np.ndarray, asked: np.ndarray, asked_turned: np.ndarray,
    asked_ids: np.ndarray, bounds: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of queries, ids, scores) of the best ``k`` rows for each query: largest score, then smallest id.

    ``bounds`` are squared distances beyond which nothing is wanted. The rows that are nearest in the first columns
    are measured in full and lower them; what the tests leave is carried as pairs of a query and a row.
    """
    size = turned.shape[1]
    same = asked_ids[:, None] == ids
    total = apart(turned[:, :COLUMNS], asked_turned[:, :COLUMNS])
    first = min(len(rows), 4 * k)
    if first >= k:
        total[same] = np.inf
        near = np.argpartition(total, first - 1, axis=1)[:, :first]
        whole = ((turned[near] - asked_turned[:, None]) ** 2).sum(axis=2)
        whole[np.take_along_axis(same, near, axis=1)] = np.inf
        bounds = np.minimum(bounds, np.partition(whole, k - 1, axis=1)[:, k - 1])
    rounding = 1e-12 * ((turned ** 2).sum(axis=1).max() + (asked_turned ** 2).sum(axis=1))

    def limits(high: int) -> np.ndarray:
        error = CERTAINTY * np.sqrt((1 / high) * (1 - high / size))
        return (bounds * (1 + error) ** 2 * (1 + 1e-9) + rounding) * (high / size)

    asking, left = np.nonzero((total <= limits(min(COLUMNS, size))[:, None]) & ~same)
    total = total[asking, left]
    for low in range(COLUMNS, size, COLUMNS):
        high = min(low + COLUMNS, size)
        if len(left) * PAIR_COST > same.size:
            total = total + apart(turned[:, low:high], asked_turned[:, low:high])[asking, left]
        else:
            total = total + ((turned[left, low:high] - asked_turned[asking, low:high]) ** 2).sum(axis=1)
        kept = total <= limits(high)[asking]
        asking, left, total = asking[kept], left[kept], total[kept]
    score = (rows[left] * asked[asking]).sum(axis=1)
    order = np.lexsort((ids[left], -score, asking))
    asking, left, score = asking[order], left[order], score[order]
    best = np.arange(len(asking)) - np.searchsorted(asking, asking) < k
    return asking[best], ids[left[best]], score[best]


def nearest(vectors: DataFrame, asked: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector under ``asked`` (on vec_id) its best ``k`` others.

    ``vectors`` holds vec_id and embedding. Larger inner products come first, of equal ones the
    smaller vec_id. Vectors without a vec_id, NULL, zero, holding NULL or non-finite
    components, or of another length than most, take no part; rows with one vec_id count once.
    Other columns are not looked at. Queries without any candidate have no row.
    """
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    known = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).groupBy("vec_id").agg(
        F.min(F.col("embedding").cast("array<double>")).alias("embedding")
    )
    known = stored(known, "vectors")
    facts = known.agg(
        F.mode(F.size("embedding"), True).alias("size"), F.count(F.lit(1)).alias("n"),
        F.max(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x)).alias("square"),
    ).first()
    if not facts["n"]:
        return spark.createDataFrame([], empty)
    size, longest = facts["size"], float(np.sqrt(facts["square"])) * (1 + 1e-12)
    known = known.where(F.size("embedding") == size)
    share = min(1.0, SAMPLE_ROWS / facts["n"])
    sampled = known.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < F.lit(share * (1 << 20))).orderBy(F.xxhash64("vec_id", F.lit(1)))
    sample = np.array([r[0] for r in sampled.select("embedding").collect()]).reshape(-1, size)
    lists = max(1, min(MOST_LISTS, facts["n"] // LIST_ROWS, len(sample)))
    centers = k_means(lengthened(sample, longest), lists) if len(sample) else np.zeros((1, size + 1))
    probes = probes_for(sample, centers, longest, k) if len(sample) > 1 else lists
    shared = spark.sparkContext.broadcast((centers, rotation(size + 1)))

    def put(batches):
        centers, _ = shared.value
        for batch in batches:
            points = batch.column(1).flatten().to_numpy().reshape(-1, size)
            own = nearest_lists(lengthened(points, longest), centers, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], ["vec_id", "embedding", "list"])

    def ask(batches):
        centers, _ = shared.value
        for batch in batches:
            points = batch.column(1).flatten().to_numpy().reshape(-1, size)
            found = nearest_lists(as_queries(points), centers, len(centers)).astype(np.int32)
            # as many as were fitted, and on until they hold k vectors besides the query's own
            within = np.cumsum(sizes[found], axis=1) - sizes[found] < k + 1
            within[:, :probes] = True
            offsets = np.concatenate(([0], np.cumsum(within.sum(axis=1)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[within]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "embedding", "lists"])

    rows = stored(known.select("vec_id", "embedding").mapInArrow(put, "vec_id long, embedding array<double>, list int"), "lists")
    # one row for each of at most MOST_LISTS lists
    sizes = np.zeros(len(centers), np.int64)
    for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["list"]] = r["n"]
    queries = stored(
        known.where(asked).select("vec_id", "embedding")
        .mapInArrow(ask, "vec_id long, embedding array<double>, lists array<int>")
        .select(F.col("vec_id").alias("query_id"), "embedding", F.posexplode("lists").alias("turn", "list")),
        "queries",
    )
    # one row for each of at most MOST_LISTS lists
    blocks = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))

    def best(candidates: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        if not len(candidates) or not len(asking):
            return pd.DataFrame({c: [] for c in columns}).astype(columns)
        turn = shared.value[1]
        ids = candidates["vec_id"].to_numpy()
        stacked = np.stack(candidates["embedding"].to_numpy())
        turned = lengthened(stacked, longest) @ turn
        wanted = np.stack(asking["embedding"].to_numpy())
        asking_ids = asking["query_id"].to_numpy()
        # the distance at which the score is the worst of the best k so far
        worst = asking["worst"].to_numpy(float)
        bounds = np.where(np.isnan(worst), np.inf, longest ** 2 + np.einsum("ij,ij->i", wanted, wanted) - 2 * worst)
        found = []
        for low in range(0, len(wanted), TOGETHER):
            part = slice(low, low + TOGETHER)
            places, near, score = scan(
                stacked, turned, ids, wanted[part], as_queries(wanted[part]) @ turn, asking_ids[part], bounds[part], k
            )
            found.append((asking_ids[part][places], near, score))
        return pd.DataFrame({c: np.concatenate(part) for c, part in zip(columns, zip(*found))})

    def scanned(queries: DataFrame) -> DataFrame:
        """The best of each list that the queries probe; ``worst`` is the score that their k-th has already, or NULL."""
        chunks = queries.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK_QUERIES).cast("int").alias("chunks"))
        plan = F.broadcast(blocks.join(chunks, "list"))
        pieces = (
            rows.join(plan, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("list", "block", "chunk", "vec_id", "embedding")
        )
        asks = (
            queries.join(plan, "list").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("list", "block", "chunk", "query_id", "embedding", "worst")
        )
        keys = ["list", "block", "chunk"]
        return pieces.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score double")

    near = stored(scanned(queries.where("turn = 0").withColumn("worst", F.lit(None).cast("double"))), "nearest-list")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    worst = near.withColumn("rank", ranked).where(F.col("rank") == k).select("query_id", F.col("score").alias("worst"))
    found = near.unionAll(scanned(queries.where("turn > 0").join(worst, "query_id", "left")))
    return (
        found.withColumn("rank", ranked).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


@query("op7_neighbours")
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
