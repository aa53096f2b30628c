"""Exact duplicates found through recipes of content-defined chunks.

A text is cut where its own content says so: at the first sentence end after ``LOW``
characters, after ``HIGH`` at the latest. Equal texts are cut alike, and so are equal parts of
different texts, so a repeated part crosses the shuffle once for each task that holds it. The
chunks are reduced to distinct (hash, bytes) pairs, which proves for each hash that it stands
for one chunk; those that do not get a number besides. From there a text is its ordered list
of identifiers, and only these lists, some hundred times shorter than the texts, are compared.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import equal, query, table, with_group
from millrace.session import stored

LOW, HIGH = 512, 4096
#: A cut falls behind a sentence's end; the second branch takes the rest, or HIGH characters.
CHUNK = rf"(?s).{{{LOW},{HIGH}}}?(?<=[.!?;:\n]\s)|.{{1,{HIGH}}}"


def normalised(text: Column) -> Column:
    return F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def ambiguous_chunks(texts: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """(h, chunk, variant) of chunks whose hash also stands for another chunk.

    Hashes that were proved to stand for one chunk have no row here.
    """
    distinct = (
        texts.select(F.explode(chunks(F.col("_text"))).alias("chunk"))
        .select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
    )
    clashing = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    order = Window.partitionBy("h").orderBy("chunk")
    return distinct.join(clashing, "h").withColumn("variant", F.row_number().over(order))


def exact_groups(
    docs: DataFrame, hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty, and all empty
    texts are equal. The largest doc_id of a group stays (a NULL doc_id only if the group has
    no other); of repeated rows with that doc_id, one is marked as kept. Further columns of
    ``docs`` are not looked at. An empty table gives an empty result.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("_text"))
    ambiguous = ambiguous_chunks(texts, hashed)
    recipes = texts.select(
        "doc_id", F.unhex(F.sha2("_text", 256)).alias("_sha"),
        F.transform(chunks(F.col("_text")), lambda chunk: hashed(chunk)).alias("recipe"),
    )
    recipes = recipes.withColumn("variants", F.lit(None).cast("array<struct<pos:int,variant:int>>"))
    if not ambiguous.isEmpty():
        recipes = _with_variants(recipes, texts, ambiguous, hashed)
    rows = stored(
        recipes.withColumn("variants", F.coalesce("variants", F.array()))
        .groupBy("doc_id", "_sha", "recipe", "variants")
        .agg(F.count(F.lit(1)).alias("copies")),
        "recipes",
    )
    grouped = with_group(
        rows, ["recipe", "variants"], ["doc_id"],
        {"part_keep": F.max("doc_id"), "part_size": F.sum("copies")},
        {"keep_id": F.max("part_keep"), "group_size": F.sum("part_size")},
    )
    return grouped.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def _with_variants(
    recipes: DataFrame, texts: DataFrame, ambiguous: DataFrame,
    hashed: Callable[[Column], Column],
) -> DataFrame:
    """Recipes in which a hash of several chunks is told apart by the chunk's number."""
    found = (
        texts.select(
            "doc_id", F.unhex(F.sha2("_text", 256)).alias("_sha"),
            F.posexplode(chunks(F.col("_text"))).alias("pos", "chunk"),
        )
        .withColumn("h", hashed(F.col("chunk")))
        .join(ambiguous, ["h", "chunk"])
        .groupBy("doc_id", "_sha")
        .agg(F.array_sort(F.collect_set(F.struct("pos", "variant"))).alias("found"))
    )
    return (
        recipes.join(found, equal(recipes, found, ["doc_id", "_sha"]), "left")
        .select(recipes["doc_id"], recipes["_sha"], "recipe", F.col("found").alias("variants"))
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these are called.

    Of rows that share both doc_id and text, the one whose text as written sorts last stays; what
    their other columns hold decides only among texts that are written alike.
    """
    # a struct with NULL equals its like, so the join and the groups share one shuffle of the rows
    kept = (
        exact_groups(docs.select("doc_id", "text")).where("kept")
        .select(F.struct(F.col("doc_id").alias("id")).alias("id"), F.unhex("text_sha256").alias("sha"))
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(F.col("doc_id").alias("id")).alias("id"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("sha"), F.coalesce("text", F.lit("")).alias("written"),
    )
    stay = rows.join(kept, ["id", "sha"], "left_semi")
    return (
        stay.groupBy("id", "sha").agg(F.max_by("row", F.struct("written", F.xxhash64("row"))).alias("row")).select("row.*")
    )


@query("op3_exact_dedup", """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM d
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
