"""Rows that every operator must bear."""

from pyspark.sql import DataFrame, SparkSession

LONG = "word " * 60_000
ODD = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, "  \n\t ", "de", None), (None, "No id here at all.", "en", "b"),
    (5, LONG, "en", "a"), (6, "x" * 300_000, "en", "a"), (7, "Same text, twice said.", "fr", "b"),
    (7, "Same text, twice said.", "fr", "b"), (8, "same TEXT, twice said.", "fr", "c"),
    (9, "Ünïcode ÉÀ 漢字 😀 \x00 end", "es", "a"), (10, "a", "en", ""), (-11, "Same text, twice said.", "fr", "b"),
]


def odd(spark: SparkSession) -> DataFrame:
    """Odd rows, with columns whose names operators might use themselves."""
    rows = [(*row, 1, "s", 0.5, 3, 4, 5, 6, 7, 8) for row in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, label int, kept string, score double, n long, "
        "component long, bytes long, prefix int, slot long, shard int"
    )


def none(spark: SparkSession) -> DataFrame:
    return odd(spark).limit(0)


def labels(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([(1, 1), (5, 0), (7, 0), (7, 0), (9, 1), (None, 1), (10, None)], f"doc_id long, {name} int")
