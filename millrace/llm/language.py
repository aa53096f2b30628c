"""Language of a text, by the rank order of its n-grams.

A language's profile is its ``RANKS`` most frequent n-grams of one to three letters, words padded
with a blank, most frequent first. So is a text's. The distance is how far, summed over the
text's n-grams, each stands out of place in the language's profile, ``RANKS`` if it is not there.

An n-gram is a number: three code points of 21 bits each, so profiles hold no hash collisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import query, table

RANKS = 300
UNKNOWN = "und"
#: So many characters are turned into n-grams at once, or one text if it is longer.
SLICE_CHARS = 1 << 20


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; whatever is no letter is 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return points.astype(np.int64)
    known, at = np.unique(points, return_inverse=True) if points.max() > 0xFFFF else (None, None)
    if known is None:
        seen = np.zeros(1 << 16, bool)
        seen[points] = True
        for code in np.flatnonzero(seen):
            seen[code] = chr(code).isalpha()
        return np.where(seen[points], points, 0).astype(np.int64)
    letter = np.array([chr(code).isalpha() for code in known.tolist()])
    return np.where(letter[at], points, 0).astype(np.int64)


def grams(points: np.ndarray) -> np.ndarray:
    """All n-grams of one to three characters; blanks (0) pad words, and runs of them are one."""
    points = np.concatenate(([0], points, [0]))
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    points = points[keep]
    one = points[points != 0]
    two = (points[:-1] << 21) | points[1:]
    two = two[(points[:-1] != 0) | (points[1:] != 0)] | (1 << 63 - 1)
    three = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    return np.concatenate((one, two, three[points[1:-1] != 0] ^ np.int64(-1)))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else keys
    return keys[first], np.diff(np.append(first, len(keys)))


def _counts_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    size = 0

    def fold():
        for lang, parts in held.items():
            codes, counts = _counted(np.concatenate(parts))
            if lang in totals:
                both = np.concatenate((totals[lang][0], codes))
                number = np.concatenate((totals[lang][1], counts))
                codes, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, number).astype(np.int64)
            totals[lang] = codes, counts
        held.clear()

    def out():
        for lang, (codes, counts) in totals.items():
            for at in range(0, len(codes), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes[part])), pa.array(codes[part]), pa.array(counts[part])],
                    ["lang", "gram", "n"],
                )
        totals.clear()

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            points = _letters(text.as_py())
            if points.any():
                held.setdefault(lang.as_py(), []).append(grams(points))
                size += len(points)
            if size > SLICE_CHARS:
                fold()
                size = 0
                if sum(len(codes) for codes, _ in totals.values()) > 1 << 21:
                    yield from out()
    fold()
    yield from out()


def profiles(labelled: DataFrame, ranks: int = RANKS) -> dict[str, np.ndarray]:
    """The n-grams of each language, most frequent first, from all rows of (text, lang)."""
    counted = (
        labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
        .mapInArrow(_counts_by_language, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    rows = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("grams"))
    return {r["lang"]: np.array([g["gram"] for g in r["grams"]], np.int64) for r in rows.toLocalIterator()}


class Ranker:
    """Out-of-place distances of texts to a set of profiles."""

    def __init__(self, found: dict[str, np.ndarray], ranks: int = RANKS):
        self.languages, self.ranks = sorted(found), ranks
        codes = [found[x] for x in self.languages]
        sizes = [len(c) for c in codes]
        gram = np.concatenate([*codes, np.zeros(0, np.int64)])
        order = np.argsort(gram, kind="stable")
        #: the i-th known n-gram has the entries from begins[i] to begins[i + 1]: a language and the rank there
        self.known, first = np.unique(gram[order], return_index=True)
        self.begins = np.append(first, len(gram))
        self.language = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.rank = np.concatenate([*map(np.arange, sizes), np.zeros(0, np.int64)])[order]

    def best(self, text: str | None) -> tuple[str, float]:
        """The nearest language, the first by name among equals, and 1 - distance / farthest."""
        points = _letters(text or "")
        if not points.any() or not self.languages:
            return UNKNOWN, 0.0
        codes, counts = _counted(grams(points))
        if len(codes) > self.ranks:
            edge = np.partition(counts, len(counts) - self.ranks)[len(counts) - self.ranks]
            some = np.flatnonzero(counts >= edge)
            codes, counts = codes[some], counts[some]
        order = np.lexsort((codes, -counts))[: self.ranks]
        codes = codes[order]
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        place = np.flatnonzero(self.known[at] == codes)
        begin, size = self.begins[at[place]], self.begins[at[place] + 1] - self.begins[at[place]]
        entry = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        # every n-gram is farthest out of place, but for languages that have it
        nearer = self.ranks - np.abs(self.rank[entry] - np.repeat(place, size))
        distance = len(codes) * self.ranks - np.bincount(self.language[entry], nearer, len(self.languages))
        nearest = int(distance.argmin())
        return self.languages[nearest], 1 - float(distance[nearest]) / (len(codes) * self.ranks)


def with_language(docs: DataFrame, found: dict[str, np.ndarray], ranks: int = RANKS) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1, higher: nearer to the profile).

    ``und`` and 0 for a NULL text, one without letters, and where nothing was learned.
    Columns of these names are replaced; others pass through.
    """
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def score(batches):
        ranker = Ranker(shared.value, ranks)
        for batch in batches:
            results = [ranker.best(text.as_py()) for text in batch.column(batch.schema.get_field_index("text"))]
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            arrays += [pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]
    return docs.select(*columns).mapInArrow(score, ", ".join([*fields, "lang_pred string", "score double"]))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    found = profiles(docs.where(~held_out).select("text", "lang"))
    scored = with_language(docs.select("doc_id", "text"), found)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
