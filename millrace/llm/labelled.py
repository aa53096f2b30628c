"""Labels next to texts, scores next to rows, and a probability out of a margin."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side of (doc_id, label) with so many rows at most is broadcast, a larger one is shuffled.
BROADCAST_ROWS = 2_000_000


def fold(key: str, parts: int) -> Column:
    """crc32(key as text) mod parts; a NULL key counts as an empty text."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts).cast("int")


def with_label(docs: DataFrame, labels: DataFrame, name: str, how: str = "left") -> DataFrame:
    """(doc_id, text, label): the largest label of the doc_id, NULL if it has none."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1))
        .groupBy("doc_id").agg(F.max(name).cast("int").alias("label"))
    )
    if labels.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    return docs.select("doc_id", "text").join(known, "doc_id", how)


def sampled(rows: DataFrame, about: int) -> DataFrame:
    """All rows, or by a hash of doc_id and text about so many of them."""
    share = min(1.0, about / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))


def with_margins(
    docs: DataFrame, scorer: Callable[[], Callable[[pa.RecordBatch], np.ndarray]], name: str,
) -> DataFrame:
    """``docs`` with a column of doubles that ``scorer`` finds for each batch of rows."""
    columns = [c for c in docs.columns if c != name]

    def score(batches):
        scored = scorer()
        for batch in batches:
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(scored(batch), pa.float64())], [*columns, name]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]
    return docs.select(*columns).mapInArrow(score, ", ".join([*fields, f"{name} double"]))


def sigmoid_fit(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, offset) under which 1 / (1 + exp(-(slope * margin + offset))) fits the labels best.

    Targets are drawn in a little, so that margins which part the labels fully still have a best fit.
    """
    ones = int(label.sum())
    if not 0 < ones < len(label):
        return 0.0, 20.0 if ones else -20.0
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    center, scale = margin.mean(), margin.std() or 1.0
    x = np.stack([(margin - center) / scale, np.ones(len(margin))], 1)
    w = np.zeros(2)

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - target * z).sum()

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - target)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * center / scale)


def probability(margin: Column, slope: float, offset: float) -> Column:
    return 1 / (1 + F.exp(-(margin * F.lit(slope) + F.lit(offset))))
