"""Text quality, by a linear model on Naive Bayes features.

A text is the set of its n-grams: words, pairs of neighbours and pairs of word shapes, hashed to
``BINS`` numbers. Each present n-gram counts as its log-count ratio, how much likelier good texts
hold it than bad ones, over all labelled rows. On these features a hinge-loss model is fitted by
dual coordinate descent: one labelled text at a time has its dual variable set to the best value
between 0 and ``COST`` while the others stay.

The fit takes a documented sample of labelled rows, in ``BLOCKS`` tasks with one block of it each,
and the blocks' weights are averaged. A block also scores the texts of the next one, which it
has not seen; on these margins the probability is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table, unused
from millrace.llm.labelled import fold, probability, sampled, sigmoid_fit, with_label, with_margins
from millrace.llm.tokens import KINDS, chain, mix, slices, text_column, words
from millrace.session import stored

BINS = 1 << 18
#: About so many labelled rows the hinge model is fitted on (all, if there are fewer), in so many tasks.
FIT_ROWS = 16_000
BLOCKS = 8
COST = 1.0
EPOCHS = 20
SMOOTH = 1.0
THRESHOLD = 0.3


def features(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bin) of the n-grams that each row's text holds, each pair once, rows ascending."""
    found = words(bounds, data, KINDS)
    n = len(found.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same_row = found.row[1:] == found.row[:-1]
    again = np.zeros(n, np.uint64)
    again[1:] = same_row & (found.hash[1:] == found.hash[:-1])
    two_back = np.zeros(n, np.uint64)
    two_back[2:] = (found.row[2:] == found.row[:-2]) & (found.hash[2:] == found.hash[:-2])
    case = np.where(found.caps == 0, 0, np.where(found.caps == 1, 1, np.where(found.caps < found.length, 2, 3)))
    size = np.minimum(found.length, 12)
    shape = (found.kind.astype(np.uint64) * np.uint64(4) + case.astype(np.uint64)) * np.uint64(16) + size.astype(np.uint64)
    shape = mix(shape * np.uint64(4) + again * np.uint64(2) + two_back)
    signs = np.where(found.kind == 3, found.hash, shape)
    grams = [found.hash, shape ^ np.uint64(0x5555), mix(chain(found.hash, 2) ^ np.uint64(1))[same_row], mix(chain(signs, 2) ^ np.uint64(2))[same_row]]
    rows = [found.row, found.row, found.row[1:][same_row], found.row[1:][same_row]]
    keyed = (np.concatenate(rows).astype(np.int64) << 18) | (mix(np.concatenate(grams)) % np.uint64(BINS)).astype(np.int64)
    keyed = np.sort(keyed)
    keyed = keyed[np.concatenate(([True], keyed[1:] != keyed[:-1]))]
    return keyed >> 18, keyed & (BINS - 1)


def _batch_features(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    bounds, data = text_column(batch, "text")
    for low, high in slices(bounds, 1 << 20):
        row, bin_ = features(bounds[low:high + 1], data)
        yield low, high, row, bin_


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BINS), np.int64)
    for batch in batches:
        label = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
        for low, high, row, bin_ in _batch_features(batch):
            for which in (0, 1):
                counts[which] += np.bincount(bin_[label[low:high][row] == which], minlength=BINS)
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(counts[0][seen]), pa.array(counts[1][seen])], ["bin", "n0", "n1"]
    )


def log_count_ratios(labelled: DataFrame) -> np.ndarray | None:
    """For each bin the log of its share among label 1's n-grams over that among label 0's.

    From all rows of (text, label); None if a label has no n-gram.
    """
    counted = (
        labelled.select("text", "label").mapInArrow(_count, "bin int, n0 long, n1 long")
        .groupBy("bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    )
    shares = []
    for name in ("n0", "n1"):
        counts = np.zeros(BINS)
        counts[counted.column("bin").to_numpy()] = counted.column(name).to_numpy()
        if not counts.any():
            return None
        shares.append((counts + SMOOTH) / (counts.sum() + SMOOTH * BINS))
    return np.log(shares[1]) - np.log(shares[0])


def hinge_fit(
    texts: list[np.ndarray], label: np.ndarray, ratio: np.ndarray,
    cost: float = COST, epochs: int = EPOCHS, seed: int = 0,
) -> np.ndarray:
    """Weights of the bins and, last, of a constant: dual coordinate descent on the hinge loss.

    A text's features are its bins' ratios, scaled to length 1; the rarer label costs as much
    as the other in all.
    """
    weight = np.zeros(len(ratio) + 1)
    y = np.where(label == 1, 1.0, -1.0)
    each = np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum())) * cost
    columns = [np.append(t, len(ratio)) for t in texts]
    values = [_scaled(ratio[t]) for t in texts]
    norm = np.array([v @ v for v in values])
    alpha, order = np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(y)):
            slope = y[i] * (weight[columns[i]] @ values[i]) - 1
            now = min(max(alpha[i] - slope / norm[i], 0.0), each[i])
            if now != alpha[i]:
                weight[columns[i]] += (now - alpha[i]) * y[i] * values[i]
                moved = max(moved, abs(now - alpha[i]))
                alpha[i] = now
        if moved < 1e-3:
            break
    return weight


def _scaled(values: np.ndarray) -> np.ndarray:
    return np.append(values / max(np.sqrt(values @ values), 1e-12), 1.0)


def margins(row: np.ndarray, bin_: np.ndarray, rows: int, ratio: np.ndarray, weight: np.ndarray) -> np.ndarray:
    total = np.bincount(row, ratio[bin_] * weight[bin_], rows)
    length = np.sqrt(np.bincount(row, ratio[bin_] ** 2, rows))
    return total / np.maximum(length, 1e-12) + weight[-1]


def fitted(labelled: DataFrame, ratio: np.ndarray, fit_rows: int, blocks: int) -> tuple[np.ndarray, float, float]:
    """Averaged weights, and slope and offset of the probability.

    Each of ``blocks`` tasks gets its part of the sample and the next part, whose margins it returns.
    """
    shared = labelled.sparkSession.sparkContext.broadcast(ratio)
    sample = (
        sampled(labelled.select("doc_id", "text", "label"), fit_rows)
        .withColumn("block", F.pmod(F.xxhash64("text", "doc_id"), F.lit(blocks)).cast("int"))
        .withColumn("task", F.explode(F.array("block", F.pmod(F.col("block") - 1, F.lit(blocks)))))
    )

    def fit(key, frame: pd.DataFrame) -> pd.DataFrame:
        ratio = shared.value
        frame = frame.sort_values(["doc_id", "text"], na_position="first").reset_index(drop=True)
        batch = pa.RecordBatch.from_arrays([pa.array(frame["text"], pa.string(), from_pandas=True)], ["text"])
        texts: list[np.ndarray] = []
        for low, high, row, bin_ in _batch_features(batch):
            texts += np.split(bin_, np.searchsorted(row, np.arange(1, high - low)))
        label, own = frame["label"].to_numpy(), (frame["block"] == key[0]).to_numpy()
        mine = np.flatnonzero(own)
        weight = hinge_fit([texts[i] for i in mine], label[mine], ratio)
        other = np.flatnonzero(~own)
        margin = [weight[np.append(texts[i], len(ratio))] @ _scaled(ratio[texts[i]]) for i in other]
        held = np.flatnonzero(weight)
        return pd.DataFrame({
            "bin": [held.astype(np.int32)], "weight": [weight[held]],
            "margin": [np.array(margin, float)], "label": [label[other].astype(np.int32)],
        })

    parts = sample.groupBy("task").applyInPandas(
        fit, "bin array<int>, weight array<double>, margin array<double>, label array<int>"
    ).collect()
    weight = np.zeros(BINS + 1)
    for part in parts:
        weight[part["bin"]] += np.array(part["weight"]) / len(parts)
    margin = np.concatenate([part["margin"] for part in parts])
    label = np.concatenate([part["label"] for part in parts])
    return (weight, *sigmoid_fit(margin, label))


def with_quality(
    docs: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS, blocks: int = BLOCKS,
) -> DataFrame:
    """``docs`` with quality: 0 to 1, higher: label 1 likelier.

    ``labelled`` holds doc_id, text and label 0 or 1. NULL and empty texts hold no n-gram and score by
    the constant alone. If a label does not occur, all texts score as the other (0.5 without
    any label). A column of that name is replaced.
    """
    labelled = stored(labelled.select("doc_id", "text", "label"), "labelled")
    ratio = log_count_ratios(labelled)
    if ratio is None:
        share = labelled.agg(F.avg("label")).first()[0]
        return docs.withColumn("quality", F.lit(0.5 if share is None else float(share)))
    weight, slope, offset = fitted(labelled, ratio, fit_rows, blocks)
    shared = docs.sparkSession.sparkContext.broadcast((ratio, weight))

    def scorer():
        ratio, weight = shared.value

        def score(batch: pa.RecordBatch) -> np.ndarray:
            out = np.zeros(len(batch))
            for low, high, row, bin_ in _batch_features(batch):
                out[low:high] = margins(row, bin_, high - low, ratio, weight)
            return out

        return score

    columns = [c for c in docs.columns if c != "quality"]
    margin = unused(columns, "_margin")
    scored = with_margins(docs.select(*columns), scorer, margin)
    return scored.select(*columns, probability(F.col(margin), slope, offset).alias("quality"))


def train_rows() -> Column:
    return fold("doc_id", 5) != 0


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = with_label(docs.where(train_rows()), table(spark, sf_dir, "labels"), "quality", "inner")
    return with_quality(docs, labelled).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= THRESHOLD).cast("int").alias("predicted"),
    )
