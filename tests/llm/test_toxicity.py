"""Differences of exact sequences, sent to the tasks or joined."""

import random

import numpy as np
import pyarrow as pa
from edge import labels, odd
from pyspark.sql import functions as F

from millrace.llm import toxicity

SMALL = "/root/testdata/sf0.01"


def test_sequences_that_shared_a_bin_keep_their_own_differences(spark):
    apart = 4_194_301
    counts = spark.createDataFrame(
        [(i, 1, 1, 0) for i in (70_000, 70_001)] + [(i + apart, 9, 0, 9) for i in (70_000, 70_001)],
        "seq long, n long, t long, o long",
    )
    rows = toxicity.differences(counts).where("kind = 0").collect()
    value = {r["bin"]: r["value"] for r in rows}
    assert len(rows) == 4
    assert all(value[i] > 0 > value[i + apart] for i in (70_000, 70_001))


def test_joined_differences_give_the_scores_of_sent_ones(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 4 = 0").select("doc_id", "text")
    marks = spark.read.parquet(f"{SMALL}/labels.parquet")
    for rows, known in ((docs, marks), (odd(spark), labels(spark, "toxic"))):
        scored = []
        for sent in (4_000_000, 0):
            monkeypatch.setattr(toxicity, "SENT", sent)
            got = toxicity.with_toxicity(rows, rows, known, F.lit(True)).collect()
            scored.append(sorted((str(r["doc_id"]), r["text"] or "", r["toxicity"]) for r in got))
        far = max(abs(a[2] - b[2]) for a, b in zip(*scored))
        assert scored[0] == scored[1], far
        assert len(scored[0]) == rows.count()


def test_sequences_are_added_up_before_they_are_many(monkeypatch):
    """Repeats of a few texts are held as little more than their distinct sequences, and counted in full."""
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(3000))
    rows = pa.RecordBatch.from_arrays([pa.array([text] * 40), pa.array([1] * 40, pa.int32())], ["text", "part"])
    largest = []
    keep = np.concatenate
    monkeypatch.setattr(toxicity, "SLICE", len(text))
    monkeypatch.setattr(toxicity, "FOLDED", 1 << 10)
    whole = pa.Table.from_batches(toxicity._count(iter([rows])))
    monkeypatch.setattr(np, "concatenate", lambda x, *a, **k: largest.append(sum(map(len, x))) or keep(x, *a, **k))
    again = pa.Table.from_batches(toxicity._count(iter([rows])))
    assert whole.equals(again) and whole.column("n").to_pylist().count(40) > 0
    distinct = len(whole)
    assert max(largest) <= max(3 * distinct + (1 << 10), 2 * (len(text) + 4))


def test_what_both_models_end_in_is_found_once(spark, monkeypatch):
    whole, found = toxicity._shared, []
    monkeypatch.setattr(toxicity, "_shared", lambda ends, size: found.append(size) or whole(ends, size))
    got = toxicity.with_toxicity(odd(spark), odd(spark), labels(spark, "toxic"), F.lit(True))
    assert got.count() == odd(spark).count() and found.count(toxicity.ORDER - 1) == 1
    counts = spark.createDataFrame([(s, 1 + s % 3, s % 2, s % 3) for s in range(0, 90_000, 77)], "seq long, n long, t long, o long")
    rows = lambda shared: sorted(map(tuple, toxicity.differences(counts, shared).collect()))
    assert rows(toxicity.shared_model(counts)) == rows(None)
