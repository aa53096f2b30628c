"""Queries whose nearest lists are small."""

import collections

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import neighbours


def test_every_query_has_all_its_rows_where_lists_are_small(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 8)
    monkeypatch.setattr(neighbours, "RECALL", 0.05)
    random = np.random.default_rng(4)
    hot = random.normal(0, 0.01, (300, 6)) + np.eye(6)[0]
    vectors = np.concatenate((hot, random.normal(0, 1, (60, 6))))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    for some, want in ((rows, 20), (rows[295:310], 14)):
        docs = spark.createDataFrame(some, "vec_id long, embedding array<double>")
        got = collections.Counter(r["query_id"] for r in neighbours.nearest(docs, F.lit(True)).collect())
        assert got == {i: want for i, _ in some}
