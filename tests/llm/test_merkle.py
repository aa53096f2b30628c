"""The manifest against trees built in full, one replaced leaf at a time."""

import hashlib
import random

import pytest
from edge import ODD, none, odd
from pyspark.sql import functions as F

from millrace.llm import merkle


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(level: list[str]) -> list[list[str]]:
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + 8]) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        begin = at - at % 8
        found += [d for i, d in enumerate(level[begin:begin + 8], begin) if i != at]
        at //= 8
    return found


def plainly(rows):
    """rows: (part, key, leaf, given); all trees are built anew for each row."""
    parts = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        parts.setdefault(row[0], []).append(row)
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: tree([r[2] for r in parts[p]]) for p in order}
    top = tree([trees[p][-1][0] for p in order])
    out = []
    for nth, part in enumerate(order):
        for at, (_, key, leaf, given) in enumerate(parts[part]):
            changed = [r[2] for r in parts[part]]
            changed[at] = given or leaf
            subroots = [trees[p][-1][0] for p in order]
            subroots[nth] = tree(changed)[-1][0]
            folded = tree(subroots)[-1][0]
            proof = h(*siblings(trees[part], at), *siblings(top, nth))
            out.append((key, leaf, trees[part][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def check(spark, rows, block, partitions=5):
    df = spark.createDataFrame(rows, "part string, key long, leaf string, given string").repartition(partitions)
    got = [tuple(r) for r in merkle.manifest(df, block).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plainly(rows)))


@pytest.mark.parametrize("block", [8, 64])
def test_parts_of_all_sizes(spark, block):
    random.seed(block)
    sizes = {"a": 1, "b": 7, "c": 8, "é": 9, "z": 64, None: 65, "": 130, "zz": 530}
    rows = []
    for part, size in sizes.items():
        keys = random.sample(range(-size, 3 * size), size)
        rows += [(part, k, h(str(k)), random.choice([None, h("x", str(k)), h(str(k))])) for k in keys]
    check(spark, rows, block)


def test_more_parts_than_one_run(spark):
    rows = [(f"p{i:03}", k, h(f"{i}-{k}"), h("other") if k == 0 else None) for i in range(75) for k in range(i % 4 + 1)]
    check(spark, rows, 8)


def test_repeated_keys_rows_and_missing_keys(spark):
    rows = [("a", 1, h("a"), None)] * 20 + [("a", 1, h("b"), h("c"))] * 3 + [("a", None, h("d"), h("e"))] * 9 + [(None, 1, h("a"), None)] * 2
    check(spark, rows, 8)
    check(spark, rows, merkle.BLOCK)


def test_one_row_and_none(spark):
    check(spark, [(None, None, h("x"), None)], 8)
    check(spark, [("a", 5, h("x"), h("y"))], 8)
    assert merkle.manifest(spark.createDataFrame([], "part string, key long, leaf string, given string")).count() == 0


def test_a_large_part_among_small_ones(spark):
    rows = [("big", k, h(str(k)), h("t", str(k)) if k % 50 == 0 else None) for k in range(1500)] + [("s", 1, h("1"), None)]
    check(spark, rows, 64, 16)


def test_folding_resumes_with_right_siblings_only(monkeypatch):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(100)]
    built = merkle.Subtree(digests)
    fed = []

    class Counting:
        def __init__(self, state):
            self.state = state

        def copy(self):
            return Counting(self.state.copy())

        def update(self, data):
            fed.append(data)
            self.state.update(data)

        def hexdigest(self):
            return self.state.hexdigest()

    built.states = [[Counting(s) for s in level] for level in built.states]
    whole = tree([d.hex() for d in digests])
    assert built.fold(13, digests[13].hex().encode()).decode() == whole[-1][0]
    # slot 5 of 8, then slot 1 of 8 (13 // 8 = 1), then slot 0 of 2
    assert [len(x) // merkle.HEX for x in fed] == [1, 2, 1, 6, 1, 1]


def test_leaves_tell_null_from_empty(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (None, "ä")], "a int, b string")
    got = [r[0] for r in df.select(merkle.leaf_digest([F.col("a"), F.col("b")])).collect()]
    assert got == [h("1:1-"), h("1:10:"), h("-2:ä")]


def test_odd_documents(spark):
    def leaf(row, text):
        values = [row[0], row[3], row[2], 4, text]
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def lower(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if text else text

    docs = odd(spark).withColumn("n_chars", F.lit(4)).withColumn("key", F.lit("clash")).withColumn("part", F.lit(9))
    got = merkle.documents_manifest(docs, F.lit(True), F.lower(F.lit("x"))).collect()
    assert len(got) == len(ODD)
    got = merkle.documents_manifest(docs, F.col("doc_id") > 6, F.translate("text", "STN", "stn")).collect()
    rows = [(r[2], r[0], leaf(r, r[1]), leaf(r, lower(r[1])) if r[0] is not None and r[0] > 6 else None) for r in ODD]
    rows = [(p, k, a, None if b is None else leaf_of(ODD, p, k, a, leaf)) for p, k, a, b in rows]
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, plainly(rows)))
    empty = none(spark).withColumn("n_chars", F.lit(4))
    assert merkle.documents_manifest(empty, F.lit(True), F.col("text")).count() == 0


def leaf_of(rows, part, key, digest, leaf):
    for row in rows:
        if (row[2], row[0]) == (part, key) and leaf(row, row[1]) == digest:
            return leaf(row, row[1].translate(str.maketrans("STN", "stn")))
    raise AssertionError


def test_upper_case_is_what_gives_tampering_away(spark):
    got = merkle.op11_merkle(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import zlib

    for r in got:
        touched = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in docs[r["doc_id"]] or "")
        assert r["verified"] == (not touched)
