"""Exact dedup, sharding and mixing against plain Python and SQL."""

import collections
import hashlib
import random

import pytest
from edge import ODD, none, odd
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, mixing, sharding
from millrace.llm.common import with_group
from oracle import duck

SMALL = "/root/testdata/sf0.01"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected_groups(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = max(real) if real else None
        for nth, doc_id in enumerate(sorted(ids, key=lambda i: i is not None and i == keep, reverse=True)):
            out.append((doc_id, keep, len(ids), doc_id == keep and nth == 0, hashlib.sha256(text.encode()).hexdigest()))
    return collections.Counter(out)


def got_groups(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_odd_rows_form_their_groups(spark):
    assert got_groups(exact_dedup.exact_groups(odd(spark))) == expected_groups([r[:2] for r in ODD])


def test_chunk_hashes_that_clash_are_told_apart(spark):
    texts = ["a. " * 400 + end for end in ("one", "two", "six", "ONE", "one")] + ["b! " * 400 + "one", None, ""]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weak = exact_dedup.exact_groups(docs, lambda chunk: F.length(chunk).cast("long"))
    assert got_groups(weak) == expected_groups(rows)


def test_chunks_put_together_are_the_text(spark):
    row = odd(spark).where("doc_id = 5").select(exact_dedup.chunks(F.col("text")).alias("c")).first()
    assert "".join(row["c"]) == ODD[4][1] and max(map(len, row["c"])) <= exact_dedup.HIGH


def test_dropping_copies_keeps_one_row_with_all_columns(spark):
    kept = exact_dedup.drop_copies(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["2", "3", "None", "5", "6", "8", "9", "10"])


@pytest.mark.parametrize("operator", [exact_dedup.exact_groups, exact_dedup.drop_copies])
def test_dedup_of_nothing(spark, operator):
    assert operator(none(spark)).count() == 0


def test_a_group_looked_up_in_parts_has_its_totals(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = with_group(df, ["k"], ["id"], {"p": F.count(F.lit(1))}, {"n": F.sum("p")})
    assert got.count() == 5000
    assert got.where("n <> CASE WHEN k = 0 THEN 1667 ELSE 1 END").count() == 0


@pytest.mark.parametrize("limit", [20_000, 200_000])
def test_shards_match_the_sql(spark, limit):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(
        "doc_id", sharding.text_bytes(F.col("text")).alias("bytes")
    )
    got = sharding.shard(docs, F.col("bytes"), ["doc_id"], limit)
    columns = ["doc_id", "bytes", "shard", "shard_depth", "shard_bytes", "shard_rows"]
    sql = f"SELECT {', '.join(columns)} FROM ({sharding.SHARD_SQL.format(limit=limit)}) x"
    want = {r[0]: r for r in duck(SMALL).execute(sql).fetchall()}
    fitting = {r["doc_id"]: tuple(r) for r in got.select(*columns).collect() if r["bytes"] <= limit}
    assert fitting == {k: r for k, r in want.items() if r[1] <= limit}
    assert got.count() == docs.count()
    assert len({r[2] for r in fitting.values()}) > 5


def test_hot_key_and_equal_rows_are_split_to_the_limit(spark):
    rows = [("hot", i, "x" * 10) for i in range(300)] + [("twin", 0, "y" * 10)] * 100 + [("cold", 1, None)] + [("big", 2, "z" * 500)]
    docs = spark.createDataFrame(rows, "k string, i int, t string")
    got = sharding.shard(docs, sharding.text_bytes(F.col("t")), ["k"], 100)
    shards = got.groupBy("shard").agg(
        F.sum(sharding.text_bytes(F.col("t"))).alias("bytes"), F.count(F.lit(1)).alias("rows"),
        F.max("shard_bytes").alias("said"), F.max("shard_rows").alias("said_rows"),
    ).collect()
    assert all(s["bytes"] == s["said"] and s["rows"] == s["said_rows"] for s in shards)
    assert all(s["bytes"] <= 100 or s["rows"] == 1 for s in shards)
    assert got.count() == len(rows) and sorted(map(str, got.select("k", "i", "t").collect())) == sorted(map(str, docs.collect()))


def test_shards_of_odd_rows_and_of_nothing(spark):
    got = sharding.shard(odd(spark), sharding.text_bytes(F.col("text")), ["doc_id"], 1000)
    assert got.count() == len(ODD)
    assert sharding.shard(none(spark), sharding.text_bytes(F.col("text")), ["doc_id"], 1000).count() == 0
    named = odd(spark).withColumns({c: F.lit(9) for c in ("_row", "_path", "_cell", "_bytes", "a.b")})
    same = sharding.shard(named, sharding.text_bytes(F.col("text")), ["doc_id"], 1000)
    assert same.columns == [*(c for c in named.columns if c != "shard"), "shard", "shard_depth", "shard_bytes", "shard_rows"]
    assert all(r["_row"] == r["_path"] == r["_cell"] == r["_bytes"] == r["a.b"] == 9 for r in same.collect())


def test_written_shards_come_back(spark, tmp_path):
    docs = odd(spark).select("doc_id", "text")
    sharding.write_shards(sharding.shard(docs, sharding.text_bytes(F.col("text")), ["doc_id"], 1000), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(ODD)


def test_mix_of_odd_rows_keeps_them_and_of_nothing_is_nothing(spark):
    for docs, n in ((odd(spark), len(ODD)), (none(spark), 0)):
        got = mixing.interleaved(docs)
        assert got.count() == n
        assert got.select("slot", "place").distinct().count() == n
        ordered = mixing.in_mix_order(docs)
        assert ordered.columns == docs.columns and ordered.count() == n


def test_parts_of_a_source_do_not_change_the_order(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source")
    whole = mixing.interleaved(docs).collect()
    monkeypatch.setattr(mixing, "PART_ROWS", 10)
    assert sorted(whole) == sorted(mixing.interleaved(docs).collect())


def test_the_mix_bears_any_column_name(spark):
    names = ["mix_name", "_digest", "_part", "_nth", "_row", "_key", "_hash", "_index", "rows"]
    docs = spark.createDataFrame([(i, f"s{i % 3}", str(i)) for i in range(40)], "doc_id long, source string, text string")
    for name in names:
        docs = docs.withColumn(name, F.col("doc_id"))
    got = mixing.interleaved(docs)
    assert got.columns == [*docs.columns, "mix_source", "block", "slot", "place"]
    assert sorted(tuple(r)[0:1] + tuple(r)[3:12] for r in got.collect()) == [(i,) * 10 for i in range(40)]


def test_dropping_copies_bears_any_column_name_and_is_settled(spark):
    rows = [(1, "Same", 1), (1, "same", 2), (1, "SAME", 3), (2, "other", 4), (None, "x", 5), (3, "other", 6)]
    names = ["_sha", "_kept", "_kept_sha", "row", "id", "sha", "written", "kept_id"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    for name in names:
        docs = docs.withColumn(name, F.col("n"))
    for parts in (1, 5):
        got = exact_dedup.drop_copies(docs.repartition(parts))
        assert got.columns == docs.columns
        assert sorted((r["text"], *(r[n] for n in names)) for r in got.collect()) == [
            ("other", *[6] * 8), ("same", *[2] * 8), ("x", *[5] * 8)]


def test_kept_rows_are_not_moved_again_for_their_group(spark):
    """Rows are looked up and grouped by one key, NULL included, in one shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(None, "a", "x"), (None, "A", "y"), (1, "b", "z"), (1, "b", "z"), (2, "B", "z")], "doc_id long, text string, source string")
        kept = exact_dedup.drop_copies(docs)
        assert sorted(map(str, kept.collect())) == sorted(map(str, [docs.collect()[0], docs.collect()[4]]))
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        joined = kept._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi" in plan
        before_join = joined[:joined.index("LeftSemi")]
        assert "Exchange" not in before_join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("part_rows", [3, 20_000])
def test_rows_find_their_slots_with_their_part(spark, monkeypatch, part_rows):
    """Blocks that lie across parts have one slot, and rows move for their part alone."""
    monkeypatch.setattr(mixing, "PART_ROWS", part_rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.range(301).selectExpr("id AS doc_id", "IF(id % 3 = 0, NULL, concat('s', id % 7)) AS source")
        mixed = mixing.interleaved(docs)
        rows = mixed.collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(301))
        assert len({(r["slot"], r["place"]) for r in rows}) == 301
        slots = {(r["mix_source"], r["block"]): r["slot"] for r in rows}
        assert sorted(slots.values()) == list(range(len(slots)))
        assert all(slots[r["mix_source"], r["block"]] == r["slot"] for r in rows)
        plan = mixed._jdf.queryExecution().executedPlan().toString()
        last_join = plan[plan.index("SortMergeJoin"):].splitlines()[0]
        assert "_part#" in last_join and "block#" not in last_join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
