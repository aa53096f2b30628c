"""The mix at true weights, with every source on its own, against plain Python with fractions."""

import collections
import functools
import hashlib
import random
from fractions import Fraction

import numpy as np
from edge import none, odd

import corpus_pipeline
from millrace.llm import mixing

SMALL = "/root/testdata/sf0.01"


def furthest_off(blocks, weights, order):
    """The most blocks that any source is ever away from its due at the weights as given."""
    given, due = np.zeros(len(blocks)), np.zeros(len(blocks))
    weights, n, most = np.array(weights), np.array(blocks, float), 0.0
    for s in order:
        left = 1.0
        while left > 1e-12:
            active = np.where(due < n - 1e-9, weights, 0)
            if not active.any():
                break
            ends = (n - due)[active > 0] / weights[active > 0]
            step = min(left / active.sum(), ends.min())
            due += active * step
            left -= active.sum() * step
        given[s] += 1
        most = max(most, np.abs(given - due).max())
    return most


def by_definition(blocks, weights):
    """Earliest deadline first, release times and deadlines from the due in fractions."""
    weights = [Fraction(w) for w in weights]

    @functools.cache
    def reached(s, k):
        return sum(min(Fraction(n), w * k / weights[s]) for n, w in zip(blocks, weights))

    given, out = [0] * len(blocks), []
    for slot in range(sum(blocks)):
        ready = [s for s, n in enumerate(blocks) if given[s] < n and reached(s, given[s]) // 1 <= slot]
        out.append(min(ready, key=lambda s: (-(-reached(s, given[s] + 1) // 1), s)))
        given[out[-1]] += 1
        assert -(-reached(out[-1], given[out[-1]]) // 1) > slot, "deadline missed"
    return out


def test_slots_are_those_of_the_definition():
    random.seed(8)
    for _ in range(40):
        count = random.randint(1, 9)
        blocks = [random.choice([0, 1, 2, 7, 7, 40]) for _ in range(count)]
        weights = [random.choice([1.0, 2.0, 0.1, 3.0, random.random() + 0.01]) for _ in range(count)]
        found = list(mixing.schedule(blocks, weights))
        assert [s for s, _ in found] == by_definition(blocks, weights)
        for s, n in enumerate(blocks):
            assert [k for x, k in found if x == s] == list(range(n))


def test_sources_stay_within_a_block_of_unrounded_weights_however_long_the_input():
    rows = [2_000_000 // 40] + [random.Random(i).randint(40_000, 298_000) // 40 for i in range(20)]
    blocks, weights = [-(-n // 4) for n in rows], [n ** 0.5 for n in rows]
    assert furthest_off(blocks, weights, [s for s, _ in mixing.schedule(blocks, weights)]) < 1 + 1e-6
    # and with weights far below one block in 256
    blocks, weights = [30_000, 40, 3], [1.0, 0.0013, 0.00011]
    assert furthest_off(blocks, weights, [s for s, _ in mixing.schedule(blocks, weights)]) < 1 + 1e-6


def test_each_of_300_sources_has_its_own_blocks_and_stays_within_one(spark):
    names = [None, "", *(f"feed{i}" for i in range(298))]
    rows = [(i, names[i % 7 if i % 3 else i // 3 % 300]) for i in range(6000)]
    got = mixing.interleaved(spark.createDataFrame(rows, "doc_id long, source string")).collect()
    assert len(got) == len(rows) and all(r["mix_source"] == r["source"] for r in got)
    counts = collections.Counter(s for _, s in rows)
    assert len(counts) == 300
    keys = sorted(counts, key=lambda s: (s is not None, s or ""))
    blocks = [-(-counts[s] // 4) for s in keys]
    order = {}
    for r in got:
        assert order.setdefault(r["slot"], r["source"]) == r["source"]
    assert sorted(order) == list(range(sum(blocks)))
    at = [keys.index(order[slot]) for slot in range(len(order))]
    weights = [counts[s] ** 0.5 for s in keys]
    assert at == by_definition(blocks, weights)
    assert furthest_off(blocks, weights, at) < 1 + 1e-6


def plain_mix(rows):
    """doc_id of (doc_id, source) rows in the order of the mix."""
    members = collections.defaultdict(list)
    for doc_id, source in rows:
        members[source].append(doc_id)
    keys = sorted(members, key=lambda s: (s is not None, s or ""))
    for s in keys:
        members[s].sort(key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    blocks, weights = [-(-len(members[s]) // 4) for s in keys], [len(members[s]) ** 0.5 for s in keys]
    given, out = [0] * len(keys), []
    for s in by_definition(blocks, weights):
        out += members[keys[s]][4 * given[s]:4 * given[s] + 4]
        given[s] += 1
    return out


def test_rows_of_the_query_stand_where_a_plain_run_puts_them(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 100)
    monkeypatch.setattr(mixing, "PART_ROWS", 20)
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source").collect()]
    got = sorted(mixing.op1_mixing(spark, SMALL).collect(), key=lambda r: r["position"])
    assert [r["doc_id"] for r in got] == plain_mix(rows)
    assert all(r["position"] == 4 * r["slot"] + r["place"] for r in got)


def test_the_pipeline_returns_its_rows_in_the_order_of_the_mix(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 3 = 0")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    # several files, which Spark reads largest first
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain_mix([tuple(r) for r in docs.select("doc_id", "source").collect()])


def test_the_last_stage_shows_the_order_that_the_mix_wrote(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 3 = 0")
    want = plain_mix([tuple(r) for r in docs.select("doc_id", "source").collect()])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    stages = corpus_pipeline.STAGES[3:]
    for kept, mixed in ((stages, True), (stages[1:], False)):
        monkeypatch.setattr(corpus_pipeline, "STAGES", kept)
        rows = sorted(corpus_pipeline.run(spark, SMALL).select("position", "doc_id").collect())
        assert ([r["doc_id"] for r in rows] == want) is mixed and len(rows) == len(want)
        assert not mixed or [r["position"] for r in rows] == list(range(len(want)))


def test_columns_named_like_those_of_the_mix_come_through(spark):
    docs = odd(spark)
    assert sorted(map(str, mixing.in_mix_order(docs).collect())) == sorted(map(str, docs.collect()))
    assert mixing.interleaved(docs).select("slot", "place").distinct().count() == docs.count()
    assert mixing.interleaved(none(spark)).count() == 0
