"""Near copies and nearest vectors against brute force."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from edge import ODD, none, odd
from pyspark.sql import functions as F

from millrace.llm import QUERIES, jaccard_join, neighbours
from millrace.llm.links import components

SMALL = "/root/testdata/sf0.01"


def shingles(text, width):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def plain_groups(rows, width, percent):
    """doc_id -> smallest doc_id reachable, over all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(set)
    for n, (_, s) in enumerate(sets):
        for x in s:
            holders[x].add(n)
    for n, (i, s) in enumerate(sets):
        for m in set().union(*(holders[x] for x in s)) if s else ():
            j, t = sets[m]
            if m < n and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i, _ in rows}


def test_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op6_jaccard_join"](spark, SMALL).collect()}
    want = plain_groups(rows, 3, 90)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(shingles(t, 3)) for i, t in rows)


@pytest.mark.parametrize("seed, width, percent, block", [(1, 3, 90, 1024), (2, 5, 80, 7), (3, 1, 60, 16)])
def test_chains_of_edits_in_blocks_of_any_size(spark, monkeypatch, seed, width, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "PAIRED", 4)
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(6):
        words = random.choices(vocabulary, k=random.choice([4, 12, 40, 90]))
        for _ in range(25):
            rows.append((len(rows) * 3 + 1, " ".join(words)))
            for _ in range(random.choice([0, 1, 1, 2])):
                words[random.randrange(len(words))] = random.choice(vocabulary)
    random.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(docs, width, percent).collect()}
    assert got == plain_groups(rows, width, percent)


def test_sketches_never_differ_in_more_bits_than_sets_do_in_shingles():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.integers(0, 1 << 63, rng.integers(1, 80), dtype=np.uint64)
        b = np.unique(np.concatenate((a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 20), dtype=np.uint64))))
        a, count = np.unique(a), int(rng.integers(1, 9))
        apart = np.bitwise_count(jaccard_join.sketch(a, count, 3) ^ jaccard_join.sketch(b, count, 3)).sum()
        assert apart <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_linked_sizes_share_a_band_with_words_enough(percent):
    for small in range(1, 400):
        for large in range(small, small * 100 // percent + 1):
            shared = set(jaccard_join.bands(small, percent)) & set(jaccard_join.bands(large, percent))
            differ = jaccard_join.differing(small + large, percent)
            assert any(count > differ + spare + extra for _, count, spare, extra in shared), (small, large)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_have_words_enough_in_common(percent):
    rng = np.random.default_rng(percent)
    for _ in range(400):
        a = rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64)
        gone, new = rng.integers(0, len(a) // 4 + 1), rng.integers(0, len(a) // 4 + 1)
        b = np.concatenate((a[gone:], rng.integers(0, 1 << 63, new, dtype=np.uint64)))
        if 100 * (len(a) - gone) < percent * (len(a) + new):
            continue
        enough = []
        for band in set(jaccard_join.bands(len(a), percent)) & set(jaccard_join.bands(len(b), percent)):
            common = np.intersect1d(jaccard_join.key_words(a, *band), jaccard_join.key_words(b, *band))
            enough.append(len(common) > band[3] and (band[3] > 0 or np.all(common & np.uint64(1))))
        assert any(enough)


def test_odd_rows(spark):
    got = jaccard_join.similar_groups(odd(spark), 3, 90).collect()
    assert len(got) == len(ODD)
    found = {r["doc_id"]: r["component_id"] for r in got}
    assert found[7] == found[8] == found[-11] == -11
    assert found[1] == 1 and found[2] == 2 and found[3] == 3 and found[None] is None and found[10] == 10
    assert {r["doc_id"]: r["n_shingles"] for r in got}[10] == 1
    assert jaccard_join.similar_groups(none(spark)).count() == 0


def test_one_doc_id_with_two_texts_is_one_document(spark):
    a, b = "one two three four", "five six seven eight"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard_join.similar_groups(docs, 3, 90).collect()} == {1}


def test_first_of_each_group_stays(spark):
    kept = jaccard_join.keep_first(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "None", "5", "6", "9", "10", "-11"])


def test_components_of_chains_and_stars(spark):
    random.seed(9)
    pairs = [(i, i + 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (7001, 7000)]
    names = list(range(8000))
    random.shuffle(names)
    edges = spark.createDataFrame([(names[a], names[b]) for a, b in pairs], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    for part in (range(1, 201), range(1000, 1300), (7000, 7001)):
        assert {got[names[i]] for i in part} == {min(names[i] for i in part)}
    assert names[5000] not in got and components(edges.limit(0)).count() == 0


def plain_nearest(vectors, ids, query, k):
    at = int(np.flatnonzero(ids == query)[0])
    score = (vectors * vectors[at]).sum(axis=1)
    others = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:k]
    return [(int(ids[i]), float(score[i])) for i in others]


def recall(found, vectors, ids, k):
    hits = total = 0
    by_query = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query[r["query_id"]].append((r["vec_id"], r["score"]))
    for query, rows in by_query.items():
        want = plain_nearest(vectors, ids, query, k)
        scores = dict(plain_nearest(vectors, ids, query, len(ids)))
        assert all(scores[i] == s for i, s in rows)
        assert rows == sorted(rows, key=lambda x: (-x[1], x[0]))
        hits, total = hits + len({i for i, _ in want} & {i for i, _ in rows}), total + len(want)
    return hits / total, len(by_query)


def test_small_vectors(spark):
    found = QUERIES["op7_neighbours"](spark, SMALL).collect()
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    share, queries = recall(found, np.array([r["embedding"] for r in rows], float), ids, 20)
    assert share >= 0.95 and queries == (ids % 20 == 0).sum()


@pytest.mark.parametrize("unit", [True, False])
def test_clustered_vectors_in_many_lists(spark, monkeypatch, unit):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "CHUNK_QUERIES", 16)
    rng = np.random.default_rng(11)
    centers = rng.standard_normal((12, 40)) * 3
    own = np.where(rng.random(1500) < 0.4, 0, rng.integers(0, 12, 1500))
    vectors = (centers[own] + rng.standard_normal((1500, 40))).astype(np.float32)
    vectors[700:720] = vectors[700]
    if unit:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20).collect()
    share, queries = recall(found, vectors.astype(float), np.arange(1500), 20)
    assert share >= 0.9 and queries == 75


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (20, [1.0, 1.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]),
        (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, [1.0]), (None, [9.0, 9.0]), (9, []),
        (40, [0.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted(tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 1.0), (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 0, 1.0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_crowded_words_are_compared_in_queries_of_their_own(spark, monkeypatch):
    """Near copies of one text, more than are paired up: the same groups in one query or several, each of which is written."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(base[:58] + [f"x{i}", f"y{i}"]) for i in range(40)]
    far = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.random()) for _ in range(40)) for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(near + far)), "doc_id long, text string")
    groups = lambda: {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(docs, 3, 90).collect()}
    whole = groups()
    assert {whole[i] for i in range(40)} == {0} and all(whole[i] == i for i in range(40, 50))
    written = []
    keep = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, purpose: written.append(purpose) or keep(df, purpose))
    monkeypatch.setattr(jaccard_join, "CROWD_ROWS", 1)
    assert groups() == whole
    assert written.count("ties") == 1 + jaccard_join.CROWD_PARTS


def test_second_sketches_tell_large_sets_apart():
    """Sets with nothing in common keep no bound, however large; linked ones do, their sketches of one size or two."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for n in (300, 1500, 1600, 3000, 3100, 12000, 12500)]
    sets.append(np.concatenate([sets[2], np.unique(rng.integers(0, 1 << 64, 200, np.uint64))]))
    sketches = [jaccard_join.sketch(s, jaccard_join.plain_words(len(s), 80), 1) for s in sets]
    assert len(sketches[2]) < len(sketches[-1])
    assert (jaccard_join.fold(sketches[-1], 16) == jaccard_join.sketch(sets[-1], 16, 1)).all()
    found = jaccard_join.connect(np.array([len(s) for s in sets]), sketches, None, np.zeros(len(sets), int), False, 80)
    assert found == [(2, 7)]


def test_words_are_equal_by_shingles_in_common_only():
    """Sets with nothing in common agree in no word but an empty one, however many there are, and hardly any set enters an empty one."""
    rng = np.random.default_rng(6)
    for size in (1, 30, 90):
        held = jaccard_join.Sets([np.unique(rng.integers(0, 1 << 63, size, np.uint64)) for _ in range(6000)])
        for band in jaccard_join._entered(size, 80):
            columns = np.repeat([band], 6000, axis=0).T
            keys = held.key_words(np.arange(6000), *columns)
            often = np.unique(keys, return_counts=True)[1]
            assert len(keys) == 6000 * band[2] and often[often > 1].sum() < 6000 / 200


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 60)])
def test_entered_words_are_enough_for_linked_sets_of_all_sizes(width, percent):
    """A set enters fewer words than its sketch has; linked ones have more than are extra in common in a band."""
    rng = np.random.default_rng(width)
    for _ in range(400):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64))
        shared = rng.integers(-(-len(a) * percent // 100), len(a) + 1)
        new = rng.integers(0, (100 * shared - percent * len(a)) // percent + 1)
        b = np.unique(np.concatenate((a[:shared], rng.integers(0, 1 << 63, new, dtype=np.uint64))))
        enough = []
        for x in jaccard_join._entered(len(a), percent):
            for y in jaccard_join._entered(len(b), percent):
                if x[:2] == y[:2]:
                    keys = [jaccard_join.Sets([s]).key_words(np.zeros(1, int), *np.array([band]).T) for s, band in ((a, x), (b, y))]
                    enough.append(len(np.intersect1d(*keys)) > x[3])
        assert any(enough)


def test_sets_worked_on_at_once_are_those_worked_on_alone(monkeypatch):
    """Marks, second sketches and words of sets, empty ones among them, and of rows in slices of any size."""
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for n in (0, 3, 40, 0, 0, 200, 1, 0)]
    held = jaccard_join.Sets(sets)
    alone = [jaccard_join.Sets([s]) for s in sets]
    assert [list(m) for m in held.marks()] == [[int(s.marks()[i][0]) for s in alone] for i in (0, 1)]
    count = np.array([8, 8, 16, 8, 8, 32, 8, 8])
    assert (held.sketches(count, 1) == np.concatenate([jaccard_join.sketch(s, n, 1) for s, n in zip(sets, count)])).all()
    texts = ["", "a b c d e f", None, "a A", "x", " ".join(str(i % 50) for i in range(300)), "a b c d e f"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    whole = [s.tolist() for part in jaccard_join._sets(batch, 3) for s in part]
    assert list(map(len, whole)) == [len(shingles(t, 3)) for t in texts] and whole[1] == whole[6] == sorted(whole[1])
    monkeypatch.setattr(jaccard_join, "SETS_BYTES", 1)
    assert [s.tolist() for part in jaccard_join._sets(batch, 3) for s in part] == whole


@pytest.mark.parametrize("paired", [1, 16])
def test_large_texts_with_a_passage_in_common_are_no_candidates(spark, monkeypatch, paired):
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(1500)]
    texts = [passage + [f"w{rng.random()}" for _ in range(2500)] for _ in range(4)]
    texts += [passage, passage + [f"x{i}" for i in range(300)]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    described = jaccard_join._described(docs, 5, 80)
    ties = jaccard_join._ties(jaccard_join._entries(docs, 5, 80), described, 80)
    of = {r["one"]: r["doc_id"] for r in described.collect()}
    assert {tuple(sorted((of[r["a"]], of[r["b"]]))) for r in ties.collect()} == {(4, 5)}


def test_sets_of_a_group_are_compared_at_once(monkeypatch):
    """The same pairs as one by one, in few steps; also if few words at once are allowed."""
    random, calls = np.random.default_rng(8), []
    bits = np.bitwise_count
    monkeypatch.setattr(jaccard_join.np, "bitwise_count", lambda x: calls.append(x.size) or bits(x))
    bases = [np.unique(random.integers(0, 1 << 62, 150 * k, dtype=np.uint64)) for k in range(1, 9)]
    sets = [b[random.random(len(b)) > random.choice([0, 0.03, 0.1])] for b in bases for _ in range(8)]
    size, side = np.array([len(s) for s in sets]), random.integers(0, 2, len(sets))
    sketches = [jaccard_join.sketch(s, jaccard_join.plain_words(len(s), 80), 1) for s in sets]
    for crossed in (False, True):
        calls.clear()
        found = jaccard_join.connect(size, sketches, sets, side, crossed, 80)
        assert len(calls) < len(sets) // 2
        monkeypatch.setattr(jaccard_join, "AT_ONCE", 1)
        assert jaccard_join.connect(size, sketches, sets, side, crossed, 80) == found
        monkeypatch.setattr(jaccard_join, "AT_ONCE", 1 << 15)
        group = list(range(len(sets)))
        for i, j in found:
            assert jaccard_join._similar(sets[i], sets[j], 80) and group[i] != group[j] and (not crossed or side[i] != side[j])
            group = [group[j] if g == group[i] else g for g in group]
        for i in range(len(sets)):
            for j in range(i):
                if jaccard_join._similar(sets[i], sets[j], 80) and (not crossed or side[i] != side[j]):
                    assert group[i] == group[j]
