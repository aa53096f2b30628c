"""Language, toxicity and quality: held-out accuracy, and the parts against plain Python."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from edge import LONG, ODD, labels, none, odd
from pyspark.sql import functions as F

from millrace.llm import QUERIES, labelled, language, quality, tokens, toxicity

SMALL = "/root/testdata/sf0.01"


def plain_words(text):
    """Runs of letters, of digits and of signs, byte by byte."""
    out, last = [], 0
    for b in (text or "").encode():
        kind = tokens.KINDS[b]
        if kind and kind == last:
            out[-1] += bytes([b])
        elif kind:
            out.append(bytes([b]))
        last = kind
    return [w.lower() for w in out]


def words_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    return tokens.words(*tokens.text_column(batch, "text"), tokens.KINDS)


def test_words_are_the_same_in_windows_of_any_size(monkeypatch):
    texts = [t for _, t, *_ in ODD] + ["a1b2!? ÄÖ", "Ab aB", "", None, "end"]
    whole = words_of(texts)
    want = [(row, w) for row, t in enumerate(texts) for w in plain_words(t)]
    assert list(whole.row) == [row for row, _ in want]
    seen = {}
    for h, (_, w) in zip(whole.hash.tolist(), want):
        assert seen.setdefault(h, w) == w
    assert len(seen) == len({w for _, w in want})
    for window in (7, 64, 1000):
        monkeypatch.setattr(tokens, "WINDOW", window)
        again = words_of(texts)
        for name in ("hash", "row", "kind", "caps", "length"):
            assert np.array_equal(getattr(again, name), getattr(whole, name)), (window, name)


def test_slices_cover_all_rows():
    bounds = np.array([0, 0, 5, 5, 900, 905, 906])
    for most in (1, 6, 100, 10_000):
        found = list(tokens.slices(bounds, most))
        assert [i for i, _ in found] == [0] + [j for _, j in found[:-1]] and found[-1][1] == 6


def plain_grams(text):
    cleaned = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    padded = f" {cleaned} "
    return collections.Counter(
        g for n in (1, 2, 3) for i in range(len(padded) - n + 1) for g in [padded[i:i + n]]
        if (n < 3 and g.strip()) or (n == 3 and g[1] != " ")
    )


def test_grams_count_as_in_plain_python():
    for text in ("The  cat, the CAT!", "a", "ü 漢字 😀x", "x1y"):
        codes = collections.Counter(language.grams(language._letters(text)).tolist())
        assert sorted(codes.values()) == sorted(plain_grams(text).values())


def test_distance_is_out_of_place():
    profile = {"aa": language._counted(language.grams(language._letters("aba abab")))[0][:6], "bb": np.array([1, 2, 3])}
    lang, score = language.Ranker(profile, 6).best("aba ab")
    codes, counts = language._counted(language.grams(language._letters("aba ab")))
    order = [c for _, c in sorted(zip(-counts, codes))][:6]
    places = {c: i for i, c in enumerate(profile["aa"].tolist())}
    distance = sum(abs(i - places[c]) if c in places else 6 for i, c in enumerate(order))
    assert lang == "aa" and math.isclose(score, 1 - distance / (len(order) * 6))


def test_language_of_held_out_texts(spark):
    got = QUERIES["op5_language_id"](spark, SMALL)
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.98


def test_language_of_odd_rows(spark):
    found = language.profiles(odd(spark))
    got = language.with_language(odd(spark), found).collect()
    assert len(got) == len(ODD) and got[0]["kept"] == "s"
    by_text = {r["text"]: r for r in got}
    assert by_text[None]["lang_pred"] == by_text[""]["lang_pred"] == by_text["  \n\t "]["lang_pred"] == "und"
    assert by_text[LONG]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language.with_language(none(spark), found).count() == 0
    nothing = language.with_language(odd(spark), language.profiles(none(spark))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


def accuracy(spark, name, label, sf):
    got = QUERIES[name](spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max(label).alias("y"))
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    return got.join(truth, "doc_id").where("held_out").collect()


def ranked_right(rows):
    """Of pairs of a row with label 1 and one with 0, the share whose scores stand in that order."""
    ones, zeros = ([r["score"] for r in rows if r["y"] == y] for y in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


def test_quality_of_held_out_texts(spark):
    rows = accuracy(spark, "op8_quality", "quality", SMALL)
    assert ranked_right(rows) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] == r["y"] for r in rows]) > 0.95


def test_toxicity_of_held_out_texts(spark):
    # a few hundred labels, in four languages: order is what so few can give
    rows = accuracy(spark, "op2_toxicity", "toxic", SMALL)
    assert ranked_right(rows) > 0.65
    assert not any(r["predicted"] for r in rows if not r["y"])


def test_toxicity_finds_words_of_the_toxic_class(spark):
    ordinary = ["the garden is green and the river runs slow", "we walk along the harbour in the rain",
                "bread and butter on the wooden table", "a letter from the old teacher came today"]
    rows = [(i, f"{ordinary[i % 4]} {ordinary[(i * 7 + i // 4) % 4]}" + (" vile grommit" if i % 3 == 0 else "")) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows if i < 180], "doc_id long, toxic int")
    got = toxicity.with_toxicity(docs, docs, known, F.col("doc_id") < 180).where("doc_id >= 180").collect()
    assert all((r["toxicity"] >= 0.7) == (r["doc_id"] % 3 == 0) for r in got)


def plain_differences(texts, marks):
    """The two models, from the definitions."""
    order = toxicity.ORDER
    held = []
    for text in texts:
        letters = [c if tokens.KINDS[c] == 1 else 32 for c in text.lower().encode()]
        joined = [c for i, c in enumerate(letters) if c != 32 or (i and letters[i - 1] != 32)]
        padded = [32] * (order - 1) + [c for i, c in enumerate(joined) if c != 32 or i]
        held.append([bytes(padded[i - order + 1:i + 1]) for i in range(order - 1, len(padded))])
    seen = collections.Counter(g for h in held for g in h)
    toxic = collections.Counter(g for h, m in zip(held, marks) if m == 1 for g in h)
    ordinary = collections.Counter(g for h, m in zip(held, marks) if m == 0 for g in h)
    levels = {order: set(seen)}
    for size in range(order - 1, 0, -1):
        levels[size] = {g[1:] for g in levels[size + 1]}
    d = toxicity.DISCOUNT

    def shared(g):
        if not g:
            return 1 / toxicity.SYMBOLS
        continued = collections.Counter(x[1:] for x in levels[len(g) + 1])
        within = [c for s, c in continued.items() if s[:-1] == g[:-1]]
        return (continued[g] - d + d * len(within) * shared(g[1:])) / sum(within)

    def likelihood(counts, g):
        own = [c for s, c in counts.items() if s[:-1] == g[:-1]]
        left = d * len(own) / sum(own) if own else 1.0
        return (max(counts[g] - d, 0) / sum(own) if own else 0) + left * shared(g[1:])

    return {g: math.log(likelihood(toxic, g) / likelihood(ordinary, g)) for g in seen if toxic[g] + ordinary[g]}


def test_models_are_those_of_the_definitions(spark):
    texts = ["You fool, you!", "you two fools", "a cool pool", "A fool's pool", "cool, you", "École é"]
    marks = [1, 1, 0, 0, None, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = spark.createDataFrame([(i, m) for i, m in enumerate(marks) if m is not None], "doc_id long, toxic int")
    counts = toxicity.counted(docs, known, F.lit(True)).selectExpr("seq", "n", "t0 + t1 AS t", "o0 + o1 AS o")
    found = {r["bin"]: r["value"] for r in toxicity.differences(counts).where("kind = 0").collect()}
    want = plain_differences(texts, marks)
    assert len(want) == len(found)
    for g, value in want.items():
        assert math.isclose(found[int.from_bytes(g, "big") % toxicity.BINS], value, abs_tol=1e-5), g


@pytest.mark.parametrize("operator, column, name", [
    (lambda d, k: toxicity.with_toxicity(d, d, k, F.lit(True)), "toxicity", "toxic"),
    (lambda d, k: quality.with_quality(d, labelled.with_label(d, k, "quality", "inner")), "quality", "quality"),
])
def test_scores_of_odd_rows(spark, operator, column, name):
    some = labels(spark, name)
    got = operator(odd(spark), some).collect()
    assert len(got) == len(ODD) and all(0 <= r[column] <= 1 for r in got)
    assert operator(none(spark), some).count() == 0
    assert operator(odd(spark), some.limit(0)).count() == len(ODD)


def test_scores_of_rows_with_names_of_their_own(spark):
    docs = odd(spark).withColumns({c: F.lit(9) for c in ("_margin", "_digest", "_Margin_")})
    for scored, column in (
        (toxicity.with_toxicity(docs, docs, labels(spark, "toxic"), F.lit(True)), "toxicity"),
        (quality.with_quality(docs, labelled.with_label(docs, labels(spark, "quality"), "quality", "inner")), "quality"),
    ):
        assert scored.columns == [*docs.columns, column]
        assert all(r["_margin"] == r["_digest"] == r["_Margin_"] == 9 for r in scored.collect())


def test_margins_are_log_likelihoods_over_the_length(spark, monkeypatch):
    texts = ["you fool", "you fool you fool you fool", "a pool", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = spark.createDataFrame(
        [(0, int.from_bytes(b" fool", "big"), 2.0), (1, int.from_bytes(b"pool", "big") >> 8, 0.5),
         (1, int.from_bytes(b"    ", "big"), -1.0)], "kind int, bin long, value double",
    )
    # the first byte of a text follows four blanks, of which nothing but the left-over mass is known
    want = [1.0 / 8, 5.0 / 26, -1.0 / 6, 0, 0]
    for sent in (100, 0):
        monkeypatch.setattr(toxicity, "SENT", sent)
        rows = toxicity.with_difference(docs, found, "margin").orderBy("doc_id").collect()
        assert np.allclose([r["margin"] for r in rows], want), rows


def test_without_toxic_keeps_the_columns(spark):
    kept = toxicity.without_toxic(odd(spark), labels(spark, "toxic").limit(0))
    assert kept.columns == odd(spark).columns and kept.count() == len(ODD)


def test_log_count_ratios_and_descent(spark):
    texts = ["good fine good", "fine", "bad awful", "awful mess", "good mess"]
    marks = [1, 1, 0, 0, 1]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    row, bins = quality.features(*tokens.text_column(batch, "text"))
    docs = spark.createDataFrame([(t, m) for t, m in zip(texts, marks)], "text string, label int")
    ratio = quality.log_count_ratios(docs)
    counts = np.zeros((2, quality.BINS))
    for r, b in zip(row, bins):
        counts[marks[r], b] += 1
    share = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    assert np.allclose(ratio, np.log(share[1] / share[0]))
    held = [bins[row == i] for i in range(len(texts))]
    weight = quality.hinge_fit(held, np.array(marks), ratio, cost=10.0, epochs=500)
    margins = quality.margins(row, bins, len(texts), ratio, weight)
    assert all((m > 0) == (y == 1) for m, y in zip(margins, marks))
    # no small step from the optimum lowers the loss that the descent minimises
    y = np.where(np.array(marks) == 1, 1, -1)
    cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) * 10.0
    values = np.zeros((len(texts), len(weight)))
    for i, b in enumerate(held):
        values[i, np.append(b, quality.BINS)] = quality._scaled(ratio[b])
    loss = lambda w: w @ w / 2 + (cost * np.maximum(0, 1 - y * (values @ w))).sum()
    used, random = np.flatnonzero(values.any(axis=0)), np.random.default_rng(0)
    for _ in range(200):
        step = np.zeros(len(weight))
        step[used] = random.standard_normal(len(used)) * 1e-2
        assert loss(weight + step) > loss(weight) - 1e-3


def test_sigmoid_fits_shares():
    random = np.random.default_rng(2)
    x = random.standard_normal(4000)
    y = (random.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(int)
    slope, offset = labelled.sigmoid_fit(x, y)
    assert abs(slope - 2) < 0.25 and abs(offset + 1) < 0.2
    assert labelled.sigmoid_fit(np.array([0.0, 1.0]), np.array([1, 1]))[1] > 0
