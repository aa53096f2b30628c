"""Fill-in-the-middle against plain string work, and back."""

import hashlib
import random
import re

import numpy as np
import pytest
from edge import ODD, none, odd
from pyspark.sql import functions as F

from millrace.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text, seed=42, rate=50, share=80):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < share:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(df, rows, **settings):
    got = fill_middle.with_restored(fill_middle.with_fim(df, **settings)).collect()
    assert len(got) == len(rows)
    expected = sorted(str((i, t or "", *plainly(i, t, **{"share" if k == "spm_share" else k: v for k, v in settings.items()})))
                      for i, t in rows)
    assert sorted(str((r["doc_id"], r["restored"], *r["fim"])) for r in got) == expected


@pytest.mark.parametrize("window", [1 << 20, 3, 64])
def test_texts_of_all_sorts(spark, monkeypatch, window):
    monkeypatch.setattr(fill_middle, "WINDOW", window)
    random.seed(window)
    pool = ["a", " ", "\n", "é", "漢字", "<P", ">", "<S>", "word", "  ", "<M", "\x1c", "\xa0", "😀", "<", "P>"]
    rows = [(i, "".join(random.choices(pool, k=random.randint(0, 25)))) for i in range(600)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_all_forms_at_all_rates(spark):
    rows = [(i, f" unit{i} und so weiter, é {i} ") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, rows, rate=100, spm_share=0)
    check(df, rows, rate=100, spm_share=100, seed=7)
    check(df, rows, rate=0)
    forms = {r["form"] for r in fill_middle.with_fim(df).select("fim.form").collect()}
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in ODD]
    check(odd(spark), rows, rate=100)
    got = fill_middle.with_restored(fill_middle.with_fim(odd(spark), "N"), "N", "SCORE")
    assert got.columns[-2:] == ["N", "SCORE"] and "n" not in got.columns and "score" not in got.columns
    kept = [c for c in odd(spark).columns if c not in ("n", "score")]
    assert got.select(kept).exceptAll(odd(spark).select(kept)).count() == 0
    assert fill_middle.with_restored(fill_middle.with_fim(none(spark))).count() == 0


def test_columns_named_like_those_in_between(spark):
    df = odd(spark).withColumn("_output", F.lit(1)).withColumn("_form", F.lit(2))
    got = fill_middle.with_restored(fill_middle.with_fim(df))
    assert got.columns == [*df.columns, "fim", "restored"]
    assert {(r["_output"], r["_form"]) for r in got.collect()} == {(1, 2)}


def test_restoring_needs_output_and_form_only(spark):
    rows = [(None, "psm"), ("", "plain"), ("<P>a<S>c<M>b", "psm"), ("<S>c<P>a<M>b", "spm"), ("<P>a<S>c<M>b", "plain"), ("<P><S><M>", "psm"), ("x<P>", None)]
    df = spark.createDataFrame([((o, f),) for o, f in rows if o is not None], "fim struct<output:string,form:string>")
    got = [r["restored"] for r in fill_middle.with_restored(df).collect()]
    assert sorted(got) == sorted(["", "abc", "abc", "<P>a<S>c<M>b", "", "x<P>"])


def test_an_output_without_its_marks_is_an_error():
    data = np.frombuffer(b"<P>a<S>c", np.uint8)
    with pytest.raises(ValueError):
        fill_middle.whole_again(np.array([0, 8]), data, np.array([True]))


def test_shifts_are_differences_summed():
    starts, by = np.array([0, 4, 4, 9]), np.array([5, 1, -2, 7])
    got = np.concatenate([s for _, _, s in fill_middle.shifts(starts, by, 0, 12)])
    assert got.tolist() == [5] * 4 + [-2] * 5 + [7] * 3
