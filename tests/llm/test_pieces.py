"""Piece ids against the library and against plain merging, and back to texts."""

import random

import numpy as np
import pytest
from edge import ODD, none, odd

from millrace.llm import pieces

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.vocabulary())


def merged(codec, text):
    """All merges one after the other, over the whole text."""
    symbols = list(pieces.BLANK + text.replace(" ", pieces.BLANK)) if text else []
    while True:
        scores = [codec.scores.get(a + b) for a, b in zip(symbols, symbols[1:])]
        known = [s for s in scores if s is not None]
        if not known:
            break
        at = scores.index(max(known))
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
    return [i for s in symbols for i in ([codec.pieces[s]] if s in codec.pieces else [codec.of_byte[b] for b in s.encode()])]


TEXTS = ["", " ", "  ", "a", "Hello  world ", "\n", " \n ", "\n\n x\t y\r\n", "x \n y\n  z", "aaaa aaaaaaa", "é漢字😀ﬁ \x00",
         "tttththththe", "http://aa.bb/cc?d=eee&f=%20", "日本語のテキスト"]


def test_ids_are_those_of_merging(codec):
    random.seed(3)
    alphabet = "aeinrst th\n▁é漢"
    texts = TEXTS + ["".join(random.choices(alphabet, k=random.randint(1, 60))) for _ in range(300)]
    for text in texts:
        plain = text.replace(pieces.BLANK, " ")
        assert np.frombuffer(codec.encode(text), np.int32).tolist() == merged(codec, plain), text
        assert codec.decode(np.frombuffer(codec.encode(text), np.int32)).decode() == plain


def test_ids_are_those_of_the_library(codec, spark):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(300).collect()]
    texts += ["日本語のテキスト" * 400, "x" * 5000, "ab" * 3000]
    for text in texts:
        assert np.frombuffer(codec.encode(text), np.int32).tolist() == library.encode(text), text[:60]


def test_long_words_leave_in_parts_from_a_bounded_window(codec):
    random.seed(4)
    text = "".join(random.choices("abcdeilnorst", k=60_000))
    parts = list(codec.stream(pieces.BLANK + text))
    assert len(parts) > 500 and max(map(len, parts)) < 40 * codec.longest
    assert [i for p in parts for i in p] == np.frombuffer(codec.encode(text), np.int32).tolist()
    assert codec.decode(np.array([i for p in parts for i in p])).decode() == text


def test_special_and_unknown_ids_have_no_text(codec):
    assert codec.decode(np.array([1, *codec_ids(codec, "hi"), 2])).decode() == "hi"
    assert codec.decode(np.zeros(0, np.int64)) == b""


def codec_ids(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def test_memory_of_words_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    small = pieces.Codec(pieces.vocabulary())
    for i in range(300):
        assert small.encode(f"word{i} other{i}") == codec.encode(f"word{i} other{i}")
        assert len(small) <= 51 and len(small.neighbours) <= 51


def test_odd_rows_go_there_and_back(spark):
    found = pieces.vocabulary()
    encoded = pieces.with_ids(odd(spark), found)
    back = pieces.with_text(encoded, found).collect()
    assert len(back) == len(ODD)
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert [r["ids"] for r in back if r["text"] in (None, "")] == [[], []]
    got = pieces.digests(odd(spark), found).collect()
    assert all(r["round_trip"] for r in got)
    assert pieces.with_ids(none(spark), found).count() == 0 and pieces.digests(none(spark), found).count() == 0


def test_words_that_come_again_are_not_read_anew(codec, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    small, read = pieces.Codec(pieces.vocabulary()), []
    packed = small._packed
    monkeypatch.setattr(small, "_packed", lambda marked: read.append(marked) or packed(marked))
    for i in range(400):
        assert small.encode(f"othernessing word{i}") == codec.encode(f"othernessing word{i}")
        assert len(small) + len(small.old) <= 50 and len(small.heads) <= 10
    assert read.count(pieces.BLANK + "othernessing") == 1


def test_a_sign_behind_a_known_word_is_read_alone(codec, monkeypatch):
    small, read = pieces.Codec(pieces.vocabulary()), []
    whole = small._read
    monkeypatch.setattr(small, "_read", lambda *args: read.append(args[5] - args[4]) or whole(*args))
    expected = codec.encode("otherwordly"), codec.encode("otherwordly,"), codec.encode("x otherwordly;\n;, ;.;")
    read.clear()
    assert (small.encode("otherwordly"), small.encode("otherwordly,"), small.encode("x otherwordly;\n;, ;.;")) == expected
    assert sum(max(0, n) for n in read) < 2 * len(pieces.BLANK + "otherwordly")
