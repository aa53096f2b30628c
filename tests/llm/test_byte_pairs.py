"""Byte-pair ids against the library and against plain merging, and back to texts as a stream."""

import codecs
import hashlib
import random

import pytest
from edge import ODD, none, odd
from pyspark.sql import functions as F

from millrace.llm import byte_pairs

SMALL = "/root/testdata/sf0.01"
TEXTS = ["", " ", "  ", "a", "Hello  world ", "\n", " \n ", "\n\n x\t y\r\n", "I'll we've they'd IT'S", "aaaa aaaaaaa",
         "é漢字😀ﬁ \x00", "<|endoftext|>", "1234567 ½ Ⅷ", "日本語のテキスト" * 50, "x" * 5000, "ab" * 3000, " " * 3000 + "y",
         "\n" * 700, "\x1c\x1d \x85\xa0  z", "z" * 99 + "﻿"]


@pytest.fixture(scope="module")
def found():
    return byte_pairs.vocabulary()


@pytest.fixture(scope="module")
def codec(found):
    return byte_pairs.Codec(dict(found))


@pytest.fixture(scope="module")
def library(found):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=found["pattern"], mergeable_ranks=found["ranks"], special_tokens={})


def merged(ranks, word: bytes):
    """All merges one after the other."""
    symbols = [word[i:i + 1] for i in range(len(word))]
    while True:
        known = [ranks.get(a + b, 1 << 30) for a, b in zip(symbols, symbols[1:])]
        if not known or min(known) == 1 << 30:
            return [ranks[s] for s in symbols]
        at = known.index(min(known))
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]


def ids_of(transducer, word: bytes):
    return [i for part in transducer.stream(word) for i in part]


def test_ids_are_those_of_the_library(codec, library, spark):
    random.seed(5)
    texts = TEXTS + ["".join(random.choices("aeinrst thABC'lld\n\t 019.,-é漢▁😀", k=random.randint(1, 90))) for _ in range(500)]
    texts += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(200).collect()]
    for text in texts:
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text), text[:60]
        assert "".join(codec.decode(ids)) == text


def test_transducer_gives_what_merging_gives_for_any_ranks():
    """Small vocabularies of all sorts, some with tokens that no merge reaches."""
    random.seed(6)
    for _ in range(150):
        ranks = {bytes([b]): b for b in range(256)}
        parts = [b"a", b"b", b"c"]
        for rank in range(256, 256 + random.randint(1, 14)):
            token = random.choice(parts) + random.choice(parts)
            if random.random() < 0.1:
                token = bytes(random.choices(b"abc", k=4))
            if token not in ranks:
                ranks[token] = rank
                parts.append(token)
        transducer = byte_pairs.Transducer(byte_pairs.Merges(ranks), arcs=random.choice([5, 1000]))
        for _ in range(40):
            word = bytes(random.choices(b"abc", k=random.randint(1, 30)))
            assert ids_of(transducer, word) == merged(ranks, word), (ranks, word)
            assert len(transducer.arcs) <= transducer.limit


def test_ids_leave_after_bounded_lookahead(codec):
    random.seed(7)
    word = "".join(random.choices("abcdeilnorst", k=30_000)).encode()
    read, left, ids = 0, 0, []
    lengths = codec.transducer.merges.spelled

    def bytes_read():
        nonlocal read
        for byte in word:
            read += 1
            yield byte

    for part in codec.transducer.stream(bytes_read()):
        ids.extend(part)
        left += sum(len(lengths[i]) for i in part)
        assert read - left < 64
    assert ids == merged_by_parts(codec, word)


def merged_by_parts(codec, word):
    return ids_of(byte_pairs.Transducer(codec.transducer.merges), word)


def test_one_state_for_equal_situations(codec):
    fresh = byte_pairs.Transducer(codec.transducer.merges)
    ids_of(fresh, b"x" * 2000)
    known = len(fresh.places)
    ids_of(fresh, b"x" * 200_000)
    assert len(fresh.places) == known


def test_memory_is_bounded(found, codec, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 40)
    small = byte_pairs.Codec(dict(found))
    small.transducer.limit = 60
    for i in range(300):
        text = f"wordly{i} othernessing{i}"
        assert small.encode(text) == codec.encode(text)
        assert len(small) <= 41 and len(small.transducer.arcs) <= 60 and len(small.transducer.merges.pairs) <= 40


def test_a_text_of_many_windows(codec, library, monkeypatch):
    text = "Ärger über 漢字 and words. " * 3000
    ids = codec.encode(text)
    monkeypatch.setattr(byte_pairs, "LONG", 10)
    assert codec.encode(text) == ids == library.encode_ordinary(text)
    monkeypatch.setattr(byte_pairs, "WINDOW", 7)
    assert "".join(codec.decode(ids)) == text


def test_utf8_in_parts_of_any_size():
    random.seed(8)
    pool = [b"abc", "é".encode(), "漢".encode(), "😀".encode(), b"\xc0", b"\xff", b"\xe0\x80", b"\xed\xa0\x80", b"\xf4\x90", b"\xe6\xbc",
            b"\x80", b"\xf0\x9f\x98", b"\xf5", b"\xc3"]
    for _ in range(2000):
        data = b"".join(random.choices(pool, k=random.randint(0, 8)))
        stream, plain, at, out = byte_pairs.Utf8Stream(), codecs.getincrementaldecoder("utf-8")("replace"), 0, ""
        while at < len(data):
            size = random.randint(1, 4)
            out += stream.feed(data[at:at + size])
            assert len(stream.held) <= 3
            at += size
        assert out + stream.end() == data.decode("utf-8", "replace") == plain.decode(data, True), data


def test_unknown_ids_have_no_text(codec):
    assert "".join(codec.decode([*codec.encode("hi"), 10**9, -1])) == "hi"
    assert list(codec.decode([])) == [""]


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError):
        byte_pairs.shared({b"a": 0}, ".")


def test_odd_rows_go_there_and_back(spark, found, library):
    back = byte_pairs.with_text(byte_pairs.with_ids(odd(spark), found), found).collect()
    assert len(back) == len(ODD)
    assert all(r["decoded"] == (r["text"] or "") and r["ids"] == library.encode_ordinary(r["text"] or "") for r in back)
    assert byte_pairs.with_ids(none(spark), found).count() == 0 and byte_pairs.digests(none(spark), found).count() == 0
    renamed = byte_pairs.with_text(byte_pairs.with_ids(odd(spark).withColumnRenamed("n", "ids"), found, "IDS"), found, "IDS")
    assert renamed.columns[-2:] == ["IDS", "decoded"] and renamed.count() == len(ODD)


def test_digests_are_those_of_the_library(spark, library):
    got = byte_pairs.op12_byte_pairs(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    expected = []
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        expected.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_digests_of_odd_rows(spark, found, library):
    got = byte_pairs.digests(odd(spark).withColumn("doc_id", F.col("doc_id").cast("int")), found).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(library.encode_ordinary(r[1] or "")) for r in ODD)


def test_words_that_come_again_are_not_read_anew(found, codec, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 40)
    small, read = byte_pairs.Codec(dict(found)), []
    whole = small.transducer.ids
    monkeypatch.setattr(small.transducer, "ids", lambda word: read.append(word) or whole(word))
    for i in range(400):
        assert small.encode(f" othernessing qzxw{i % 13}qqz{i}") == codec.encode(f" othernessing qzxw{i % 13}qqz{i}")
        assert len(small) + len(small.old) <= 40
    assert read.count(b" othernessing") <= 1


def test_many_ids_at_once(codec, monkeypatch):
    import numpy as np

    monkeypatch.setattr(byte_pairs, "WINDOW", 7)
    ids = np.array(codec.encode("Some words, é and 漢字😀. " * 9), np.int32)
    assert b"".join(codec.listed(ids)).decode() == " ".join(map(str, ids.tolist())) and list(codec.listed(ids[:0])) == []
    assert "".join(codec.decode(ids)) == "Some words, é and 漢字😀. " * 9
    strange = np.array([*codec.encode("hi"), 10**9, -1], np.int64)
    assert "".join(codec.decode(strange)) == "hi"
    gaps = byte_pairs.Joined({3: b"abc", 9: b"", 50: b"z"})
    assert gaps(np.array([50, 4, 3, 9, 51, -1, 50])) == b"zabcz" and gaps(np.array([], np.int64)) == b""


def test_beginnings_of_words_are_forgotten_with_the_states(found, codec):
    small = byte_pairs.Transducer(codec.transducer.merges, arcs=30)
    random.seed(9)
    for _ in range(500):
        word = "".join(random.choices("aeinrstl", k=random.randint(1, 14))).encode()
        assert small.ids(word) == ids_of(codec.transducer, word)
        assert len(small.heads) <= 30 // byte_pairs.HEAD
