"""Byte-level BPE ids of texts by a lazily determinised transducer, and texts of ids as a stream.

Merging by rank has one result, and that is the one split into tokens in which no two neighbours would
have merged across their boundary; whether they would depends on the two alone. So each prefix of a word has
one last token, and reading one more byte asks only which token that still grows at the end of the
prefix ends with this byte and may follow the token before it.

That is a transducer over bytes. What it knows after a prefix is, for each place where a token may have begun
that is not complete yet, the token before the place and the ids on the path to it which are not common to all
places. Ids common to all are emitted and forgotten, so a state is small, equal situations are one state, and
an id leaves a bounded number of bytes after its own end. States and arcs are made when a text first needs
them and kept up to a limit. At the end of a word the path to its end is flushed.

Decoding takes ids in parts of any size; a machine over the bytes of UTF-8 says where the last whole
character ends, and holds back what follows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.llm.tokens import slices, text_column

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Arcs of the transducer, and ids of words of up to so many bytes, that one worker keeps at most.
ARCS, REMEMBERED, SHORT = 700_000, 1_000_000, 48
#: Ids that are decoded at once; texts of more characters are split into words one by one.
WINDOW, LONG = 8192, 1 << 20
#: So many first bytes of a word are read in one step once they are known.
HEAD = 5
NEVER = float("inf")


def vocabulary(path: str | None = None) -> dict:
    """The ranks of a file, one base64 token and its rank a line, and the pattern that splits texts."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return shared(ranks, public_tokenizers.PATTERN)


def shared(ranks: dict[bytes, int], pattern: str) -> dict:
    """What executors need; every single byte must have a rank, as there is no other way to write it."""
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte-level vocabulary has a token for each byte")
    return {"ranks": ranks, "pattern": pattern}


class Merges:
    """Which tokens stand, and which may stand side by side, found from the ranks when asked.

    Tokens are known by rank. ``child`` leads from a node of the tree of all tokens and a byte
    to a node, 0 being the root; ``token_at`` has the rank of the token that a node spells.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.spelled = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        self.inner: set[int] = {0}
        self.histories: dict[int, list[tuple]] = {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner.add(node)
                node = self.child.setdefault(node << 8 | byte, len(self.child) + 1)
            if self.history(rank)[-1][1] == token:
                self.token_at[node] = rank
        self.pairs: dict[int, bool] = {}

    def history(self, rank: int) -> list[tuple]:
        """(rank of the next merge, first symbol, last symbol) as the token's bytes merge on their own.

        A token that its bytes do not merge to stands nowhere.
        """
        steps = self.histories.get(rank)
        if steps is not None:
            return steps
        token = self.spelled[rank]
        symbols, steps = [token[i:i + 1] for i in range(len(token))], []
        self.histories[rank] = steps
        while True:
            ranks = [self.ranks.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
            best = min(ranks, default=NEVER)
            steps.append((best, symbols[0], symbols[-1]))
            if best == NEVER:
                return steps
            at = ranks.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def apart(self, left: int, right: int) -> bool:
        """Whether no merge crosses the boundary of the two.

        Both merge on their own, the lower rank first and of equal ranks the left one, and before
        each merge the symbols beside the boundary get their chance.
        """
        known = self.pairs.get(left << 32 | right)
        if known is None:
            ours, theirs, a, b = self.history(left), self.history(right), 0, 0
            while True:
                across = self.ranks.get(ours[a][2] + theirs[b][1], NEVER)
                known = across == NEVER or across >= ours[a][0] or across > theirs[b][0]
                if not known or ours[a][0] == theirs[b][0] == NEVER:
                    break
                if ours[a][0] <= theirs[b][0]:
                    a += 1
                else:
                    b += 1
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            self.pairs[left << 32 | right] = known
        return known


class Transducer:
    """States are numbers, 0 the start; an arc is ``state << 8 | byte``.

    A state's places are (node of the bytes since the place, token before it or -1, ids on the
    path to it that were not emitted), the end of what was read last.
    """

    def __init__(self, merges: Merges, arcs: int = ARCS):
        self.merges, self.limit = merges, arcs
        self.forget()

    def forget(self) -> None:
        self.places: list[tuple] = []
        self.states: dict[tuple, int] = {}
        #: Of each arc: twice the state it leads to, and one more if ids are emitted.
        self.arcs: dict[int, int] = {}
        self.emitted: dict[int, tuple[int, ...]] = {}
        self.heads: dict[bytes, tuple[int, list[int]]] = {}
        self._state(((0, -1, ()),))

    def _state(self, places: tuple) -> int:
        number = self.states.setdefault(places, len(self.places))
        if number == len(self.places):
            self.places.append(places)
        return number

    def _arc(self, state: int, byte: int) -> int:
        merges, places, end = self.merges, [], None
        child, token_at, inner, pairs = merges.child, merges.token_at, merges.inner, merges.pairs
        for node, before, path in self.places[state]:
            grown = child.get(node << 8 | byte)
            if grown is None:
                continue
            if end is None:
                token = token_at.get(grown)
                if token is not None:
                    apart = before < 0 or pairs.get(before << 32 | token)
                    if apart or apart is None and merges.apart(before, token):
                        end = (0, token, (*path, token))
            if grown in inner:
                places.append((grown, before, path))
        places.append(end)
        first = places[0][2]
        common = 0
        if first:
            head = first[0]
            for _, _, path in places:
                if not path or path[0] != head:
                    break
            else:
                for ids in zip(*[path for _, _, path in places]):
                    if ids.count(ids[0]) < len(ids):
                        break
                    common += 1
        if common:
            places = [(node, before, path[common:]) for node, before, path in places]
            self.emitted[state << 8 | byte] = first[:common]
        to = self.arcs[state << 8 | byte] = self._state(tuple(places)) << 1 | (common > 0)
        return to

    def stream(self, word: Iterable[int]) -> Iterator[tuple[int, ...]]:
        """The ids of a word's bytes, in parts as soon as they are final."""
        state, known = 0, self.arcs.get
        for byte in word:
            arc = state << 8 | byte
            to = known(arc)
            if to is None:
                if len(self.arcs) >= self.limit:
                    here = self.places[state]
                    self.forget()
                    state, known = self._state(here), self.arcs.get
                    arc = state << 8 | byte
                to = self._arc(state, byte)
            if to & 1:
                yield self.emitted[arc]
            state = to >> 1
        yield self.places[state][-1][2]

    def ids(self, word: bytes) -> list[int]:
        """The ids of a word that is there in full. Where the first bytes of words lead is remembered, too."""
        head = self.heads.get(word[:HEAD])
        if head is None:
            state, out = self._read(0, word[:HEAD])
            if len(self.heads) >= self.limit // HEAD:
                self.heads.clear()
            self.heads[word[:HEAD]] = state, out
        else:
            state, out = head
        if len(word) > HEAD:
            state, more = self._read(state, word[HEAD:])
            out = out + more
        return [*out, *self.places[state][-1][2]]

    def _read(self, state: int, part: bytes) -> tuple[int, list[int]]:
        """The state that bytes lead to, and the ids that are final by then."""
        known, emitted, out = self.arcs.get, self.emitted, []
        for byte in part:
            arc = state << 8 | byte
            to = known(arc)
            if to is None:
                if len(self.arcs) >= self.limit:
                    here = self.places[state]
                    self.forget()
                    state, known, emitted = self._state(here), self.arcs.get, self.emitted
                    arc = state << 8 | byte
                to = self._arc(state, byte)
            if to & 1:
                out += emitted[arc]
            state = to >> 1
        return state, out


class Joined:
    """The bytes that stand for ids, gathered for many ids at once; an id that has none adds nothing."""

    def __init__(self, shown: dict[int, bytes]):
        self.known = np.array(sorted(shown), np.int64)
        parts = [shown[i] for i in self.known.tolist()]
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.lengths = np.array([*map(len, parts), 0], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __call__(self, ids: np.ndarray) -> bytes:
        at = self._places(ids)
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        if not len(ends) or not ends[-1]:
            return b""
        where = np.repeat(self.starts[at] - ends + lengths, lengths)
        where += np.arange(len(where))
        return self.bytes[where].tobytes()

    def _places(self, ids: np.ndarray) -> np.ndarray:
        """Where the ids are among the known ones, the end for those that are not."""
        last = len(self.known) - 1
        if last >= 0 and self.known[0] == 0 and self.known[last] == last and (not len(ids) or 0 <= ids.min() and ids.max() <= last):
            return ids
        at = np.searchsorted(self.known, ids)
        return np.where(self.known[np.minimum(at, last)] == ids, at, last + 1) if last >= 0 else at


#: Where a byte leads in UTF-8: from a state to a state, 0 between characters, or ERROR. Built from the ranges of
#: well-formed sequences: a leading byte names how many follow and what the first of them may be.
ERROR = -1
_NEXT = [[ERROR] * 256 for _ in range(8)]


def _allow(state: int, first: int, last: int, to: int) -> None:
    _NEXT[state][first:last + 1] = [to] * (last - first + 1)


for _args in (
    (0, 0x00, 0x7F, 0), (0, 0xC2, 0xDF, 1), (0, 0xE1, 0xEF, 2), (0, 0xF1, 0xF3, 3), (0, 0xE0, 0xE0, 4),
    (0, 0xED, 0xED, 5), (0, 0xF0, 0xF0, 6), (0, 0xF4, 0xF4, 7), (1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1),
    (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2),
):
    _allow(*_args)
_HIGH = re.compile(rb"[\x80-\xff]+")


class Utf8Stream:
    """Bytes in parts of any size into text; what is no UTF-8 becomes U+FFFD, one for each broken start."""

    def __init__(self):
        self.state, self.held = 0, b""

    def feed(self, part: bytes) -> str:
        read = len(self.held)
        data, state, whole = self.held + part, self.state, 0
        for run in _HIGH.finditer(data, read):
            if run.start() > read:
                state = 0
            if state == 0:
                whole = run.start()
            for at in range(run.start(), run.end()):
                state = _NEXT[state][data[at]]
                if state == ERROR:
                    whole, state = at, _NEXT[0][data[at]]
                if state <= 0:
                    whole, state = at + 1, 0
            read = run.end()
        if read < len(data) or state == 0:
            whole, state = len(data), 0
        self.state, self.held = state, data[whole:]
        return data[:whole].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.state, self.held = self.held, 0, b""
        return rest.decode("utf-8", "replace")


def windows(ids: np.ndarray) -> Iterator[np.ndarray]:
    return (ids[low:low + WINDOW] for low in range(0, len(ids), WINDOW))


class Codec(dict):
    """Encodes and decodes with one vocabulary. As a dict: the ids of a word as packed 32-bit numbers.

    When half of what may be remembered is there, it becomes the old half: words that come again are taken from it.
    """

    def __init__(self, found: dict):
        import regex

        super().__init__()
        self.ranks, self.transducer = found["ranks"], Transducer(Merges(found["ranks"]))
        self.pattern = regex.compile(found["pattern"])
        self.old: dict[str, bytes] = {}
        self.shown = Joined(self.transducer.merges.spelled)
        self.decimal = Joined({rank: b"%d " % rank for rank in self.ranks.values()})

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            data = word.encode()
            known = self.ranks.get(data)
            if len(data) > SHORT:
                found = self.transducer.stream(data) if known is None else ((known,),)
                return array("i", chain.from_iterable(found)).tobytes()
            ids = array("i", self.transducer.ids(data) if known is None else (known,)).tobytes()
        if len(self) >= REMEMBERED // 2:
            self.old = {}
            self.old = self.copy()
            self.clear()
        self[word] = ids
        return ids

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as packed 32-bit numbers; none for NULL and for an empty text."""
        if not text:
            return b""
        if len(text) > LONG:
            words: Iterable[str] = (m.group() for m in self.pattern.finditer(text))
        else:
            words = self.pattern.findall(text)
        return b"".join(map(self.__getitem__, words))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def listed(self, ids: np.ndarray) -> Iterator[bytes]:
        """The ids in decimal, joined by a blank, in parts."""
        before = b""
        for part in windows(ids):
            yield before + self.decimal(part)[:-1]
            before = b" "

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of ids in parts; an id without a token has none."""
        stream, found = Utf8Stream(), self.transducer.merges.spelled
        if isinstance(ids, np.ndarray):
            yield from (stream.feed(self.shown(part)) for part in windows(ids))
            yield stream.end()
            return
        ids = iter(ids)
        while True:
            part = list(islice(ids, WINDOW))
            if not part:
                break
            yield stream.feed(b"".join(map(found.get, part, repeat(b""))))
        yield stream.end()


def _codec(broadcast) -> Codec:
    """The worker's codec, kept in its copy of the broadcast: what it knows serves the next task, too."""
    found = broadcast.value
    if "codec" not in found:
        found["codec"] = Codec(found)
    return found["codec"]


def _fields(df: DataFrame, columns: list[str]) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*_quoted(columns)).schema]


def _quoted(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def with_ids(docs: DataFrame, found: dict, name: str = "ids") -> DataFrame:
    """``docs`` with the ids of their texts, array<int>; a column of that name is replaced.

    NULL and empty texts have no ids. Special tokens are never made of a text: what looks like one is text.
    """
    columns = [c for c in docs.columns if c.lower() != name.lower()]
    broadcast = docs.sparkSession.sparkContext.broadcast(found)

    def encode(batches):
        codec = _codec(broadcast)
        for batch in batches:
            bounds, _ = text_column(batch, "text")
            for low, high in slices(bounds):
                part = batch.slice(low, high - low)
                ids = [codec.packed(t) for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(i) // 4 for i in ids]))).astype(np.int32)
                column = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32))
                )
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*columns, name])

    schema = ", ".join([*_fields(docs, columns), f"`{name}` array<int>"])
    return docs.select(*_quoted(columns)).mapInArrow(encode, schema)


def with_text(encoded: DataFrame, found: dict, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the texts of its ids; NULL ids have an empty one. A column of that name is replaced."""
    columns = [c for c in encoded.columns if c.lower() != name.lower()]
    broadcast = encoded.sparkSession.sparkContext.broadcast(found)

    def decode(batches):
        codec = _codec(broadcast)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                texts = ["".join(codec.decode(x or [])) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*columns, name])

    schema = ", ".join([*_fields(encoded, columns), f"`{name}` string"])
    return encoded.select(*_quoted(columns)).mapInArrow(decode, schema)


def digests(docs: DataFrame, found: dict) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by a blank), decoded_sha256, one row a row.

    NULL and empty texts have no ids, and both digests are those of nothing. Repeated rows are repeated.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(found)

    def digest(batches):
        codec = _codec(broadcast)
        for batch in batches:
            bounds, _ = text_column(batch, "text")
            for low, high in slices(bounds):
                counts, of_ids, of_texts = [], [], []
                for text in batch.column(1).slice(low, high - low).to_pylist():
                    ids = np.frombuffer(codec.packed(text), np.int32)
                    counts.append(len(ids))
                    listed, whole = hashlib.sha256(), hashlib.sha256()
                    for part in codec.listed(ids):
                        listed.update(part)
                    of_ids.append(listed.hexdigest())
                    for part in codec.decode(ids):
                        whole.update(part.encode())
                    of_texts.append(whole.hexdigest())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string()),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


@query("op12_byte_pairs")
def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())
