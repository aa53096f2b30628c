"""SentencePiece ids of texts, and texts of ids, by a streaming Viterbi pass.

The vocabulary's scores are merge priorities: the model joins the best-scoring neighbours first. The
segmentation that comes out is the one path through the lattice of pieces on which no two neighbours
would be merged across their boundary, and whether they would depends on the two alone. So the pass
goes forward over the characters, keeps for each position the one piece that ends there on a path of
such neighbours (its backpointer), and never looks back further than the longest piece.

A later piece can start at none but the last ``longest`` positions. As soon as the paths from
all of these come through one boundary, everything before it is final: its ids go out and its
backpointers go. Words repeat, so the ids of short ones are remembered in each worker, up to a limit.

Characters without a piece become their bytes' pieces, and nothing merges with them.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.llm.tokens import slices, text_column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Words of up to so many characters are remembered, so many at once.
SHORT, REMEMBERED = 32, 400_000
#: The pass over so many first characters of a word is remembered.
HEAD = 5
NO_PIECE = -1
_WORDS = re.compile(r" +[^ \n]*|\n[^ \n]*")


def vocabulary(path: str = MODEL) -> dict:
    """Pieces with ids and scores, and ids of bytes, of a model that merges by score."""
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, special = {}, {}, []
    of_byte = [loaded.unk_id()] * 256
    for i in range(loaded.get_piece_size()):
        text = loaded.id_to_piece(i)
        if loaded.is_byte(i):
            of_byte[int(text[3:5], 16)] = i
        elif loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i):
            special.append(i)
        else:
            pieces[text], scores[text] = i, loaded.get_score(i)
    key = hashlib.sha256(repr(sorted(pieces.items())).encode()).hexdigest()
    return {"pieces": pieces, "scores": scores, "bytes": of_byte, "special": special, "key": key}


class Codec(dict):
    """Encodes and decodes with one vocabulary. As a dict: a word's ids as packed 32-bit numbers.

    When half of what may be remembered is there, it becomes the old half: words that come again are taken from it.
    """

    def __init__(self, found: dict):
        super().__init__()
        self.pieces, self.scores, self.of_byte = found["pieces"], found["scores"], found["bytes"]
        self.longest = max(map(len, self.pieces), default=1)
        self.text = {i: t for t, i in self.pieces.items()}
        self.byte = {i: b for b, i in enumerate(self.of_byte)}
        self.neighbours: dict[tuple, bool] = {}
        self.histories: dict[int, tuple] = {}
        self.standing = {t: i for t, i in self.pieces.items() if self._history(i)[1][-1] == t}
        self.old: dict[str, bytes] = {}
        self.heads: dict[str, tuple] = {}
        self.inside = {t[i:i + 2] for t in self.pieces for i in range(len(t) - 1)}
        self.reach: dict[str, int] = {}
        for t in self.standing:
            self.reach[t[-1]] = max(self.reach.get(t[-1], 1), len(t))
        # all paths meet before a blank that does not go on a run of them, and around a line end,
        # if no piece holds a blank behind another character, nor a line end
        self.by_words = not any(BLANK in t.lstrip(BLANK) or "\n" in t for t in self.pieces)
        size = max([*self.text, *self.byte, *found["special"]], default=0) + 1
        shown = [b""] * size
        for i, t in self.text.items():
            shown[i] = t.replace(BLANK, " ").encode()
        for b, i in enumerate(self.of_byte):
            shown[i] = bytes([b])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.lengths = np.array([len(x) for x in shown])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _history(self, piece: int) -> tuple[list[float], list[str], list[str]]:
        """How the piece's characters merge on their own: scores, and first and last symbol.

        The symbols are those before each merge, and at the end those that no merge joins.
        """
        known = self.histories.get(piece)
        if known is None:
            symbols, scores, firsts, lasts = list(self.text[piece]), [], [], []
            while True:
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
                joined = [self.scores.get(a + b, -np.inf) for a, b in zip(symbols, symbols[1:])]
                if not joined or max(joined) == -np.inf:
                    break
                at = joined.index(max(joined))
                scores.append(joined[at])
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            scores.append(-np.inf)
            known = self.histories[piece] = scores, firsts, lasts
        return known

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the boundary between two pieces outlasts all merges.

        Both sides merge on their own, the better score first, until the symbols beside the
        boundary would merge before either goes on; of equal scores the leftmost merges.
        """
        known = self.neighbours.get((left, right))
        if known is None:
            a_scores, _, a_lasts = self._history(left)
            b_scores, b_firsts, _ = self._history(right)
            a = b = 0
            while True:
                across = self.scores.get(a_lasts[a] + b_firsts[b], -np.inf)
                if across > a_scores[a] and across >= b_scores[b] and across > -np.inf:
                    known = False
                    break
                if a_scores[a] == b_scores[b] == -np.inf:
                    known = True
                    break
                if a_scores[a] >= b_scores[b]:
                    a += 1
                else:
                    b += 1
            if len(self.neighbours) >= REMEMBERED:
                self.neighbours.clear()
            self.neighbours[left, right] = known
        return known

    def stream(self, text: str) -> Iterator[list[int]]:
        """The ids of a text that is marked with blanks, in parts as soon as they are final."""
        # of the piece that ends k characters behind base: its length and its id
        sizes, ids = [0], [NO_PIECE]
        base, longest = 0, self.longest
        for at in range(0, len(text), longest):
            self._read(text, base, sizes, ids, at, min(at + longest, len(text)))
            if len(ids) > 4 * longest:
                met = self._meeting(sizes, longest)
                if met:
                    yield self._ids(text, base, sizes, ids, met)
                    del sizes[:met], ids[:met]
                    base += met
        yield self._ids(text, base, sizes, ids, len(ids) - 1)

    def _read(self, text: str, base: int, sizes: list[int], ids: list[int], low: int, high: int) -> None:
        """The pass over some more characters."""
        standing, reach = self.standing.get, self.reach.get
        known, may_follow = self.neighbours.get, self._may_follow
        for i in range(low + 1, high + 1):
            k = i - base
            for size in range(1, min(reach(text[i - 1], 1), k) + 1):
                piece = standing(text[i - size:i])
                if piece is None:
                    if size == 1:
                        piece = NO_PIECE
                        break
                    continue
                before = ids[k - size]
                if before == NO_PIECE:
                    break
                stays = known((before, piece))
                if stays or stays is None and may_follow(before, piece):
                    break
            sizes.append(size)
            ids.append(piece)

    @staticmethod
    def _meeting(sizes: list[int], longest: int) -> int:
        """The last boundary that the paths from all of the last positions share."""
        alive = set(range(len(sizes) - longest, len(sizes)))
        while len(alive) > 1:
            top = max(alive)
            alive.discard(top)
            alive.add(max(0, top - sizes[top]))
        return alive.pop()

    def _ids(self, text: str, base: int, sizes: list[int], ids: list[int], until: int) -> list[int]:
        out: list[int] = []
        while until > 0:
            if ids[until] == NO_PIECE:
                out.extend(self.of_byte[b] for b in reversed(text[base + until - 1].encode()))
            else:
                out.append(ids[until])
            until -= sizes[until]
        return out[::-1]

    def __missing__(self, word: str) -> bytes:
        """``word`` stands behind a blank, or at its beginning has the line end before it."""
        ids = self.old.get(word)
        if ids is None:
            marked = word.replace(" ", BLANK)
            ids = self._packed(marked if word[:1] == "\n" else BLANK + marked)
            if len(word) > SHORT:
                return ids
        if len(self) >= REMEMBERED // 2:
            self.old = {}
            self.old = self.copy()
            self.clear()
        self[word] = ids
        return ids

    def _packed(self, marked: str) -> bytes:
        if len(marked) > SHORT + 1:
            return b"".join(np.array(part, np.int32).tobytes() for part in self.stream(marked))
        # all paths meet before a last character, say a sign, that no piece holds behind the one before it
        end = len(marked) - 1
        if end > 1 and marked[end - 1:] not in self.inside:
            return self._short(marked[:end]) + self._short(marked[end:])
        return self._short(marked)

    def _short(self, marked: str) -> bytes:
        """As ``stream``, of a few characters. What the pass finds for the first ones is remembered, too."""
        word = marked[1:] if marked[:1] == BLANK else marked
        known = (self.get(word) or self.old.get(word)) if word is not marked else None
        if known is not None:
            return known
        head = self.heads.get(marked[:HEAD])
        if head is None:
            head = [0], [NO_PIECE]
            self._read(marked, 0, *head, 0, min(HEAD, len(marked)))
            if len(self.heads) >= REMEMBERED // HEAD:
                self.heads.clear()
            self.heads[marked[:HEAD]] = head
        sizes, ids = head[0][:], head[1][:]
        self._read(marked, 0, sizes, ids, HEAD, len(marked))
        return array("i", self._ids(marked, 0, sizes, ids, len(marked))).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as packed 32-bit numbers; none for NULL and for an empty text."""
        if not text:
            return b""
        text = text.replace(BLANK, " ")
        if not self.by_words:
            return self._packed(BLANK + text.replace(" ", BLANK))
        words = text.replace("\n", " \n")
        if "  " in words or words[0] in " \n":
            # a run of blanks goes with the word behind it, a line end with what follows it
            return b"".join([
                self[w[1:]] if w[0] == " " else self[w] for w in _WORDS.findall(" " + text)
            ])
        return b"".join(map(self.__getitem__, words.split(" ")))

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8; special ids have none."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.shown[at].tobytes()[1:]


def _codec(shared, key: str) -> Codec:
    """One codec for all tasks of a worker: what it remembers serves the next task, too."""
    import pyspark

    kept = pyspark.__dict__.setdefault("_piece_codecs", {})
    if key not in kept:
        kept.clear()
        kept[key] = Codec(shared.value)
    return kept[key]


def _encoded(batch: pa.RecordBatch, codec: Codec) -> Iterator[tuple[int, int, list[bytes]]]:
    bounds, _ = text_column(batch, "text")
    texts = batch.column(batch.schema.get_field_index("text"))
    for low, high in slices(bounds):
        yield low, high, [codec.encode(t) for t in texts.slice(low, high - low).to_pylist()]


def with_ids(docs: DataFrame, found: dict, name: str = "ids") -> DataFrame:
    """``docs`` with the ids of their texts, array<int>; a column of that name is replaced."""
    columns = [c for c in docs.columns if c != name]
    shared, key = docs.sparkSession.sparkContext.broadcast(found), found["key"]

    def encode(batches):
        codec = _codec(shared, key)
        for batch in batches:
            for low, high, packed in _encoded(batch, codec):
                offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*columns, name])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]
    return docs.select(*columns).mapInArrow(encode, ", ".join([*fields, f"{name} array<int>"]))


def with_text(encoded: DataFrame, found: dict, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the texts of its ids; NULL ids have an empty one."""
    columns = [c for c in encoded.columns if c != name]
    shared, key = encoded.sparkSession.sparkContext.broadcast(found), found["key"]

    def decode(batches):
        codec = _codec(shared, key)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                texts = [codec.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*columns, name])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*columns).schema]
    return encoded.select(*columns).mapInArrow(decode, ", ".join([*fields, f"{name} string"]))


def digests(docs: DataFrame, found: dict) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit numbers), round_trip.

    ``round_trip``: the ids read as the text again, NULL as empty. The vocabulary writes a
    blank as U+2581, so a text's own U+2581 reads as a blank.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(found), found["key"]

    def digest(batches):
        codec = _codec(shared, key)
        for batch in batches:
            texts = batch.column(1)
            for low, high, packed in _encoded(batch, codec):
                same = [
                    codec.decode(np.frombuffer(p, np.int32)) == (t or "").replace(BLANK, " ").encode()
                    for p, t in zip(packed, texts.slice(low, high - low).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]), pa.array(same),
                ], ["doc_id", "n_tokens", "ids_sha256", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean"
    )


@query("op10_pieces")
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())
