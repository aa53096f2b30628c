"""Fill-in-the-middle: texts with their middle moved to the end, and texts made whole again.

A text is cut into units (a word with the blanks before it), two cuts are drawn from a digest of its doc_id,
and prefix, middle and suffix change places behind marks. The texts of an Arrow batch lie one behind the other in one
buffer, and within a part of a text every byte moves equally far. So each cut adds one entry to an array
of differences, its cumulative sum is the shift of every byte, and one numpy scatter writes all outputs. To
restore, the marks in an output give the same parts, and one gather through the inverse shifts reads the text.
Bytes are shifted a window at a time, so memory is the texts, their outputs and one window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.llm.tokens import slices, text_column

SEED = 42
#: Of 100 texts, those below the rate change; of 100 of these, those below the share have the suffix first.
FIM_RATE, SPM_SHARE = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
WINDOW = 1 << 20

RESULT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def drawn(doc_id: Column, seed: int = SEED) -> Column:
    """Four numbers of 32 bits from the digest of seed and doc_id; NULL counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def unit_ends(bounds: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where the units of all texts end, ascending: behind a word, and at the end of a text in blanks."""
    found, end = [np.zeros(0, np.int64)], int(bounds[-1])
    ends = np.unique(bounds[1:][bounds[1:] > bounds[:-1]])
    for low in range(int(bounds[0]), end, WINDOW):
        high = min(low + WINDOW, end)
        blank = _BLANK[data[low:min(high + 1, end)]]
        here = high - low
        closes = ~blank[:here]
        closes[:len(blank) - 1] &= blank[1:here + 1]
        first, after = np.searchsorted(ends, [low + 1, high + 1])
        closes[ends[first:after] - 1 - low] = True
        found.append(np.flatnonzero(closes) + (low + 1))
    return np.concatenate(found)


def marks(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, letter) of all marks that lie within a text, ascending."""
    places = [np.zeros(0, np.int64)]
    for low in range(int(bounds[0]), int(bounds[-1]) - MARK + 1, WINDOW):
        high = min(low + WINDOW, int(bounds[-1]) - MARK + 1)
        at = np.flatnonzero(data[low:high] == PREFIX[0]) + low
        letter = data[at + 1]
        at = at[(data[at + 2] == PREFIX[2]) & np.isin(letter, [PREFIX[1], SUFFIX[1], MIDDLE[1]])]
        places.append(at)
    at = np.concatenate(places)
    within = np.searchsorted(bounds, at, "right") == np.searchsorted(bounds, at + MARK - 1, "right")
    at = at[within]
    return at, data[at + 1]


def shifts(starts: np.ndarray, by: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, shift of each byte in between), a window at a time.

    Bytes from ``starts[i]`` on move by ``by[i]``, up to the next start; of equal starts the last counts.
    The differences from one part to the next are laid out over the bytes and summed.
    """
    steps = np.diff(by, prepend=0)
    carried = 0
    for begin in range(low, high, WINDOW):
        end = min(begin + WINDOW, high)
        first, after = np.searchsorted(starts, [begin, end])
        shift = np.zeros(end - begin, np.int64)
        np.add.at(shift, starts[first:after] - begin, steps[first:after])
        shift[0] += carried
        np.cumsum(shift, out=shift)
        carried = int(shift[-1])
        yield begin, end, shift


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


class Moved:
    """The outputs of some texts: units, form, lengths in characters, and one buffer with its offsets."""

    def __init__(self, bounds: np.ndarray, data: np.ndarray, draws: np.ndarray, rate: int, share: int):
        low, high = bounds[:-1], bounds[1:]
        ends = unit_ends(bounds, data)
        first = np.searchsorted(ends, low, "right")
        self.n = np.searchsorted(ends, high, "right") - first
        places, _ = marks(bounds, data)
        marked = np.searchsorted(places, low) < np.searchsorted(places, high)
        self.plain = (low == high) | marked | (draws[:, 2] % 100 >= rate)
        self.suffix_first = ~self.plain & (draws[:, 3] % 100 < share)
        cuts = np.sort(draws[:, :2] % (self.n[:, None] + 1), axis=1)
        padded = np.concatenate((ends, [0]))
        a, b = (np.where(c > 0, padded[first + c - 1], low) for c in cuts.T)
        self.a, self.b = a, b
        extra = np.where(self.plain, 0, 3 * MARK)
        self.offsets = np.concatenate(([0], np.cumsum(high - low + extra)))
        out = self.offsets[:-1]
        # how far prefix, middle and suffix go
        prefix = np.where(self.suffix_first, 2 * MARK + high - b, MARK)
        middle = np.where(self.suffix_first, prefix + MARK, 3 * MARK + high - b)
        suffix = np.where(self.suffix_first, MARK - (b - low), 2 * MARK - (b - a))
        by = np.stack([np.where(self.plain, 0, x) + out - low for x in (prefix, middle, suffix)], axis=1)
        starts = np.stack([low, a, b], axis=1)
        self.data = np.empty(int(self.offsets[-1]), np.uint8)
        for begin, end, shift in shifts(starts.ravel(), by.ravel(), int(bounds[0]), int(bounds[-1])):
            shift += np.arange(begin, end)
            self.data[shift] = data[begin:end]
        psm, spm = ~self.plain & ~self.suffix_first, self.suffix_first
        self._write(PREFIX, np.where(spm, out + MARK + high - b, out), psm | spm)
        self._write(SUFFIX, np.where(spm, out, out + MARK + a - low), psm | spm)
        self._write(MIDDLE, np.where(spm, a + by[:, 0], out + 2 * MARK + a - low + high - b), psm | spm)

    def _write(self, mark: bytes, at: np.ndarray, rows: np.ndarray) -> None:
        for i, byte in enumerate(mark):
            self.data[at[rows] + i] = byte


def whole_again(bounds: np.ndarray, data: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the texts that outputs were made of; ``moved`` says which are not plain.

    The three marks of an output are the only ones in it, as a text with one is left plain.
    """
    low, high = bounds[:-1], bounds[1:]
    places, letters = marks(bounds, data)
    row = np.searchsorted(bounds, places, "right") - 1
    places, letters, row = (x[moved[row]] for x in (places, letters, row))
    at = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        of_mark = letters == mark[1]
        if not np.array_equal(row[of_mark], np.flatnonzero(moved)):
            raise ValueError("an output whose form is not plain holds each mark once")
        at[mark] = low.copy()
        at[mark][moved] = places[of_mark]
    spm = moved & (at[SUFFIX] < at[PREFIX])
    # where each part begins in the output, and where the text of it ends
    p, s, m = at[PREFIX] + MARK, at[SUFFIX] + MARK, at[MIDDLE] + MARK
    p_end = np.where(spm, at[MIDDLE], at[SUFFIX])
    s_end = np.where(spm, at[PREFIX], at[MIDDLE])
    p, p_end = np.where(moved, p, low), np.where(moved, p_end, high)
    m, s, s_end = np.where(moved, m, high), np.where(moved, s, high), np.where(moved, s_end, high)
    offsets = np.concatenate(([0], np.cumsum((p_end - p) + (high - m) + (s_end - s))))
    start = offsets[:-1]
    starts = np.stack([start, start + p_end - p, start + p_end - p + high - m], axis=1)
    by = np.stack([p, m, s], axis=1) - starts
    out = np.empty(int(offsets[-1]), np.uint8)
    for begin, end, shift in shifts(starts.ravel(), by.ravel(), 0, int(offsets[-1])):
        shift += np.arange(begin, end)
        out[begin:end] = data[shift]
    return offsets, out


def _texts(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """A text column over a buffer; fits 32-bit offsets, as a batch of texts does."""
    if offsets[-1] >= 1 << 31:
        raise ValueError("texts of 2 GB and more do not fit a batch")
    return pa.StringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)
    )


def _columns(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """(names quoted for a selection, field declarations)."""
    quoted = [f"`{c}`" for c in columns]
    return quoted, [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*quoted).schema]


def with_fim(
    docs: DataFrame, name: str = "fim", seed: int = SEED, rate: int = FIM_RATE, spm_share: int = SPM_SHARE,
) -> DataFrame:
    """``docs`` with a column ``name``: n units, form, prefix_chars, middle_chars, output.

    Form is plain (the text as it is), psm or spm. Plain are empty texts, texts that hold a mark, and those that
    the rate leaves out. NULL texts count as empty, a NULL doc_id as no digits; repeated rows get
    equal outputs. A column of that name is replaced; all other columns stay as they are.
    """
    columns = [c for c in docs.columns if c.lower() != name.lower()]
    quoted, fields = _columns(docs, columns)
    # the draws travel under the result's own name, which no other column has
    drawn_rows = docs.withColumn(name, drawn(F.col("doc_id"), seed)).select(*quoted, f"`{name}`")

    def move(batches):
        for batch in batches:
            bounds, data = text_column(batch, "text")
            draws = batch.column(len(columns)).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
            for low, high in slices(bounds):
                within = bounds[low:high + 1]
                moved = Moved(within, data, draws[low:high], rate, spm_share)
                chars = [
                    (None, None) if plain else (_characters(data[s:a]), _characters(data[a:b]))
                    for plain, s, a, b in zip(moved.plain, within, moved.a, moved.b)
                ]
                forms = np.where(moved.plain, "plain", np.where(moved.suffix_first, "spm", "psm"))
                result = pa.StructArray.from_arrays([
                    pa.array(moved.n, pa.int64()), pa.array(forms.tolist(), pa.string()),
                    pa.array([c[0] for c in chars], pa.int64()), pa.array([c[1] for c in chars], pa.int64()),
                    _texts(moved.offsets, moved.data),
                ], ["n", "form", "prefix_chars", "middle_chars", "output"])
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], result], [*columns, name])

    return drawn_rows.mapInArrow(move, ", ".join([*fields, f"`{name}` {RESULT}"]))


def with_restored(moved: DataFrame, fim: str = "fim", name: str = "restored") -> DataFrame:
    """``moved`` with the texts rebuilt from output and form of the column ``fim`` alone.

    A NULL output is an empty text, a NULL form is plain. A column of that name is replaced.
    """
    columns = [c for c in moved.columns if c.lower() != name.lower()]
    quoted, fields = _columns(moved, columns)
    output, form = "_output", "_form"
    while {output, form} & {c.lower() for c in columns}:
        output, form = f"_{output}", f"_{form}"
    laid_out = moved.select(
        *quoted, F.col(f"`{fim}`.output").alias(output),
        F.coalesce(F.col(f"`{fim}`.form") != "plain", F.lit(False)).alias(form),
    )

    def restore(batches):
        for batch in batches:
            bounds, data = text_column(batch, output)
            forms = batch.column(len(columns) + 1).to_numpy(zero_copy_only=False).astype(bool)
            for low, high in slices(bounds):
                texts = _texts(*whole_again(bounds[low:high + 1], data, forms[low:high]))
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], texts], [*columns, name])

    return laid_out.mapInArrow(restore, ", ".join([*fields, f"`{name}` string"]))


@query("op13_fill_middle", r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''),
                                  '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
               sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS s
        FROM documents
    ), h AS (
        SELECT doc_id, t, u, len(u) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
               ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4
        FROM d
    ), c AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
                    THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM h
    ), p AS (
        SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix,
               array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix
        FROM c
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
""")
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the text stays behind: what is restored has nothing but the output and its form
    moved = with_fim(docs).select("doc_id", "fim")
    return with_restored(moved).select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2(F.col("fim.output"), 256).alias("output_sha256"),
        F.sha2(F.col("restored"), 256).alias("restored_sha256"),
    )
