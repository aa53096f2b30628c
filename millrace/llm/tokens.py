"""Words of many texts at once: numpy over the bytes of an Arrow column.

Texts are looked at in windows of bounded size. A word that crosses a window's end is hashed on
in the next one, so neither a long text nor a long word needs more than its own bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 16
#: So many bytes of text are turned into words at once, or one text if it is longer.
SLICE = 4 << 20
BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWER = _powers(BASE, WINDOW + 1)
_INVERSE = _powers(pow(BASE, -1, 1 << 64), WINDOW + 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words as runs of anything but white space; and runs of letters (1), digits (2), signs (3).
BLANKS = np.ones(256, np.uint8)
BLANKS[[9, 10, 11, 12, 13, 32]] = 0
KINDS = BLANKS * 3
KINDS[48:58] = 2
KINDS[65:91] = KINDS[97:123] = KINDS[128:] = 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; NULL is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return bounds, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def slices(bounds: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes together."""
    i, rows = 0, len(bounds) - 1
    while i < rows:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, "right")) - 1)
        yield i, min(j, rows)
        i = j


class Words:
    """The words of some rows: hash, row, kind, capitals and length of each, in order."""

    def __init__(self, hash, row, kind, caps, length):
        self.hash, self.row, self.kind, self.caps, self.length = hash, row, kind, caps, length


def words(bounds: np.ndarray, data: np.ndarray, kinds: np.ndarray = BLANKS) -> Words:
    """The words of all rows of ``bounds``, lower-cased over A-Z before they are hashed.

    A word is a longest run of bytes of one kind other than 0, within a row.
    """
    found: list[tuple] = []
    open_end = -1
    for low in range(int(bounds[0]), int(bounds[-1]), WINDOW):
        high = min(low + WINDOW, int(bounds[-1]))
        part = data[low:high]
        kind = kinds[part]
        first, last = np.searchsorted(bounds, [low, high])
        new = np.empty(high - low, bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        starts_here = bounds[first:last] - low
        new[starts_here[starts_here < high - low]] = True
        at = np.flatnonzero(new)
        end = np.append(at[1:], high - low)
        real = kind[at] > 0
        at, end = at[real], end[real]
        low_cased = LOWER[part]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((low_cased.astype(np.uint64) + np.uint64(1)) * _POWER[: high - low], out=sums[1:])
        capitals = np.zeros(high - low + 1, np.int32)
        np.cumsum(low_cased != part, out=capitals[1:])
        hashes = (sums[end] - sums[at]) * _INVERSE[at]
        row = np.searchsorted(bounds, at + low, "right") - 1
        kind, caps, length = kind[at], capitals[end] - capitals[at], end - at
        if len(at) and open_end == low and at[0] == 0 and not np.any(bounds == low) \
                and found[-1][2][-1] == kind[0]:
            before = found[-1]
            ahead = pow(BASE, int(before[4][-1]), 1 << 64)
            before[0][-1] = np.uint64((int(before[0][-1]) + int(hashes[0]) * ahead) % (1 << 64))
            before[3][-1] += caps[0]
            before[4][-1] += length[0]
            hashes, row, kind, caps, length = (x[1:] for x in (hashes, row, kind, caps, length))
        if len(at) and end[-1] == high - low:
            open_end = high
        if len(hashes):
            found.append((hashes, row, kind, caps, length))
    if not found:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, none, none)
    hashes, row, kind, caps, length = (np.concatenate(x) for x in zip(*found))
    return Words(mix(hashes ^ (length.astype(np.uint64) << np.uint64(40))), row, kind, caps, length)


def per_row(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries begin, and the last one's end; ``row`` ascends."""
    return np.searchsorted(row, np.arange(rows + 1))


def chain(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k neighbours in order, for every place that has k."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n] + np.uint64(1))
    return out
