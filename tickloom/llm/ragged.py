"""Texts of an Arrow batch as one byte buffer, and vectorised words and hashes over it.

A batch of texts is a ``uint8`` buffer with ``bounds``: text ``i`` is ``data[bounds[i]:bounds[i + 1]]``.
All helpers take and give numpy arrays; nothing here loops over bytes or words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once. A longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: ``[\x20\x09-\x0D]``: what separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(20240131).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW_VALUES = _VALUES[_LOWER]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, data, bounds) for runs of rows of about ``size`` bytes; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << (int(n) + 1).bit_length())
    held = next((v for k, v in _POWERS.items() if k >= n + 1), None)
    if held is None:
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            factor = np.full(size, np.uint64(base))
            factor[0] = 1
            both.append(np.multiply.accumulate(factor))
        _POWERS.clear()
        _POWERS[size] = held = (both[0], both[1])
    return held


def mix(h: np.ndarray) -> np.ndarray:
    """64 bits to 64 well-mixed bits, one to one."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Hasher:
    """64-bit hashes of any spans of one buffer, from one pass over it."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        self.up, self.down = _powers(len(data))
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum((_LOW_VALUES if lower else _VALUES)[data] * self.up[:len(data)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spans_of(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True bytes within each text: (starts, ends, index of each text's first run)."""
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside
    after = np.empty(n + 1, bool)
    after[n] = False
    after[:n] = inside
    starts = np.flatnonzero(after & (~before | cut))
    ends = np.flatnonzero(before & (~after | cut))
    return starts, ends, np.searchsorted(starts, bounds)


def words_of(data: np.ndarray, bounds: np.ndarray, lower: bool = True):
    """Words ``[^\\x20\\x09-\\x0D]+``, lower-cased A-Z: (hashes, starts, ends, first word of each text)."""
    starts, ends, firsts = spans_of(~SPACE[data], bounds)
    return Hasher(data, lower).spans(starts, ends), starts, ends, firsts


def lower_latin(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z and U+00C0 to U+00DE in lower case (UTF-8: the second byte after 0xC3)."""
    out = _LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    out[second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``starts[i] .. starts[i] + lengths[i] - 1``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def spans_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    whole = data.tobytes()
    return [whole[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]


class Memo:
    """Integer sequences by 64-bit key, for what repeats within a task: an open-addressing table in numpy.

    Emptied when ``limit`` keys are held, so its memory is bounded (about 45 bytes a key and the values).
    """

    def __init__(self, limit: int = 1_500_000, dtype=np.uint16):
        self.limit, self.dtype = limit, dtype
        self.mask = np.uint64((1 << (2 * limit - 1).bit_length()) - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(int(self.mask) + 1, np.uint64)
        self.slots = np.full(int(self.mask) + 1, -1, np.int32)
        self.held, self.used = 0, 0
        self.flat = np.zeros(1 << 16, self.dtype)
        self.begin = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int32)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each key or -1, and the slot where the search ended."""
        slots = (keys & self.mask).astype(np.int64)
        rows = self.slots[slots]
        open_ = np.flatnonzero((rows >= 0) & (self.keys[slots] != keys))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & int(self.mask)
            at = slots[open_]
            rows[open_] = self.slots[at]
            open_ = open_[(rows[open_] >= 0) & (self.keys[at] != keys[open_])]
        return rows, slots

    def _place(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Put distinct new keys into free slots; of keys that meet in a slot, one goes in at a time."""
        while len(keys):
            _, slots = self._find(keys)
            _, winners = np.unique(slots, return_index=True)
            self.keys[slots[winners]] = keys[winners]
            self.slots[slots[winners]] = rows[winners]
            rest = np.ones(len(keys), bool)
            rest[winners] = False
            keys, rows = keys[rest], rows[rest]

    def _room(self, rows: int, values: int) -> None:
        if self.held + rows > len(self.begin):
            more = max(rows, len(self.begin) // 2)
            self.begin = np.concatenate([self.begin, np.zeros(more, self.begin.dtype)])
            self.size = np.concatenate([self.size, np.zeros(more, self.size.dtype)])
        if self.used + values > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(values, len(self.flat) // 2), self.dtype)])

    def rows(self, hashes: np.ndarray, make) -> np.ndarray:
        """Row of each hash; ``make(positions)`` gives (flat, sizes) for the new ones' first positions."""
        rows, _ = self._find(hashes)
        missing = np.flatnonzero(rows < 0)
        if not len(missing):
            return rows
        new, first = np.unique(hashes[missing], return_index=True)
        if self.held and self.held + len(new) > self.limit:
            self.clear()
            return self.rows(hashes, make)
        flat, sizes = make(missing[first])
        self._room(len(new), len(flat))
        n = self.held
        self.flat[self.used:self.used + len(flat)] = flat
        self.begin[n:n + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.size[n:n + len(new)] = sizes
        if n + len(new) <= self.limit:
            self._place(new, np.arange(n, n + len(new), dtype=np.int32))
            self.held, self.used = n + len(new), self.used + len(flat)
        rows[missing] = n + np.searchsorted(new, hashes[missing])
        return rows

    def joined(self, rows: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.begin[rows], self.size[rows])]
