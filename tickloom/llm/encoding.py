"""Exact token ids of whole texts, encoding each distinct chunk of a task once.

A text is cut only where the tokenizer's own pre-tokenization always cuts, whatever stands around: the
ids of the chunks, joined, are the ids of the text. Texts that hold a special string are encoded whole.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .ragged import Hasher, Memo, SPACE, spans_of, spans_text

#: First bytes that may begin a white-space character outside ASCII (U+0085 to U+3000).
_UNSURE = np.zeros(256, bool)
_UNSURE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[0x1C:0x20] = True  # separators that some pattern engines count as white space
_PLAIN_ASCII = np.zeros(256, bool)
_PLAIN_ASCII[0x21:0x7F] = True
_SOLID = ~SPACE & ~_UNSURE & ~_CONTROL  # surely begins a character that is not white space

#: A word of Latin letters, after a space or not, before a mark or not: two pre-tokens at most.
_PLAIN = re.compile(r"( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([.,;:!?]?)")


def _byte_level_table() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 onwards."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: 256 + n for n, b in enumerate(rest)}


_BYTE_LEVEL = _byte_level_table()
_SPACE = chr(_BYTE_LEVEL[0x20])


def byte_level_chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks for byte-level pre-tokenization: cut before a space that a solid character follows, and
    on both sides of a line feed between two solid ones. Gives (starts, first chunk of each text)."""
    n = len(data)
    inner = np.zeros(n + 1, bool)
    if n > 1:
        solid = _SOLID[data]
        inner[:n - 1] = (data[:-1] == 0x20) & solid[1:]
    if n > 2:
        feed = (data[1:-1] == 0x0A) & _PLAIN_ASCII[data[:-2]] & solid[2:]
        inner[1:n - 1] |= feed
        inner[2:n] |= feed
    inner[bounds[bounds < n]] = True
    inner[n] = False
    starts = np.flatnonzero(inner)
    return starts, np.searchsorted(starts, bounds)


class Encoder:
    """Ids of texts by a tokenizer file; ``kind`` is ``byte`` (byte level) or ``word`` (white space dropped)."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.kind, self.memo = kind, Memo(dtype=dtype)
        self.marks: dict[str, list[int]] = {}  # six at most

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of Latin letters go straight to the model; all other texts through the whole tokenizer."""
        ids: list = [None] * len(texts)
        tokenize, spaced = self.tokenizer.model.tokenize, self.kind == "byte"
        other = []
        for i, text in enumerate(texts):
            plain = _PLAIN.fullmatch(text)
            if plain is None or (not spaced and text[0] == " "):
                other.append(i)
                continue
            word, end = plain.groups()
            if word.isascii():
                word = word.replace(" ", _SPACE) if spaced else word.lower()
            elif spaced:
                word = word.encode().decode("latin-1").translate(_BYTE_LEVEL)
            else:
                other.append(i)
                continue
            ids[i] = [t.id for t in tokenize(word)]
            if end:
                ids[i] += self._mark(end)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([texts[i] for i in other], add_special_tokens=False)):
            ids[i] = e.ids
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), self.memo.dtype, int(sizes.sum()))
        return flat, sizes

    def _mark(self, mark: str) -> list[int]:
        if mark not in self.marks:
            self.marks[mark] = [t.id for t in self.tokenizer.model.tokenize(mark)]
        return self.marks[mark]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, bounds of each text's ids)."""
        if self.kind == "byte":
            starts, firsts = byte_level_chunks(data, bounds)
            ends = np.append(starts[1:], len(data))
        else:
            starts, ends, firsts = spans_of(~SPACE[data], bounds)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        hashes = Hasher(data).spans(starts, ends)
        rows = self.memo.rows(hashes, lambda at: self._encode(spans_text(data, starts[at], ends[at])))
        sums = np.append(0, np.cumsum(self.memo.size[rows]))
        flat, id_bounds = self.memo.joined(rows), sums[firsts]
        whole = self._with_specials(data, bounds)
        return self._replaced(flat, id_bounds, whole) if whole else (flat, id_bounds)

    def _with_specials(self, data: np.ndarray, bounds: np.ndarray) -> dict[int, np.ndarray]:
        raw = data.tobytes()
        found: dict[int, np.ndarray] = {}
        if not any(s.encode() in raw for s in self.specials):
            return found
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            text = raw[a:b]
            if any(s.encode() in text for s in self.specials):
                found[i] = self._encode([text.decode("utf-8", "replace")])[0]
        return found

    @staticmethod
    def _replaced(flat, id_bounds, whole):
        parts = [whole.get(i, flat[id_bounds[i]:id_bounds[i + 1]]) for i in range(len(id_bounds) - 1)]
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


@functools.lru_cache(maxsize=4)
def encoder(path: str, kind: str) -> Encoder:
    """One encoder for each worker process, kept for its next tasks."""
    return Encoder(path, kind)


def with_last_id(flat: np.ndarray, bounds: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids with ``last`` appended."""
    return np.insert(flat, bounds[1:], last), bounds + np.arange(len(bounds))


def byte_lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
