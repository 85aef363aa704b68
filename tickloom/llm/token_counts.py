"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch are one ragged array of symbols. In each step every sequence merges all
occurrences of its own lowest-ranked pair at once; sequences without a mergeable pair leave with the
number of symbols they hold. Sequences of more than ``LONG`` symbols keep their pairs filed by rank, so that a step
costs what it merges and not the sequence's length. Each distinct chunk of text is counted once for as long as
it is remembered.

Defined results: NULL and empty text count 0 tokens and 0 bytes; rows are counted one by one, so repeated
rows each give a row; columns of the input other than the two named ones are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .encoding import byte_level_chunks
from .ragged import Hasher, Memo, spans_text, text_slices

_NONE = np.int64(1 << 40)
#: Symbols from which on a sequence's pairs are filed by rank.
LONG = 256


class MergeTable:
    """Ranked pairs of a byte-level vocabulary file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        letter = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}
        self.first = np.array([vocab[letter[b]] for b in range(256)], np.int64)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)


def merged_lengths(table: MergeTable, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Symbols left in each sequence when no pair can be merged. ``symbols`` are the joined sequences."""
    counts = sizes.astype(np.int64).copy()
    live = np.flatnonzero(sizes > 1)  # sequences that may still merge
    keep = np.repeat(sizes > 1, sizes)
    symbols, sizes = symbols[keep], sizes[live].astype(np.int64)
    while len(live):
        starts = np.cumsum(sizes) - sizes
        rank = np.full(len(symbols), _NONE)
        rank[:-1] = table.rank(symbols[:-1], symbols[1:])
        rank[starts + sizes - 1] = _NONE  # the last symbol of a sequence has no right neighbour
        best = np.minimum.reduceat(rank, starts)
        done = best == _NONE
        owner = np.repeat(np.arange(len(live)), sizes)
        hit = (rank == best[owner]) & (rank < _NONE)
        # In a run of equal hits (a a a), every second one counts, from the left.
        at = np.flatnonzero(hit)
        if len(at):
            new_run = np.ones(len(at), bool)
            new_run[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
            run = np.flatnonzero(new_run)
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[place % 2 == 0]
            symbols[at] = table.made[rank[at]]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            sizes = sizes - np.bincount(owner[at], minlength=len(live))
        else:
            gone = np.zeros(len(symbols), bool)
        done |= sizes == 1
        counts[live] = sizes
        stay = ~gone & ~done[owner]
        symbols, sizes, live = symbols[stay], sizes[~done], live[~done]
    return counts


class _Filed:
    """Positions of pairs by rank, lowest rank first."""

    def __init__(self):
        self.ranks: list[int] = []
        self.places: dict[int, list[np.ndarray]] = {}

    def add(self, ranks: np.ndarray, at: np.ndarray) -> None:
        inner = ranks < _NONE
        ranks, at = ranks[inner], at[inner]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        cut = np.append(np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])), len(ranks)).tolist()
        for a, b in zip(cut[:-1], cut[1:]):
            rank = int(ranks[a])
            if rank not in self.places:
                self.places[rank] = []
                heapq.heappush(self.ranks, rank)
            self.places[rank].append(at[a:b])

    def lowest(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.ranks)
        return rank, np.unique(np.concatenate(self.places.pop(rank)))


def merged_long(table: MergeTable, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """As ``merged_lengths``, in steps that touch only the neighbours of what they merge."""
    n = len(symbols)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    symbols, counts = symbols.copy(), sizes.astype(np.int64)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(sizes)
    after[ends - 1] = -1  # the last symbol of a sequence has no right neighbour
    before[ends - sizes] = -1
    rank = np.full(n, _NONE)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = table.rank(symbols[inner], symbols[inner + 1])
    filed = _Filed()
    filed.add(rank[inner], inner)
    while filed.ranks:
        lowest, at = filed.lowest()
        at = at[rank[at] == lowest]  # what a merge has changed since is filed elsewhere
        if not len(at):
            continue
        # In a run of equal hits (a a a), every second one counts, from the left.
        new_run = np.ones(len(at), bool)
        new_run[1:] = after[at[:-1]] != at[1:]
        run = np.flatnonzero(new_run)
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[place % 2 == 0]
        gone = after[at]
        symbols[at] = table.made[lowest]
        rank[gone] = _NONE
        after[at] = after[gone]
        linked = after[at] >= 0
        before[after[at][linked]] = at[linked]
        counts -= np.bincount(owner[at], minlength=len(counts))
        left = before[at]
        changed = np.unique(np.concatenate([at, left[left >= 0]]))
        right = after[changed]
        rank[changed] = np.where(right >= 0, table.rank(symbols[changed], symbols[right]), _NONE)
        filed.add(rank[changed], changed)
    return counts


class Counter:
    """Counts tokens of texts; one for each worker process."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        #: Splits a text before any merge, as byte-level pre-tokenization does.
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.special = regex.compile("|".join(map(regex.escape, self.table.specials)) or r"(?!)")
        self.memo = Memo(dtype=np.uint32)

    def pieces(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            for k, segment in enumerate(self.special.split(text)):
                extra[i] += k > 0
                found = self.pattern.findall(segment)
                parts += found
                owner += [i] * len(found)
        distinct = list(dict.fromkeys(parts))
        raw = [p.encode() for p in distinct]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols, long = self.table.first[np.frombuffer(b"".join(raw), np.uint8)], sizes > LONG
        counts, inside = np.empty(len(raw), np.int64), np.repeat(long, sizes)
        counts[~long] = merged_lengths(self.table, symbols[~inside], sizes[~long])
        counts[long] = merged_long(self.table, symbols[inside], sizes[long])
        by_part = dict(zip(distinct, counts.tolist()))
        each = np.fromiter((by_part[p] for p in parts), np.int64, len(parts))
        return extra + np.bincount(np.asarray(owner, np.int64), weights=each, minlength=len(texts)).astype(np.int64)

    def counts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        starts, firsts = byte_level_chunks(data, bounds)
        if not len(starts):
            return np.zeros(len(bounds) - 1, np.int64)
        ends = np.append(starts[1:], len(data))

        def make(at):
            found = self.pieces(spans_text(data, starts[at], ends[at]))
            return found, np.ones(len(found), np.int64)

        rows = self.memo.rows(Hasher(data).spans(starts, ends), make)
        sums = np.append(0, np.cumsum(self.memo.flat[self.memo.begin[rows]].astype(np.int64)))
        totals = np.diff(sums[firsts])
        raw = data.tobytes()
        if any(s.encode() in raw for s in self.table.specials):  # white space before one is split otherwise
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if any(s.encode() in raw[a:b] for s in self.table.specials):
                    totals[i] = self.pieces([raw[a:b].decode("utf-8", "replace")])[0]
        return totals


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = 512, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row. ``tokenizer``: a byte-level BPE .json file."""
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches):
        counter = _counter(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, last, data, bounds in text_slices(texts):
                n = counter.counts(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), pa.array(np.diff(bounds)), pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents.select(id_column, text_column).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
