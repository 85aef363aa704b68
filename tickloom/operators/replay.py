"""The per-partition replay of book updates: runs inside Python workers, over Arrow batches."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# Fixed value: a level whose quantity is below this is a delete.
EMPTY_QUANTITY = 1e-9

# Roles of a row: a level carried in, an update without output, an update with output.
OPENING, SILENT, EMIT = 0, 1, 2

_BATCH_LEVELS = 500_000  # levels per output batch: whole books of deep instruments stay small in memory


class _Side:
    """Live levels of one side, best first. A rank is the price, negated for bids.

    Prices and quantities lie in arrays beside the ranks, so that a whole side is given out by a copy.
    """

    __slots__ = ("depth", "prices", "quantities", "ranks", "sign", "stale", "top")

    def __init__(self, sign: int, depth: int | None):
        self.sign, self.depth = sign, depth
        self.ranks: list[float] = []
        self.prices, self.quantities = np.empty(16), np.empty(16)
        self.stale, self.top = False, (np.empty(0), np.empty(0))

    def write(self, price: float, quantity: float, shown_price: float, shown_quantity: float) -> None:
        rank, live = self.sign * price, len(self.ranks)
        place = bisect_left(self.ranks, rank)
        known = place < live and self.ranks[place] == rank
        if quantity < EMPTY_QUANTITY:
            if not known:
                return
            del self.ranks[place]
            for values in (self.prices, self.quantities):
                values[place:live - 1] = values[place + 1:live]
        elif known:
            self.quantities[place] = shown_quantity
        else:
            self.ranks.insert(place, rank)
            if live == len(self.prices):
                self.prices, self.quantities = (np.append(v, np.empty(live)) for v in (self.prices, self.quantities))
            for values, value in ((self.prices, shown_price), (self.quantities, shown_quantity)):
                values[place + 1:live + 1] = values[place:live]
                values[place] = value
        if self.depth is None or place < self.depth:
            self.stale = True

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        if self.stale:
            live = len(self.ranks)
            shown = live if self.depth is None else min(live, self.depth)
            self.top = self.prices[:shown].copy(), self.quantities[:shown].copy()
            self.stale = False
        return self.top


class _Output:
    """Rows to emit from one input batch, with the levels of both sides, asks first."""

    def __init__(self) -> None:
        self.rows: list[int] = []
        self.counts: list[int] = []  # levels of the asks and of the bids, row by row
        self.prices: list[np.ndarray] = [np.empty(0)]
        self.quantities: list[np.ndarray] = [np.empty(0)]
        self.levels = 0

    def add(self, row: int, books: tuple[_Side, _Side]) -> None:
        self.rows.append(row)
        for side in books:
            prices, quantities = side.best()
            self.prices.append(prices)
            self.quantities.append(quantities)
            self.counts.append(len(prices))
            self.levels += len(prices)

    def full(self) -> bool:
        return self.levels > _BATCH_LEVELS

    def batch(self, source: pa.RecordBatch, carried: Sequence[str]) -> pa.RecordBatch:
        rows = source.take(pa.array(self.rows, pa.int64()))
        counts = np.array(self.counts, dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        level = np.arange(ends[-1]) - np.repeat(ends[:-1], counts)
        ask = np.repeat(np.arange(len(counts)) % 2 == 0, counts)
        levels = pa.StructArray.from_arrays(
            [pa.array(ask), pa.array(level.astype(np.int32)), pa.array(np.concatenate(self.prices)),
             pa.array(np.concatenate(self.quantities))],
            names=["ask", "level", "price", "quantity"],
        )
        book = pa.ListArray.from_arrays(pa.array(ends[::2].astype(np.int32)), levels)
        columns = [rows.column(c) for c in (*carried, "_pos")]
        return pa.RecordBatch.from_arrays([*columns, book], names=[*carried, "pos", "book"])


    def sides(self, source: pa.RecordBatch, carried: Sequence[str]) -> pa.RecordBatch:
        """A row for each side of each book, asks first: prices and quantities as lists."""
        rows = source.take(pa.array(np.repeat(np.array(self.rows, np.int64), 2)))
        ends = pa.array(np.concatenate([[0], np.cumsum(np.array(self.counts, np.int64))]).astype(np.int32))
        names = pa.array(["ask", "bid"]).take(pa.array(np.arange(len(self.counts)) % 2))
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(v))) for v in (self.prices, self.quantities)]
        columns = [rows.column(c) for c in (*carried, "_pos")]
        return pa.RecordBatch.from_arrays([*columns, names, *lists], names=[*carried, "pos", "side", "prices", "quantities"])


def replay(depth: int | None, carried: Sequence[str], shown: bool = False, flat: bool = False):
    """Arrow batches of sorted updates -> the rows to emit, with both sides of the book, or (``flat``) a row for each side.

    ``shown``: levels are given out by the columns ``_shown_price`` and ``_shown_quantity``.
    """
    given_out = ("_shown_price", "_shown_quantity") if shown else ()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _Side(1, depth), _Side(-1, depth)
        for batch in batches:
            starts, writes, prices, quantities, roles, *given = (
                batch.column(c).to_numpy(zero_copy_only=False).tolist()
                for c in ("_starts", "_write", "price", "quantity", "_role", *given_out)
            )
            shown_prices, shown_quantities = given or (prices, quantities)
            output = _Output()
            finish = output.sides if flat else output.batch
            for i, write in enumerate(writes):
                if starts[i]:
                    books = _Side(1, depth), _Side(-1, depth)
                if write:
                    books[write < 0].write(prices[i], quantities[i], shown_prices[i], shown_quantities[i])
                if roles[i] == EMIT:
                    output.add(i, books)
                    if output.full():
                        yield finish(batch, carried)
                        output = _Output()
                        finish = output.sides if flat else output.batch
            yield finish(batch, carried)

    return run
