"""New columns from the texts of a DataFrame, computed batch by batch with numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encoding import encoder
from .ragged import SLICE_BYTES, Memo, text_slices

#: Turns (data, bounds) of a slice of texts into one Arrow array for each added column.
Maker = Callable[[np.ndarray, np.ndarray], list[pa.Array]]


def tidy(run: Callable[[Iterator], Iterator], encodes: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` of a ``mapInArrow``, in a worker that stays for the tasks of other operators.

    Encoders that earlier tasks have kept go first, unless ``run`` ``encodes`` itself; at the end, the
    allocators give back what they keep.
    """
    def tidied(batches):
        if not encodes:
            encoder.cache_clear()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return tidied


def with_text_columns(df: DataFrame, text_column: str, added: str, make: Callable[[], Maker],
                      size: int = SLICE_BYTES) -> DataFrame:
    """``df`` without ``text_column``, and the columns ``added`` (a DDL string) computed from it.

    ``make`` runs once for each task, on about ``size`` bytes of text at a time. A column of ``df`` whose name is among the added ones is replaced.
    """
    new = T.StructType.fromDDL(added)
    names = {n.lower() for n in new.names}
    kept = [c for c in df.columns if c.lower() not in names and c != text_column]
    source = df.select(F.col(f"`{text_column}`").alias("_text"), *[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*source.schema.fields[1:], *new.fields])
    titles = schema.names

    def run(batches):
        maker = make()
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(0), size):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *maker(data, bounds)], titles)

    return source.mapInArrow(tidy(run), schema)


def sample_rows(df: DataFrame, n: int, id_column: str, total: int | None = None) -> DataFrame:
    """About ``n`` rows, at most ``2 * n``, picked by a hash of the id: the same ones at any number of partitions.

    Nothing is sorted, so no task sends more than its share. ``total``: rows of ``df``, if known.
    """
    total = df.count() if total is None else total
    place = F.xxhash64(F.col(id_column)) / F.lit(2.0 ** 64) + 0.5  # evenly in 0 to 1
    return df if total <= n else df.where(place < n / total).limit(2 * n)


class Table:
    """Rows of distinct 64-bit keys, looked up in bulk: an open-addressing table that is filled once."""

    def __init__(self, keys: np.ndarray):
        self.memo = Memo(limit=max(16, len(keys)))
        self.memo._place(keys.astype(np.uint64), np.arange(len(keys), dtype=np.int32))

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        return self.memo._find(keys)[0]


def unique_marker(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
