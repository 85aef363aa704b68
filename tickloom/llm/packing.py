"""Packing of token sequences by large-item matching and best fit.

The packing depends on lengths alone, and there are at most ``capacity`` of them: a histogram is counted
with Spark, the plan is made from it (large pieces, above a third of the capacity, pair at most twice in
a sequence, the longest with the longest that fits; smaller ones, longest first, go to the tightest
gap), and every piece finds its place by its rank among the pieces of its length. The driver holds the
histogram and the plan, both bounded by the capacity and not by the number of documents.

Defined results: NULL text is empty and gives the end id alone; only documents longer than the capacity are
cut; repeated rows and ids are packed one by one; an empty table gives no row.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .encoding import encoder, with_last_id
from .mapping import tidy
from .ragged import text_slices

#: Least pieces ranked in one window. A length of n pieces is split into groups of the square root of n, so
#: neither the groups nor their number in one window grow with n.
RANK_ROWS = 100


class Gaps:
    """Open sequences by what is left in them: runs (first sequence, number of sequences)."""

    def __init__(self):
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sizes: list[int] = []

    def put(self, gap: int, first: int, n: int) -> None:
        if gap > 0 and n > 0:
            if not self.runs[gap]:
                bisect.insort(self.sizes, gap)
            self.runs[gap].append((first, n))

    def tightest(self, size: int) -> tuple[int, int, int] | None:
        at = bisect.bisect_left(self.sizes, size)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, n = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.sizes[at]
        return gap, first, n


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of places ``(length, rank, n, each, sequence, offset)``.

    The ``n * each`` pieces of ``length`` from ``rank`` on go to ``n`` sequences from ``sequence`` on,
    ``each`` to a sequence, one after the other from ``offset``.
    """
    left = {k: n for k, n in histogram.items() if n}
    ranks: dict[int, int] = defaultdict(int)
    places, gaps, opened = [], Gaps(), 0

    def place(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        places.append((length, ranks[length], n, each, sequence, offset))
        ranks[length] += n * each
        left[length] -= n * each

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        longest = large[-1]
        if not left[longest]:
            large.pop()
            continue
        partner = None
        for at in range(bisect.bisect_right(large, capacity - longest) - 1, -1, -1):
            if left[large[at]] > (large[at] == longest):
                partner = large[at]
                break
            if not left[large[at]]:
                del large[at]
        if partner is None:
            n, gap = left[longest], capacity - longest
            place(longest, n, 1, opened, 0)
        elif partner == longest:
            n, gap = left[longest] // 2, capacity - 2 * longest
            place(longest, n, 2, opened, 0)
        else:
            n, gap = min(left[longest], left[partner]), capacity - longest - partner
            place(longest, n, 1, opened, 0)
            place(partner, n, 1, opened, longest)
        gaps.put(gap, opened, n)
        opened += n

    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            found = gaps.tightest(length)
            if found is None:
                found = (capacity, opened, -(-left[length] // (capacity // length)))
                opened += found[2]
            gap, first, n = found
            each = min(gap // length, left[length])
            used = min(n, left[length] // each)
            place(length, used, each, first, capacity - gap)
            gaps.put(gap - each * length, first, used)
            gaps.put(gap, first + used, n - used)
    return places


def cut_pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int, kind: str = "word",
               keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): every document's ids with ``end_id``, cut at ``capacity``."""
    id_type = documents.schema[id_column].dataType.simpleString()

    def run(batches):
        coder = encoder(tokenizer, kind)
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1)):
                flat, ends = with_last_id(*coder.encode(data, bounds), end_id)
                sizes = np.diff(ends)
                n = -(-sizes // capacity)
                owner = np.repeat(np.arange(last - first), n)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(sizes[owner] - start, capacity)
                raw, at = flat.astype("<u4"), ends[owner] + start
                cuts = list(zip(at.tolist(), (at + length).tolist()))
                columns = [batch.column(0).slice(first, last - first).take(pa.array(owner)),
                           pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                           pa.array([zlib.crc32(raw[a:b]) for a, b in cuts], pa.int64())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return documents.select(id_column, text_column).mapInArrow(tidy(run, encodes=True), schema + ", ids array<int>" * keep_ids)


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Stored ``pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    places = plan(histogram, capacity)
    table = pa.table({name: pa.array([p[i] for p in places], pa.int64()) for i, name in enumerate(
        ("length", "first_rank", "sequences", "each", "first_sequence", "first_offset"))})
    sizes = pa.table({"length": pa.array(list(histogram), pa.int64()),
                      "groups": pa.array([-(-n // max(RANK_ROWS, math.isqrt(n))) for n in histogram.values()],
                                         pa.int64())})

    # Rank among equal lengths: within a group of a length, plus the sizes of the groups before.
    grouped = (pieces.join(F.broadcast(spark.createDataFrame(sizes)), "length")
               .withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()),
                                          F.col("groups"))))
    grouped = stage(grouped.drop("groups"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (grouped.groupBy("length", "part").count()
               .withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (grouped.withColumn("_at", F.row_number().over(within) - 1).join(offsets, ["length", "part"])
              .withColumn("_rank", F.col("_at") + F.col("before")))
    at = F.col("_rank") - F.col("first_rank")
    inside = (F.col("length") == F.col("p_length")) & (at >= 0) & (at < F.col("sequences") * F.col("each"))
    placed = ranked.join(F.broadcast(spark.createDataFrame(table).withColumnRenamed("length", "p_length")), inside)
    return placed.select(
        *pieces.columns, (F.col("first_sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("first_offset") + F.pmod(at, F.col("each")) * F.col("length")).alias("offset"))


def pack(documents: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, kind: str = "word",
         keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every piece with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``)."""
    pieces = stage(cut_pieces(documents, tokenizer, capacity, end_id, kind, keep_ids, id_column, text_column))
    return place_pieces(pieces, capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces that were packed with ``keep_ids``; at most ``capacity`` ids each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
