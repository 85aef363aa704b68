"""Near duplicates by SimHash, with a covering code's words as meeting points (anchors).

Fingerprint: a text's 4-word shingles, repeats included, are hashed (XXH64, seed 42); a bit is 1 if it is set in
more than half of the hashes.

Search for fingerprints that differ in at most 4 bits: the 64 bits fall into three blocks (22, 21 and 21 bits). A
linked pair differs in at most one bit of some block, as 3 * 2 > 4. Each block has a covering code: 15 bits by the
perfect Hamming code, the rest as they are, so every value lies within ``RADIUS`` = 1 of a code word. Code words
are the anchors. A fingerprint is at home at its nearest anchor and visits every anchor within radius plus
threshold (1 + 1), 14.5 to 16 of them in a block on average; its partner's home is among them. At an anchor, homes are compared
with visitors, over all 64 bits. An anchor sees about one in 9,000 of unrelated fingerprints.

Equal fingerprints are one node from the start, so a group of copies costs one row, and a tight group cannot grow
beyond the points of its ball. An anchor with more than ``HOMES`` homes is dealt into blocks of homes, visitors go
to each block and are streamed past it: memory is bounded by one block and one batch. What comes out are links
that join what is still apart (fewer than the members), not pairs.

Defined results: NULL, empty and blank texts have fingerprint zero and are linked like any other; repeated rows
share a component; rows without an id count in no ``component_id`` (NULL if a component has no id); other columns
of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .near_dedup import components
from .ragged import SPACE, ranges, spans_of, text_slices

WORDS, SEED, DISTANCE, RADIUS = 4, 42, 4, 1
#: Blocks of the fingerprint as (first bit, bits), and bits under the Hamming code in each.
BLOCKS, CODED = ((0, 22), (22, 21), (43, 21)), 15
HOMES = 4096
#: Shingles of one text hashed at a time.
_STEP = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _spread() -> np.ndarray:
    """For each byte its bits as the eight bytes of one number: sums of up to 255 of them do not overflow."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64).ravel()


_SPREAD = _spread()


def _bit_counts(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, for runs of ``sizes`` (> 0) hashes."""
    parts = -(-sizes // 255)
    at = ranges(np.zeros(len(sizes), np.int64), parts) * 255 + np.repeat(np.cumsum(sizes) - sizes, parts)
    raw = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    sums = np.empty((len(at), 8), np.uint64)
    for k in range(8):
        sums[:, k] = np.add.reduceat(_SPREAD[raw[:, k]], at)
    return np.add.reduceat(sums.view(np.uint8).reshape(-1, 64), np.cumsum(parts) - parts, axis=0, dtype=np.int64)


def fingerprints(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    starts, ends, firsts = spans_of(~SPACE[data], bounds)
    lengths = ends - starts
    # One buffer of the lower-cased words with a space after each: a shingle is one slice of it.
    after = np.cumsum(lengths + 1)
    begin = after - lengths - 1
    joined = np.full(int(after[-1]) if len(after) else 0, 32, np.uint8)
    joined[ranges(begin, lengths)] = _LOWER[data[ranges(starts, lengths)]]
    raw = joined.tobytes()
    counts = np.diff(firsts)
    sizes = np.where(counts >= WORDS, counts - WORDS + 1, counts > 0)
    total = np.zeros((len(counts), 64), np.int64)
    texts = np.flatnonzero(sizes)
    cuts = np.cumsum(sizes[texts])
    first = 0
    while first < len(texts):  # texts of about _STEP shingles; a longer one alone, piece by piece
        done = cuts[first] - sizes[texts[first]]
        last = max(first + 1, int(np.searchsorted(cuts, done + _STEP, "right")))
        some = texts[first:last]
        n = int(cuts[last - 1] - done)
        for low in range(0, n, _STEP):
            high = min(n, low + _STEP)
            own = sizes[some] if len(some) > 1 else np.array([high - low])
            word = ranges(firsts[some] + low, own)
            end = word + np.repeat(np.minimum(counts[some], WORDS), own) - 1
            spans = zip(begin[word].tolist(), (after[end] - 1).tolist())
            hashes = np.array([xxhash.xxh64_intdigest(raw[a:b], SEED) for a, b in spans], np.uint64)
            total[some] += _bit_counts(hashes, own)
        first = last
    bits = 2 * total > sizes[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def _columns(n: int) -> np.ndarray:
    return np.uint32(1) << np.arange(n, dtype=np.uint32)


def syndrome(values: np.ndarray) -> np.ndarray:
    """Syndrome of the low ``CODED`` bits: 0 in a code word, else the position (from 1) of the bit to turn."""
    out = np.zeros(len(values), np.uint32)
    for i in range(CODED):
        out ^= ((values >> np.uint32(i)) & np.uint32(1)) * np.uint32(i + 1)
    return out


def _turned(places: np.ndarray) -> np.ndarray:
    """The bit at each position from 1; nothing at position 0."""
    return (np.uint32(1) << places) >> np.uint32(1)


def anchors(values: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, anchors, home) for every anchor within radius plus threshold of the ``bits``-bit values.

    A code word of the whole block agrees with the free bits freely and is a Hamming code word in the others.
    """
    rows = np.arange(len(values))
    s = syndrome(values)
    nearest = values ^ _turned(s)
    yield rows, nearest, True
    free = _columns(bits)[CODED:]
    for x in free:  # the nearest code word and one free bit: at distance 1 or 2
        yield rows, nearest ^ x, False
    on = np.flatnonzero(s == 0)
    for i in range(len(free)):  # from a code word, two free bits
        for j in range(i):
            yield on, values[on] ^ free[i] ^ free[j], False
    off = np.flatnonzero(s)
    for i in range(1, CODED + 1):  # from elsewhere, the code words at distance 2 within the coded bits
        j = s[off] ^ np.uint32(i)
        pair = j > i
        yield off[pair], values[off[pair]] ^ _turned(np.uint32(i)) ^ _turned(j[pair]), False


def _visits(nodes: DataFrame) -> DataFrame:
    """``key, home, node, fp``: a row for every anchor that a fingerprint visits."""
    def run(batches):
        for batch in batches:
            node, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for k, (first, bits) in enumerate(BLOCKS):
                part = ((fp >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.uint32)
                for rows, anchor, home in anchors(part, bits):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(anchor.astype(np.int64) * len(BLOCKS) + k), pa.array(np.full(len(rows), home)),
                        pa.array(node[rows]), pa.array(fp[rows].view(np.int64))], ["key", "home", "node", "fp"])

    return nodes.select("node", "fp").mapInArrow(run, "key bigint, home boolean, node bigint, fp bigint")


class _Links:
    """Union of nodes: remembers what is joined, so that only links between what is apart come out."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[max(a, b)] = min(a, b)
        return a != b


def close_links(homes: np.ndarray, home_fp: np.ndarray, nodes: np.ndarray, fp: np.ndarray, links: _Links):
    """Links (a, b) between homes and visitors that differ in at most ``DISTANCE`` bits and were apart."""
    out = []
    step = max(1, (1 << 20) // max(1, len(homes)))
    for low in range(0, len(nodes), step):
        near = np.bitwise_count(fp[low:low + step, None] ^ home_fp[None, :]) <= DISTANCE
        i, j = np.nonzero(near)
        for a, b in zip(nodes[low + i].tolist(), homes[j].tolist()):
            if a != b and links.join(a, b):
                out.append((a, b))
    return out


def _runs(batches) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, np.ndarray]]:
    """((key, block), home, node, fp) for runs of a batch; a group may come in several runs."""
    for batch in batches:
        if len(batch):
            key, block, home, node, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                yield (int(key[x]), int(block[x])), home[x:y], node[x:y], fp[x:y].view(np.uint64)


def _linked(visits: DataFrame) -> DataFrame:
    """Links ``a, b`` of every anchor: homes first, then whoever visits, in blocks of at most about ``HOMES`` homes."""
    def run(batches):
        group, links = None, _Links()
        homes, home_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for where, home, node, fp in _runs(batches):
            if where != group:
                group, links = where, _Links()
                homes, home_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            # Homes are compared with homes before them here, and with themselves.
            new = home.astype(bool)
            homes, home_fp = np.concatenate([homes, node[new]]), np.concatenate([home_fp, fp[new]])
            if len(homes):
                out = np.array(close_links(homes, home_fp, node, fp, links), np.int64).reshape(-1, 2)
                if len(out):
                    yield pa.RecordBatch.from_arrays([pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], ["a", "b"])

    hot = stage(visits.groupBy("key").agg(F.count_if("home").alias("homes")).where(F.col("homes") > HOMES)
                .select("key", F.ceil(F.col("homes") / HOMES).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    if hot.limit(1).count():
        # A visitor goes to every block of its anchor's homes; a home visits the blocks that are not its own.
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        known = visits.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        dealt = known.withColumn("block", every).withColumn("home", F.col("home") & (F.col("block") == own))
    else:
        dealt = visits.withColumn("block", F.lit(0))
    dealt = dealt.select("key", "block", "home", "node", "fp").repartition("key", "block")
    return dealt.sortWithinPartitions("key", "block", F.desc("home")).mapInArrow(run, "a bigint, b bigint")


def simhash_table(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row: the fingerprint as a signed 64-bit number."""
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first),
                    pa.array(fingerprints(data, bounds).astype(np.uint64).view(np.int64))], ["doc_id", "fp"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp bigint")


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row: the least id reachable over links."""
    rows = stage(simhash_table(documents, id_column, text_column))
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
                  .withColumn("node", F.monotonically_increasing_id()))
    links = stage(_linked(stage(_visits(nodes))).distinct())
    labels = components(links)
    named = stage(nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_fp = stage(named.join(least, "label").select("fp", "component_id"))
    result = rows.join(by_fp, "fp")
    return result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
