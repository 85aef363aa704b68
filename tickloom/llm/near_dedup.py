"""Near duplicates by fast similarity sketching, banding and exact verification.

Sketch: a text's distinct 5-word shingles are thrown into ``COORDINATES`` bins, round after round, each round
with its own hash; a bin keeps the least (round, value). A text leaves when all its bins are filled; the
second half of the rounds fills bin after bin by name, so every coordinate is filled for certain, and the
agreement of two sketches concentrates around their Jaccard similarity as that of independent samples.

Candidates: bands of ``ROWS`` coordinates; texts that agree in a band share a bucket. At similarity 0.85 a
pair shares none of the 26 buckets with probability 2.4e-7. Equal sets are one class from the start
(128-bit fingerprints), so exact copies cost one row each.

Links are confirmed on full sets (64-bit shingle hashes). Classes are linked in rounds: first every class
with one member of its buckets, then what still lies in different components with the least and the
greatest member of its buckets, last every remaining pair of a bucket that still holds several components,
in blocks of about ``BLOCK`` members and by sketch, then in blocks of about ``BLOCK_SETS`` members on full sets. No pair of a bucket is
left out unless its two classes are already connected.

Defined results: NULL, empty and blank texts have no shingle and are linked with nothing; repeated rows and
rows of one id with equal text share a class; rows without an id count in no ``component_id`` (NULL if a
component has no id); columns of the input other than the two named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .mapping import tidy
from .ragged import mix, ranges, text_slices, words_of

WORDS, BANDS, ROWS, BLOCK, BLOCK_BYTES, BLOCK_SETS = 5, 26, 5, 256, 2 << 20, 1024
_COLUMNS = 4096
COORDINATES = BANDS * ROWS
#: Ids sent to every executor at most; beyond, texts are fetched by a shuffled join.
BROADCAST_IDS = 500_000
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 20, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = _SEEDS[:WORDS] | np.uint64(1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, joined, and the bounds of each text's."""
    words, _, _, firsts = words_of(data, bounds)
    counts = np.diff(firsts)
    sizes = np.where(counts >= WORDS, counts - WORDS + 1, counts > 0)
    at = ranges(firsts[:-1], sizes)
    owner = np.repeat(np.arange(len(counts)), sizes)
    length = np.minimum(counts, WORDS)[owner]
    padded = np.append(words, np.zeros(WORDS, np.uint64))
    h = length.astype(np.uint64) * _SEEDS[WORDS]
    for k in range(WORDS):
        h += np.where(length > k, padded[at + k], np.uint64(0)) * _STEP[k]
    h = mix(h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(counts) + 1))


def sketches(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of filled coordinates for each text; of a text without shingles all are the greatest value."""
    n, t = len(bounds) - 1, COORDINATES
    table = np.full(n * t, np.uint64(2**64 - 1))
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    for r in range(2 * t):
        if not len(shingles):
            break
        h = mix(shingles ^ _SEEDS[WORDS + 1 + r])
        value = (np.uint64(r) << np.uint64(55)) | (mix(h) >> np.uint64(9))
        bins = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if r < t else r - t
        np.minimum.at(table, owner * t + bins, value)
        full = (table.reshape(n, t) < np.uint64(2**64 - 1)).all(1)
        stay = ~full[owner]
        shingles, owner = shingles[stay], owner[stay]
    return table.reshape(n, t)


def band_keys(table: np.ndarray) -> np.ndarray:
    """One 64-bit key for each text and band."""
    parts = table.reshape(len(table), BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)[None, :] * _SEEDS[0]
    for k in range(ROWS):
        h = mix(h ^ mix(parts[:, :, k] * _STEP[k]))
    return h


def _fingerprints(shingles: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """16 bytes for each set, equal for equal sets."""
    both = np.zeros((len(bounds) - 1, 2), np.uint64)
    for k in range(2):
        sums = np.append(np.uint64(0), np.cumsum(mix(shingles ^ _SEEDS[k])))
        both[:, k] = mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    raw = both.tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def _set_table(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, bands, sketch`` for every row."""
    def run(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1)):
                sets, ends = shingle_sets(data, bounds)
                table = sketches(sets, ends)
                keys = band_keys(table).astype(np.int64)
                short = (mix(table) & np.uint64(0xFFFF)).astype("<u2")
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(np.diff(ends)),
                    pa.array(_fingerprints(sets, ends), pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(last - first + 1, dtype=np.int32) * BANDS),
                                             pa.array(keys.reshape(-1))),
                    pa.array([row.tobytes() for row in short], pa.binary())],
                    ["doc_id", "n_shingles", "set_id", "bands", "sketch"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(
        tidy(run), f"doc_id {kind}, n_shingles bigint, set_id binary, bands array<bigint>, sketch binary")


def _full_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored ``node, shingles`` for the classes in ``wanted`` (doc_id, node, set_id), from their texts."""
    def run(batches):
        for batch in batches:
            for _, _, data, bounds in text_slices(batch.column(0)):
                sets, ends = shingle_sets(data, bounds)
                raw, cuts = sets.tobytes(), (ends * 8).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(_fingerprints(sets, ends), pa.binary()),
                    pa.array([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], ["set_id", "shingles"])

    ids = wanted.select(F.col("doc_id").alias("_id")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = documents.join(ids, documents["doc_id"].eqNullSafe(F.col("_id")), "left_semi").select("text")
    sets = texts.mapInArrow(tidy(run), "set_id binary, shingles binary")
    return stage(sets.join(wanted.select("set_id", "node"), "set_id").drop("set_id").dropDuplicates(["node"]))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored pairs ``a, b`` whose full sets have 100 * intersection >= percent * union."""
    def run(batches):
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")  # two sorted runs: a merge
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep[i] = 100 * common >= percent * (len(both) - common)
            yield batch.select([0, 1]).filter(pa.array(keep))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return stage(joined.mapInArrow(tidy(run), "a bigint, b bigint"))


def components(edges: DataFrame) -> DataFrame:
    """Stored ``node, label``: the least node reachable over stored ``edges`` (a, b), for nodes with an edge."""
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = stage(both.groupBy("a").agg(F.min("b").alias("b"))
                   .select(F.col("a").alias("node"), F.least("a", "b").alias("label")))
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("seen"))
        near = stage(labels.join(seen, labels["node"] == seen["a"])
                     .select("node", "label", F.least("label", "seen").alias("near")))
        further = near.select(F.col("node").alias("_node"), F.col("near").alias("_far"))
        moved = stage(near.join(further, near["near"] == further["_node"])
                      .select("node", F.least("near", "_far").alias("label"),
                              (F.least("near", "_far") < F.col("label")).alias("changed")))
        labels = moved.select("node", "label")
        if not moved.where("changed").limit(1).count():
            return labels


def _apart(rows: DataFrame, columns: tuple[str, ...], labels: DataFrame) -> DataFrame:
    """``rows`` with the label of each named node column as ``<column>_label``; a node without an edge is its own."""
    for c in columns:
        own = labels.select(F.col("node").alias(c), F.col("label").alias("_label"))
        rows = rows.join(own, c, "left").withColumn(f"{c}_label", F.coalesce("_label", c)).drop("_label")
    return rows


def _dealt(members: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``key, lo, hi, own`` and ``columns``: members of a key dealt to ``blocks`` blocks, every two together."""
    dealt = (members.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("_own", "_other").alias("lo"), F.greatest("_own", "_other").alias("hi"),
                     F.col("_own").alias("own"), *columns))
    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def _groups(batches) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first three columns, over the edges of batches."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        keys = [table.column(i).to_numpy() for i in range(3)]
        change = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1]).tolist()
        for x, y in zip(cuts[:-1], cuts[1:]):
            yield table.slice(x, y - x)
        held = table.slice(cuts[-1]).combine_chunks().to_batches()[0]
    if held is not None:
        yield pa.Table.from_batches([held])


def _close(members: DataFrame, least: int) -> DataFrame:
    """``key, node`` of the members that have a partner of another label whose sketch agrees in ``least`` places.

    A pair counts in the first of its common buckets only. ``members``: key, band, node, label, blocks, bands,
    sketch.
    """
    def run(batches):
        for table in _groups(batches):
            n = len(table)
            if n < 2:
                continue
            own, node, label, band = (table.column(i).to_numpy() for i in (3, 4, 5, 6))
            bands = table.column(7).combine_chunks().flatten().to_numpy().reshape(n, BANDS)[:, :band[0]]
            sketch = np.frombuffer(b"".join(table.column(8).to_pylist()), "<u2").reshape(n, COORDINATES)
            same_block = table.column(1)[0].as_py() == table.column(2)[0].as_py()
            close = np.zeros(n, bool)
            for i in range(n):
                others = np.flatnonzero((label != label[i]) & ((node > node[i]) if same_block else (own > own[i])))
                if len(others):
                    others = others[(sketch[others] == sketch[i]).sum(1) >= least]
                    others = others[~(bands[others] == bands[i]).any(1)]
                    if len(others):
                        close[i] = True
                        close[others] = True
            if close.any():
                yield pa.RecordBatch.from_arrays(
                    [table.column(0).combine_chunks().filter(pa.array(close)), pa.array(node[close])], ["key", "node"])

    dealt = _dealt(members, ("node", "label", "band", "bands", "sketch"))
    return dealt.mapInArrow(tidy(run), "key bigint, node bigint").distinct()


def linking_pairs(sets: list[np.ndarray], label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of sets with 100 * intersection >= percent * union that join different labels, until none is left.

    Intersections are products of the incidence of shared shingles, ``_COLUMNS`` shingles at a time.
    """
    n, sizes = len(sets), np.array([len(x) for x in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.append(True, flat[1:] != flat[:-1])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    common = np.zeros((n, n), np.float32)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(column, column[first] + _COLUMNS))
        part = np.zeros((n, min(_COLUMNS, int(column[last - 1] - column[first]) + 1)), np.float32)
        part[owner[first:last], column[first:last] - column[first]] = 1
        common += part @ part.T
        first = last
    union = sizes[:, None] + sizes[None, :] - common
    i, j = np.nonzero(np.triu(100 * common.astype(np.float64) >= percent * union.astype(np.float64), 1))
    root = {int(x): int(x) for x in np.unique(label)}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        u, v = find(int(label[x])), find(int(label[y]))
        if u != v:
            root[max(u, v)] = min(u, v)
            out.append((x, y))
    return out


def _linked(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that link what is apart in each key: confirmed on full sets, fewer than the members of a group.

    ``members``: key, node, label, blocks, shingles.
    """
    def run(batches):
        for table in _groups(batches):
            if len(table) < 2:
                continue
            node, label = table.column(4).to_numpy(), table.column(5).to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in table.column(6).to_pylist()]
            pairs = np.array(linking_pairs(sets, label, percent), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], ["a", "b"])

    return _dealt(members, ("node", "label", "shingles")).mapInArrow(tidy(run), "a bigint, b bigint")


def near_duplicates(documents: DataFrame, percent: int = 85, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    documents = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = stage(_set_table(documents))
    classes = stage(rows.where("n_shingles > 0").groupBy("set_id")
                    .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"),
                         F.first("sketch").alias("sketch"))
                    .withColumn("node", F.monotonically_increasing_id()))

    buckets = classes.select(F.posexplode("bands").alias("band", "key"), "node")
    hubs = stage(buckets.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("far"),
                                            F.count("*").alias("members")).where("members > 1"))
    members = stage(buckets.join(hubs, "key"))
    wanted = stage(members.select("node").distinct().join(classes.select("node", "doc_id", "set_id"), "node"))
    sets = _full_sets(documents, wanted)

    # Round 1: every class and one member of its buckets.
    first = (members.where("node != hub").groupBy("node").agg(F.min("hub").alias("a"))
             .select("a", F.col("node").alias("b")))
    edges = _confirmed(first, sets, percent)
    labels = components(edges)
    # Rounds 2 and 3: what is still apart from the least, then from the greatest member of its bucket.
    for hub in ("hub", "far"):
        pairs = members.where(F.col("node") != F.col(hub)).select(F.col(hub).alias("a"), F.col("node").alias("b")).distinct()
        apart = _apart(pairs, ("a", "b"), labels).where("a_label != b_label").select("a", "b")
        edges = stage(edges.union(_confirmed(apart, sets, percent)))
        labels = components(edges)
    # Last: all pairs of a bucket that still lie in different components, by sketch, then on full sets.
    left = stage(_apart(members.where("members > 2").select("key", "band", "node", "members"), ("node",), labels))
    split = stage(left.groupBy("key").agg(F.min("node_label").alias("lo"), F.max("node_label").alias("hi"))
                  .where("lo != hi").select("key"))
    several = left.join(split, "key").withColumnRenamed("node_label", "label")
    # Five standard deviations below the threshold: 3e-7 of the linked pairs agree in fewer coordinates.
    share = percent / 100
    least = int(COORDINATES * (share - 5 * (share * (1 - share) / COORDINATES) ** 0.5))
    sketched = several.join(classes.select("node", "bands", "sketch"), "node").withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    close = _close(sketched.select("key", "band", "node", "label", "blocks", "bands", "sketch"), least)
    close = stage(close.join(several.select("key", "node", "label"), ["key", "node"]).join(sets, "node"))
    # Blocks are bounded in bytes and in members: two of them meet in products of (members x members) numbers.
    weights = stage(close.groupBy("key").agg(F.greatest(
        F.ceil(F.sum(F.length("shingles")) / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias("blocks")))
    edges = stage(edges.union(_linked(close.join(weights, "key"), percent)))
    labels = components(edges)

    named = _apart(classes.select("set_id", "node", "doc_id"), ("node",), labels)
    named = stage(named)
    least_id = named.groupBy("node_label").agg(F.min("doc_id").alias("component_id"))
    by_set = stage(named.join(stage(least_id), "node_label").select("set_id", "component_id"))
    result = rows.select("doc_id", "n_shingles", "set_id").join(by_set, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(documents: DataFrame, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with one row of each group of near duplicates, columns as they are.

    Rows without a word and rows without an id all stay; rows of one id count as one document.
    """
    result = near_duplicates(documents, percent, id_column, text_column)
    kept = result.where(F.col("kept") & (F.col("n_shingles") > 0)).select(F.col("doc_id").alias("_kept"))
    grouped = F.col(id_column).isNotNull() & F.coalesce(F.col(text_column).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = (documents.where(grouped).join(kept, F.col(id_column) == F.col("_kept"), "left_semi")
           .dropDuplicates([id_column]))
    return one.union(documents.where(~grouped))
