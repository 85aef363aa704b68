"""The prefix trie of conversations: a burst trie spread over shards.

A turn becomes a 128-bit id of its role and text, so texts are moved once, in the scan. A prefix is named by the
exclusive or of hashes of (place, turn id): it can be put together from pieces. Conversations are cut into segments
of at most ``SEGMENT`` turns; a segment lies in the container of the trie head that names all turns before it. Equal
segments under one head are one row with a count, so a group of equal conversations costs one row.

* Bursting: a container of more than ``CONTAINER`` turns is burst by its next turn id: each distinct next
  turn becomes a node, combined before the shuffle, and heads a container of its own for what follows it. What a
  burst leaves may be burst again.
* Sweeping: a remaining container is sorted and swept once; the turns that a row shares with the row before it
  are the open nodes, and a node that closes hands its sums to its parent.
* Sums go upwards: from the last segments to the first, and in a segment from swept containers through
  the burst heads to the segment's own head.

No group is collected whole: a container is bounded in turns, a conversation of any length is split into segments
(and numbered in pages by `ordered` where one key is large), and the ids that end in one node are written as
texts of at most ``CHUNK`` ids, whose digest is then taken in order. Jobs run once for each level of segments and
of bursts, so their number grows with the longest conversation over ``SEGMENT``.

Defined results: turns of equal place are ordered by the hashes of their contents; a NULL turn comes first; NULL role
or text is empty; repeated rows are repeated turns; rows without a ``conv_id`` belong to no conversation; other columns
of the input are ignored; without conversations there is no node, not even a root.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import ordered
from ..session import stage

SEGMENT, CONTAINER, CHUNK = 4096, 8192, 1 << 16
SHARED, EVERY = 9, 5
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
         "saved_tokens bigint, ends_sha256 string")
_SUMS = ("children", "leaves", "saved")


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, t1, t2, size`` of every turn: 128 bits of (role, text), and the text's bytes."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), "turn", F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit("turn"), text, role).alias("t2"), F.octet_length(text).cast("bigint").alias("size"))


def rebuilt(turns: DataFrame, page_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(``conv_id, place, t1, t2, size`` of rebuilt conversations, all their ids); places count from 0.

    The first h turns come from conversation ``c - c % EVERY``, h being a checksum of c modulo ``SHARED``.
    """
    turns = stage(turns)
    numbered = ordered(turns, ["conv_id"], ["turn", "t1", "t2"], page_rows).df
    numbered = stage(numbered.select("conv_id", (F.col("_pos") - 1).alias("place"), "t1", "t2", "size"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h")
    source = (F.col("conv_id") - F.col("conv_id") % EVERY).alias("source")
    ids = stage(numbered.groupBy("conv_id").agg(F.count("*").alias("turns")).select("conv_id", "turns", shared, source))
    first = numbered.where((F.col("conv_id") % EVERY == 0) & (F.col("place") < SHARED - 1)).withColumnRenamed("conv_id", "source")
    others = ids.where("conv_id != source")
    borrowed = first.join(others, "source").where("place < h").select("conv_id", "place", "t1", "t2", "size")
    # Own turns close up where the source has fewer than h turns.
    lengths = ids.where(f"conv_id % {EVERY} = 0").select(F.col("conv_id").alias("source"), F.col("turns").alias("had"))
    gaps = (others.join(lengths, "source", "left")
            .select("conv_id", (F.col("h") - F.least("h", F.coalesce("had", F.lit(0)))).alias("gap")).where("gap > 0"))
    own = numbered.withColumn("h", shared).where(f"conv_id % {EVERY} = 0 OR place >= h").drop("h")
    own = own.join(gaps, "conv_id", "left").select(
        "conv_id", (F.col("place") - F.coalesce("gap", F.lit(0))).alias("place"), "t1", "t2", "size")
    return own.union(borrowed), ids.select("conv_id")


def _named(place: Column, t1: Column, t2: Column) -> tuple[Column, Column]:
    """What a turn at a place adds to the name of a prefix."""
    return F.xxhash64(place, t1, t2), F.xxhash64(t2, place, t1)


def segments(turns: DataFrame, length: int) -> DataFrame:
    """Stored ``conv_id, level, depth, h1, h2, e1, e2, turns, last``: head and end name of every segment, and its turns."""
    n1, n2 = _named(F.col("place"), F.col("t1"), F.col("t2"))
    cut = turns.withColumns({"level": F.expr(f"place div {length}"), "n1": n1, "n2": n2})
    cut = stage(cut.groupBy("conv_id", "level").agg(
        F.bit_xor("n1").alias("n1"), F.bit_xor("n2").alias("n2"),
        F.array_sort(F.collect_list(F.struct("place", "t1", "t2", "size"))).alias("turns")))
    # Only conversations of several segments need what lies before.
    long = stage(cut.where("level > 0").select("conv_id").distinct())
    names = cut.select("conv_id", "level", "n1", "n2").join(long, "conv_id", "left_semi")
    by_level = Window.partitionBy("conv_id").orderBy("level")
    until = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = names.select("conv_id", "level", F.bit_xor("n1").over(until).alias("e1"), F.bit_xor("n2").over(until).alias("e2"),
                         F.lead("level").over(by_level).isNull().alias("last"))
    joined = cut.join(names, ["conv_id", "level"], "left")
    e1, e2 = F.coalesce("e1", "n1"), F.coalesce("e2", "n2")
    return stage(joined.select(
        "conv_id", "level", (F.col("level") * length).alias("depth"), e1.bitwiseXOR(F.col("n1")).alias("h1"),
        e2.bitwiseXOR(F.col("n2")).alias("h2"), e1.alias("e1"), e2.alias("e2"), "turns",
        F.coalesce("last", F.lit(True)).alias("last")))


def _digests(ends: DataFrame) -> DataFrame:
    """Stored ``e1, e2, sha`` from the conversations (``conv_id, e1, e2``) that end in a node."""
    def texts(batches):
        for batch in batches:
            if not len(batch):
                continue
            e1, e2, ids = (c.to_pylist() for c in batch.columns)
            out, first = [], 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or i - first == CHUNK or (e1[i], e2[i]) != (e1[first], e2[first]):
                    out.append((e1[first], e2[first], ids[first], ",".join(map(str, ids[first:i]))))
                    first = i
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["e1", "e2", "first", "ids"])

    def digests(batches):
        name, digest = None, None
        for batch in batches:
            out = []
            for e1, e2, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (e1, e2) != name:
                    if name is not None:
                        out.append((*name, digest.hexdigest()))
                    name, digest = (e1, e2), hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["e1", "e2", "sha"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*name, digest.hexdigest())], ["e1", "e2", "sha"])

    # Ranges split the ids of a hot node over many tasks; the digest then reads few long texts.
    ranged = ends.repartitionByRange("e1", "e2", "conv_id").sortWithinPartitions("e1", "e2", "conv_id")
    written = ranged.mapInArrow(texts, "e1 bigint, e2 bigint, first bigint, ids string")
    return stage(written.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "first")
                 .mapInArrow(digests, "e1 bigint, e2 bigint, sha string"))


def _classes(cut: DataFrame) -> DataFrame:
    """Stored rows of the containers: equal segments under one head together.

    ``n`` conversations go through a row, ``ends`` of them end with it; ``head_conv`` is the head's smallest member.
    """
    rows = cut.groupBy("level", "depth", "h1", "h2", "e1", "e2").agg(
        F.first("turns").alias("turns"), F.count("*").alias("n"), F.min("conv_id").alias("conv"),
        F.count_if("last").alias("ends"))
    rows = stage(rows.join(_digests(cut.where("last").select("e1", "e2", "conv_id")), ["e1", "e2"], "left"))
    above = rows.select(F.col("e1").alias("h1"), F.col("e2").alias("h2"), F.col("conv").alias("head_conv"))
    # Heads of first segments are the root, whose members are filled in by the caller.
    later = rows.where("level > 0").join(above, ["h1", "h2"])
    return rows.where("level = 0").withColumn("head_conv", F.lit(None).cast("bigint")).unionByName(later)


def sweep(rows: list[tuple]) -> tuple[list[tuple], tuple[int, int, int]]:
    """(nodes, the head's children, leaves and saved bytes) of one container.

    A row: (depth, head_conv, ids, sizes, n, conv, ends, sha, children, leaves, saved), ``ids`` 16 bytes a turn; the
    last three sum up what follows after the row's end.
    """
    rows = sorted(rows, key=lambda r: r[2])
    base, head_conv = rows[0][0], rows[0][1]
    nodes = []  # conv, depth, parent's index, n, children, leaves, saved, sha, size
    path: list[int] = []
    before = b""
    for _, _, ids, sizes, n, conv, ends, sha, children, leaves, saved in rows:
        shared = len(os.path.commonprefix([before, ids])) // 16
        del path[shared:]
        for k in path:
            nodes[k][3] += n
            nodes[k][0] = min(nodes[k][0], conv)
        for k in range(shared, len(sizes)):
            nodes.append([conv, base + k + 1, path[-1] if path else -1, n, 0, 0, 0, _EMPTY, sizes[k]])
            path.append(len(nodes) - 1)
        end = nodes[path[-1]]
        if ends:
            end[7] = sha
        end[4] += children
        end[5] += leaves
        end[6] += saved
        before = ids
    head = [0, 0, 0]
    for node in reversed(nodes):  # children come after their parents
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[8]
        to, at = (head, 0) if node[2] < 0 else (nodes[node[2]], 4)
        for k, value in enumerate((1, node[5], node[6])):
            to[at + k] += value
    out = [(x[0], x[1], head_conv if x[2] < 0 else nodes[x[2]][0], x[3], x[4], x[5], x[6], x[7]) for x in nodes]
    return out, tuple(head)


def _swept(rows: DataFrame) -> DataFrame:
    """Stored nodes of the containers in ``rows``, and a row with the head's sums for each (``h1`` not NULL)."""
    names = _NODE.replace(" bigint", "").replace(" string", "").split(", ")

    def packed(turns: list[dict]) -> tuple[bytes, list[int]]:
        return (b"".join(t[k].to_bytes(8, "big", signed=True) for t in turns for k in ("t1", "t2")),
                [t["size"] for t in turns])

    def result(head, rows):
        nodes, sums = sweep(rows)
        nodes.append((None, rows[0][0], None, None, *sums, None))
        columns = [pa.array(c, pa.string() if k == "ends_sha256" else pa.int64()) for k, c in zip(names, zip(*nodes))]
        for name in head:
            columns.append(pa.array([None] * (len(nodes) - 1) + [name], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, [*names, "h1", "h2"])

    def run(batches):
        head, rows = None, []
        for batch in batches:
            for h1, h2, depth, head_conv, turns, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if (h1, h2) != head:
                    if rows:
                        yield result(head, rows)
                    head, rows = (h1, h2), []
                rows.append((depth, head_conv, *packed(turns), *rest))
        if rows:
            yield result(head, rows)

    wanted = rows.select("h1", "h2", "depth", "head_conv", "turns", "n", "conv", "ends", "sha", *_SUMS)
    return stage(wanted.repartition("h1", "h2").sortWithinPartitions("h1", "h2").mapInArrow(
        run, f"{_NODE}, h1 bigint, h2 bigint"))


def _burst(rows: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """(rows of containers of at most ``most`` turns or of one row, nodes of each round of bursting)."""
    kept, rounds = [], []
    while True:
        rows = stage(rows)
        sizes = rows.groupBy("h1", "h2").agg(F.sum(F.size("turns")).alias("_turns"), F.count("*").alias("_rows"))
        large = stage(sizes.where((F.col("_turns") > most) & (F.col("_rows") > 1)).select("h1", "h2"))
        if not large.limit(1).count():
            kept.append(rows)
            break
        kept.append(rows.join(large, ["h1", "h2"], "left_anti"))
        turn = F.col("turns")[0]
        n1, n2 = _named(turn["place"], turn["t1"], turn["t2"])
        split = stage(rows.join(large, ["h1", "h2"], "left_semi").withColumns({
            "c1": F.col("h1").bitwiseXOR(n1), "c2": F.col("h2").bitwiseXOR(n2), "done": F.size("turns") == 1}))
        ending = F.col("done") & (F.col("ends") > 0)
        nodes = stage(split.groupBy("depth", "h1", "h2", "c1", "c2").agg(
            F.sum("n").alias("n"), F.min("conv").alias("conv"), F.min("head_conv").alias("head_conv"),
            F.min(turn["size"]).alias("size"), F.max(F.when(ending, F.col("sha"))).alias("sha")))
        rounds.append(nodes)
        on = nodes.select("c1", "c2", F.col("conv").alias("_conv"))
        rest = split.where("NOT done").drop("head_conv").join(on, ["c1", "c2"])
        rows = rest.select(
            "level", (F.col("depth") + 1).alias("depth"), F.col("c1").alias("h1"), F.col("c2").alias("h2"), "e1", "e2",
            F.slice("turns", 2, SEGMENT).alias("turns"), "n", "conv", "ends", "sha", F.col("_conv").alias("head_conv"))
    out = kept[0]
    for part in kept[1:]:
        out = out.unionByName(part)
    return out, rounds


def _level(rows: DataFrame, below: DataFrame | None, most: int) -> tuple[list[DataFrame], DataFrame]:
    """(nodes, sums of the heads: ``h1, h2, children, leaves, saved``) of one level's containers."""
    kept, rounds = _burst(rows, most)
    zero = {c: F.lit(0).cast("bigint") for c in _SUMS}
    if below is None:
        kept = kept.withColumns(zero)
    else:
        after = below.withColumnsRenamed({"h1": "e1", "h2": "e2"})
        kept = kept.join(after, ["e1", "e2"], "left").withColumns({c: F.coalesce(c, zero[c]) for c in _SUMS})
    swept = _swept(kept)
    nodes = [swept.where("h1 IS NULL").drop("h1", "h2")]
    sums = swept.where("h1 IS NOT NULL").select(
        "h1", "h2", F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    for burst in reversed(rounds):
        reached = sums if below is None else sums.unionByName(below)
        under = reached.withColumnsRenamed({"h1": "c1", "h2": "c2"})
        summed = stage(burst.join(under, ["c1", "c2"], "left").withColumns({
            "children": F.coalesce("children", zero["children"]), "leaves": F.coalesce("leaves", F.lit(1)),
            "saved": F.coalesce("saved", zero["saved"]) + (F.col("n") - 1) * F.col("size")}))
        nodes.append(summed.select(
            F.col("conv").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("head_conv").alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256")))
        sums = stage(sums.unionByName(summed.groupBy("h1", "h2").agg(
            F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))))
    return nodes, sums


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, container: int = CONTAINER,
                page_rows: int | None = None) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node."""
    turns, ids = rebuilt(turn_ids(conversations), page_rows)
    cut = segments(turns, segment)
    classes = _classes(cut)
    root_conv, n, longest = ids.agg(F.min("conv_id"), F.count("*"), F.lit(0)).first()[:2] + (
        cut.agg(F.max("level")).first()[0],)
    levels = range(-1 if longest is None else longest, -1, -1)
    classes = stage(classes.withColumn("head_conv", F.coalesce("head_conv", F.lit(root_conv).cast("bigint"))))
    nodes, sums = [], None
    for level in levels:
        of_level, sums = _level(classes.where(F.col("level") == level), sums, container)
        nodes += of_level
    spark = conversations.sparkSession
    turnless = ids.join(cut.where("level = 0").select("conv_id"), "conv_id", "left_anti")
    zero = F.lit(0).cast("bigint")
    ended = _digests(turnless.select(zero.alias("e1"), zero.alias("e2"), "conv_id"))
    root = spark.range(1 if n else 0).select(F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"))
    root = root.join(ended.select(F.col("e1").alias("h1"), F.col("e2").alias("h2"), "sha"), ["h1", "h2"], "left")
    if sums is None:
        root = root.withColumns({c: F.lit(None).cast("bigint") for c in _SUMS})
    else:
        root = root.join(sums, ["h1", "h2"], "left")
    out = root.select(
        F.lit(root_conv).cast("bigint").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.lit(n).cast("bigint").alias("n_convs"), F.coalesce("children", zero).alias("n_children"),
        F.coalesce("leaves", F.lit(1).cast("bigint")).alias("n_leaves"), F.coalesce("saved", zero).alias("saved_tokens"),
        F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"))
    for part in nodes:
        out = out.unionByName(part)
    return out
