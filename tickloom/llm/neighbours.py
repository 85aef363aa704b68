"""Nearest neighbours by low-dimensional stable projections and a kd-tree.

Vectors are projected to ``DIMENSIONS`` Gaussian coordinates: a squared projected distance is the squared true
distance times a chi-square variable. A kd-tree over the projections, fitted on a bounded sample, deals all
vectors to leaves, and leaves to blocks of about ``BLOCK`` rows, so equal vectors never fill one task.

A query first searches one block of its own leaf. With the k-th distance d found there, it goes to every leaf
whose box is nearer than the stopping radius, ``d * sqrt(chi-square quantile)``: beyond it, a vector that
is truly nearer than d has a projection that far with probability ``1 - CERTAINTY`` at most. Within a
block the projected neighbours are verified in order, in growing portions, until the same test holds with
the d found so far. Nothing else is left out.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do rows
without an id, nor vectors of another length than the most frequent one (the longer at a tie); a repeated
id counts once, with its nearest vector; a query with fewer than k candidates gets them all; ties go to
the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .mapping import sample_rows

DIMENSIONS, CERTAINTY = 10, 0.99
#: Rows of a block, queries that meet a block at once, rows the tree is fitted on, and its greatest depth.
BLOCK, QUERIES, SAMPLE, DEPTH = 4096, 4096, 20_000, 12
#: Rows verified in the first portion.
_FIRST = 128


def chi_square_quantile(p: float, m: int = DIMENSIONS) -> float:
    """x with P(chi-square of ``m``, even, degrees <= x) = p."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if below(middle) < p else (lo, middle)
    return hi


def projection(dimension: int) -> np.ndarray:
    return np.random.default_rng(5).standard_normal((dimension, DIMENSIONS))


def fit_tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and threshold of each inner node of a complete tree, in heap order: widest axis, median."""
    axes, cuts = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    parts = {0: points}
    for node in range((1 << depth) - 1):
        own = parts.pop(node)
        axis = int(np.ptp(own, 0).argmax()) if len(own) else 0
        cut = float(np.median(own[:, axis])) if len(own) else 0.0
        axes[node], cuts[node] = axis, cut
        left = own[:, axis] < cut if len(own) else np.zeros(0, bool)
        parts[2 * node + 1], parts[2 * node + 2] = own[left], own[~left]
    return axes, cuts


def leaf_of(points: np.ndarray, axes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    for _ in range((len(axes) + 1).bit_length() - 1):
        right = points[np.arange(len(points)), axes[node]] >= cuts[node]
        node = 2 * node + 1 + right
    return node - len(axes)


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _usable(column: str) -> Column:
    vector = F.col(column)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def nearest_in_block(queries: np.ndarray, query_ids: np.ndarray, limits: np.ndarray, vectors: np.ndarray,
                     ids: np.ndarray, k: int, matrix: np.ndarray, reach: float):
    """(query position, vector id, distance) of up to k neighbours in one block, none beyond a query's limit.

    Projected neighbours are verified portion by portion, each twice as large as the last, until the next
    projected distance is beyond ``reach`` times the k-th distance found.
    """
    flat_q, flat_v = queries @ matrix, vectors @ matrix
    projected = ((flat_q ** 2).sum(1)[:, None] + (flat_v ** 2).sum(1)[None, :] - 2 * flat_q @ flat_v.T)
    out = []
    for i in range(len(queries)):
        far, best_d, best_id = limits[i] ** 2, np.zeros(0), np.zeros(0, np.int64)
        # All that the limit leaves, nearest projection first; a margin covers the rounding of the product.
        near = np.flatnonzero(projected[i] <= reach * far * (1 + 1e-9) + 1e-9) if np.isfinite(far) else np.arange(len(ids))
        near = near[np.argsort(projected[i][near], kind="stable")]
        order = projected[i][near]
        at, portion = 0, _FIRST
        while at < len(near):
            if len(best_d) == k and order[at] > reach * best_d[-1] * (1 + 1e-9) + 1e-9:
                break
            rows = near[at:at + portion]
            rows = rows[ids[rows] != query_ids[i]]
            d = ((vectors[rows] - queries[i]) ** 2).sum(1)
            all_d, all_id = np.concatenate([best_d, d]), np.concatenate([best_id, ids[rows]])
            pick = np.lexsort((all_id, all_d))
            # an id that repeats counts once, with its nearest vector
            _, first = np.unique(all_id[pick], return_index=True)
            pick = pick[np.sort(first)][:k]
            best_d, best_id = all_d[pick], all_id[pick]
            at += portion
            portion *= 2
        out.append((np.full(len(best_d), i), best_id, np.sqrt(best_d)))
    return [np.concatenate(x) for x in zip(*out)]


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id",
           vector_column: str = "embedding", certainty: float = CERTAINTY) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``is_query`` (a condition on ``vec_id``) picks."""
    spark = vectors.sparkSession
    result = "query_id bigint, vec_id bigint, score double"
    clean = (vectors.select(F.col(id_column).cast("bigint").alias("vec_id"),
                            F.col(vector_column).cast("array<double>").alias("vector"))
             .where(F.col("vec_id").isNotNull() & _usable("vector")))
    sizes = clean.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dimension, n = sizes[0], sizes[1]
    clean = clean.where(F.size("vector") == dimension)
    matrix, reach = projection(dimension), chi_square_quantile(certainty)
    sample = _matrix(sample_rows(clean, SAMPLE, "vec_id", n).select("vector").toArrow()["vector"], dimension)
    depth = min(DEPTH, max(0, math.ceil(math.log2(max(n, 1) / BLOCK))))
    axes, cuts = fit_tree(sample @ matrix, depth)

    def assign(batches):
        for batch in batches:
            points = _matrix(batch.column(1), dimension) @ matrix
            low = pa.FixedSizeListArray.from_arrays(pa.array(points.reshape(-1)), DIMENSIONS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(leaf_of(points, axes, cuts)), low],
                ["vec_id", "vector", "leaf", "point"])

    indexed = stage(clean.mapInArrow(assign, "vec_id bigint, vector array<double>, leaf bigint, point array<double>"))
    # At most 2 ** DEPTH leaves: their sizes and boxes are bounded.
    leaves = indexed.groupBy("leaf").agg(
        F.count("*").alias("rows"),
        *[f(F.col("point")[j]).alias(f"{name}{j}") for j in range(DIMENSIONS) for name, f in (("lo", F.min), ("hi", F.max))]
    ).toArrow()
    numbers = leaves["leaf"].to_numpy()
    lo, hi = (np.stack([leaves[f"{name}{j}"].to_numpy() for j in range(DIMENSIONS)], 1) for name in ("lo", "hi"))
    blocks = spark.createDataFrame(pa.table({"leaf": leaves["leaf"], "blocks": pa.array(
        [-(-r // BLOCK) for r in leaves["rows"].to_pylist()], pa.int64())}))
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    rows = indexed.join(F.broadcast(blocks), "leaf").withColumn("block", own)

    asked = (indexed.where(is_query).groupBy("vec_id").agg(F.min(F.struct("vector", "leaf")).alias("_q"))
             .select(F.col("vec_id").alias("query_id"), F.col("_q.vector").alias("query"), F.col("_q.leaf").alias("leaf")))
    asked = stage(asked)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """Neighbours of the queries in ``left`` (query_id, query, limit) among the rows of ``right``."""
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = left["query_id"].to_numpy()
        i, found, score = nearest_in_block(
            _matrix(left["query"], dimension), ids, left["limit"].to_numpy(),
            _matrix(right["vector"], dimension), right["vec_id"].to_numpy(), k, matrix, reach)
        return pa.table([ids[i], found, score], schema=schema)

    # One block of the query's own leaf gives the first bound.
    home = (asked.join(F.broadcast(blocks), "leaf")
            .select("query_id", "query", F.lit(float("inf")).alias("limit"), "leaf",
                    F.pmod(F.xxhash64("query_id"), F.col("blocks")).alias("block")))
    targets = rows.select("vec_id", "vector", "leaf", "block")
    first = home.groupBy("leaf", "block").cogroup(targets.groupBy("leaf", "block")).applyInArrow(meet, result)
    bounds = first.groupBy("query_id").agg(F.max("score").alias("_far"), F.count("*").alias("_n"))
    bounded = stage(asked.drop("leaf").join(bounds, "query_id", "left").select(
        "query_id", "query", F.when(F.col("_n") >= k, F.col("_far")).otherwise(float("inf")).alias("limit")))

    def leaves_near(batches):
        for batch in batches:
            points = _matrix(batch.column(1), dimension) @ matrix
            limit = batch.column(2).to_numpy()
            gap = np.maximum(np.maximum(lo[None] - points[:, None], points[:, None] - hi[None]), 0)
            near = (gap ** 2).sum(2) <= reach * (limit ** 2)[:, None] * (1 + 1e-9) + 1e-9
            q, at = np.nonzero(near)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(j).take(pa.array(q)) for j in range(3)), pa.array(numbers[at])],
                ["query_id", "query", "limit", "leaf"])

    # Queries meet a block in chunks, and a block's rows go once to each chunk.
    chunks = max(1, -(-bounded.count() // QUERIES))
    far = (bounded.mapInArrow(leaves_near, "query_id bigint, query array<double>, limit double, leaf bigint")
           .join(F.broadcast(blocks), "leaf")
           .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
           .withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks))).drop("blocks"))
    dealt = targets.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    key = ("leaf", "block", "chunk")
    found = far.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(meet, result)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
