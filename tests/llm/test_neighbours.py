"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import neighbours as nn


def _brute(ids, x, k=10):
    out = {}
    for j in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[j]) ** 2).sum(1))
        d[ids == ids[j]] = np.inf
        best = [i for i in np.lexsort((ids, d)) if np.isfinite(d[i])][:k]
        out[int(ids[j])] = [(int(ids[i]), float(d[i])) for i in best]
    return out


def _found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def _recall(found, expected):
    hits = sum(len({v for v, _ in w} & {v for v, _ in found.get(q, [])}) for q, w in expected.items())
    return hits / sum(map(len, expected.values()))


def test_recall_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK", 300)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2600, 24))
    x[:900] = x[0]  # a third of all rows is one vector
    ids = np.arange(2600)
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    found, expected = _found(nn.search(table, F.col("vec_id") % 100 == 0)), _brute(ids, x)
    assert _recall(found, expected) >= 0.97
    for q, w in found.items():
        for v, d in w:
            assert abs(d - np.sqrt(((x[q] - x[v]) ** 2).sum())) < 1e-9
    assert found[0] == [(v, 0.0) for v in range(1, 11)]  # ties go to the smaller ids


def test_unusable_vectors_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0]), (8, [3.0, 0.0]), (8, [2.0, 0.0]), (0, [1.0, 0.0]), (None, [1.0, 1.0]),
            (100, [0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as leaf", "2 as score")
    found = _found(nn.search(table, F.col("vec_id") % 100 == 0))
    assert found == {0: [(8, 1.0), (1, 2 ** 0.5)]}
    assert nn.search(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_quantile():
    rng = np.random.default_rng(0)
    draws = (rng.standard_normal((200_000, nn.DIMENSIONS)) ** 2).sum(1)
    assert abs((draws <= nn.chi_square_quantile(0.95)).mean() - 0.95) < 0.003
