"""Near duplicates against a brute-force version."""

import random
import re

import numpy as np
import pyarrow as pa

from tickloom.llm import near_dedup as nd
from tickloom.llm.ragged import text_slices


def brute_force(rows):
    """(doc_id, n_shingles, component_id) of rows with distinct ids."""
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def _group(rnd, base, n, most):
    """``n`` texts with up to ``most`` of the base's words changed."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randrange(0, most + 1)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def _table():
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(4000)}"
    texts = []
    for size, n, most in ((140, 60, 3), (300, 40, 12), (60, 25, 2)):
        texts += _group(rnd, [word() for _ in range(size)], n, most)
    chain = [word() for _ in range(120)]
    for _ in range(12):  # each a near copy of the one before
        chain = list(chain)
        chain[rnd.randrange(120)] = word()
        texts.append(" ".join(chain))
    passage = " ".join(word() for _ in range(50))
    texts += [" ".join(word() for _ in range(60)) + " " + passage for _ in range(40)]
    texts += ["", None, " \t\n", "one", "One", "two words", "a b c d", "a b c d e", "A b c d e f", "a b a b a b a b"]
    texts += ["same words in every copy of this text"] * 30 + ["long " * 30_000]
    rnd.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def test_equal_to_brute_force(spark):
    rows = _table()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as node", "2 as key", "'c' as set_id")
    found = nd.near_duplicates(table.repartition(5)).collect()
    assert sorted((r[0], r[1], r[2]) for r in found) == brute_force(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "a few words that come again and again in this text"
    rows = [(4, text), (4, text), (2, text), (None, text), (None, None), (8, "")]
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r[0], r[1], r[2]) for r in found), key=key) == sorted(
        [(4, 7, 2), (4, 7, 2), (2, 7, 2), (None, 7, 2), (None, 0, None), (8, 0, 8)], key=key)
    assert nd.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    one = nd.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r[0] or 0, r[1] or "") for r in one) == [(0, ""), (0, text), (2, text), (8, "")]


def test_sketches_are_full_and_agree_as_the_sets_do():
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    texts = ["only"] + [" ".join(base)] + _group(rnd, base, 40, 12)
    for _, _, data, bounds in text_slices(pa.array(texts)):
        sets, cuts = nd.shingle_sets(data, bounds)
        table = nd.sketches(sets, cuts)
    assert (table < np.uint64(2**64 - 1)).all()
    for i in range(2, len(texts)):
        a, b = (set(sets[cuts[j]:cuts[j + 1]].tolist()) for j in (1, i))
        similarity = len(a & b) / len(a | b)
        assert abs((table[1] == table[i]).mean() - similarity) < 0.2


def test_linking_pairs_join_all_that_is_linked():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(40)]
    pairs = nd.linking_pairs(sets, np.arange(40), 55)
    assert len(pairs) < 40
    root = list(range(40))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        assert find(a) != find(b)
        root[find(a)] = find(b)
    for a in range(40):
        for b in range(a):
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            if 100 * len(x & y) >= 55 * len(x | y):
                assert find(a) == find(b)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r[0]: r[1] for r in nd.components(table).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
