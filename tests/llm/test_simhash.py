"""SimHash and the covering code against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash as sh
from tickloom.llm.ragged import text_slices

LOWER = {i: i + 32 for i in range(65, 91)}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(rows):
    prints = [fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for a, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(a)] = min(doc, least.get(find(a), doc))
    return [(doc, f"{p:016x}", least.get(find(a))) for a, ((doc, _), p) in enumerate(zip(rows, prints))]


def _key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in row)


def _texts():
    rnd = random.Random(2)
    texts = ["", None, " \t\n", "one", "Two Words", "a b c", "a b c d", "É x y z  t\tq\nR", "long " * 20_000]
    for size, copies in ((400, 60), (900, 40), (60, 30)):
        base = [f"W{rnd.randrange(5000)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rnd.randrange(4)):
                words[rnd.randrange(size)] = f"x{rnd.randrange(10**6)}"
            texts.append("  ".join(words))
    texts += [" ".join(f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(1, 200))) for _ in range(80)]
    return texts + ["the same words in all of these copies"] * 20


@pytest.mark.parametrize("step", [1 << 18, 50])
def test_fingerprints_equal_the_plain_form(monkeypatch, step):
    monkeypatch.setattr(sh, "_STEP", step)
    texts = _texts()
    found = []
    for _, _, data, bounds in text_slices(pa.array(texts)):
        found += sh.fingerprints(data, bounds).tolist()
    assert found == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("homes", [4096, 8])
def test_components_equal_brute_force(spark, monkeypatch, homes):
    monkeypatch.setattr(sh, "HOMES", homes)
    rows = [(3 * i + 5, t) for i, t in enumerate(_texts())]
    random.Random(1).shuffle(rows)
    rows += [rows[0], (None, rows[1][1]), (None, "an id of its own it has not"), rows[0]]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as fp", "'x' as node", "2 as key")
    found = [tuple(r) for r in sh.near_duplicates(table.repartition(4)).collect()]
    assert sorted(found, key=_key) == sorted(brute_force(rows), key=_key)


def test_every_close_pair_meets(spark):
    """Random fingerprints with partners at every distance: each pair within four bits is linked."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    prints = list(base.tolist())
    for i, x in enumerate(base.tolist()):
        flip = rng.permutation(64)[:i % 8]
        prints.append(x ^ sum(1 << int(b) for b in flip))
    prints = sorted(set(prints))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    nodes = spark.createDataFrame(list(enumerate(signed)), "node bigint, fp bigint").repartition(4)
    linked = {frozenset(r) for r in sh._linked(sh._visits(nodes)).collect()}
    expected = {frozenset((a, b)) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4}
    assert len(expected) > 150
    assert linked == expected  # no three of them are close to each other, so each pair is a link


def test_anchors_are_code_words_and_cover():
    rng = np.random.default_rng(0)
    for _, bits in sh.BLOCKS:
        values = rng.integers(0, 1 << bits, 300).astype(np.uint32)
        seen, home = [set() for _ in values], {}
        for rows, anchor, at_home in sh.anchors(values, bits):
            assert not sh.syndrome(anchor).any()
            for i, a in zip(rows.tolist(), anchor.tolist()):
                distance = (a ^ int(values[i])).bit_count()
                assert distance <= (sh.RADIUS if at_home else sh.RADIUS + 1) and a not in seen[i]
                seen[i].add(a)
                if at_home:
                    home[i] = a
        for i in range(len(values)):
            for b in range(bits):
                other = np.array([values[i] ^ np.uint32(1 << b)], np.uint32)
                assert home[i] in {a for _, anchor, _ in sh.anchors(other, bits) for a in anchor.tolist()}


def test_a_hot_group_of_copies_is_one_node(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("all of these texts are the same").alias("text"))
    found = sh.near_duplicates(rows)
    assert found.select("fingerprint", "component_id").distinct().count() == 1
    assert found.count() == 3000


def test_empty_table(spark):
    assert sh.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
