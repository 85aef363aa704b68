"""The burst trie of conversations against a plain trie of tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tickloom.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn int, role string, text string"


def plain_trie(rows):
    """Nodes of rows without two turns of one conversation at the same place."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((-1 if turn is None else turn, role or "", text or ""))
    original = {c: [(role, text) for _, role, text in sorted(v)] for c, v in by.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, own in sorted(original.items()):
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(original.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        under = [sums[q] for q in children[p]]
        sums[p] = (sum(x[0] for x in under) or 1, saved + sum(x[1] for x in under))
    return sorted(
        (members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(children[p]), *sums[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p in members)


def nodes(spark, rows, **options):
    # Columns of these names are also used inside.
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as h1", "'x' as place", "2 as n", "3 as level")
    found = pt.prefix_trie(table.repartition(3), **options).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in found)


def conversations():
    rnd = random.Random(3)
    rows = []
    for c in [*range(60), *range(71, 90)]:  # 70 is absent, so 71 to 74 borrow nothing
        for t in range(rnd.choice([1, 2, 3, 5, 8, 12, 30])):
            x = rnd.random()
            text = rnd.choice(["hi", "ä ok", None, ""]) if x < 0.5 else "same"
            rows.append((c, None if t == 0 and x < 0.2 else t, rnd.choice(["user", "bot", None]) if x < 0.2 else "user", text))
    for c in range(100, 160):  # a long common beginning, and one conversation many times
        rows += [(c, t, "user", f"q{t}" if t < 38 or c % 3 else f"x{c}") for t in range(40)]
    return rows + [(None, 1, "user", "of no conversation")] * 3


@pytest.mark.parametrize("options", [
    {}, {"segment": 7, "container": 20}, {"segment": 3, "container": 5, "page_rows": 10}, {"segment": 64, "container": 10}])
def test_equal_to_a_plain_trie(spark, options):
    rows = conversations()
    assert nodes(spark, rows, **options) == plain_trie(rows)


def test_digest_of_many_ids_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 7)
    rows = [(c, 0, "user", "the same in all") for c in range(0, 500)]
    assert nodes(spark, rows) == plain_trie(rows)


def test_empty_and_turnless(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 0, "a", "b")]) == []
    turnless = [(7, 1, "a", "b")]  # seven turns come from an absent conversation, the own one is among the first seven
    assert nodes(spark, turnless) == plain_trie(turnless)
    repeated = [(10, 2, "a", "b")] * 3 + [(10, 1, None, None), (10, None, "c", "d")]
    assert nodes(spark, repeated) == plain_trie(repeated)


def test_sweep_of_one_container():
    a, b = b"a" * 16, b"b" * 16
    rows = [(4, 1, a + b, [3, 5], 2, 7, 2, "x", 0, 0, 0), (4, 1, a, [3], 1, 9, 0, None, 2, 3, 40)]
    out, head = pt.sweep(rows)
    assert out == [(7, 5, 1, 3, 3, 4, 40 + 5 + 6, pt._EMPTY), (7, 6, 7, 2, 0, 1, 5, "x")]
    assert head == (1, 4, 51)
