"""Spelling variants against all edits of every word."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tickloom.llm import spelling as sp

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
LOWER = {i: i + 32 for i in range(65, 91)}


def edits(word):
    for i in range(len(word) + 1):
        for c in LETTERS:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1:]
            for c in LETTERS:
                yield word[:i] + c + word[i + 1:]


def brute_force(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    found = {}
    for w, k in n.items():
        near = {v for v in edits(w) if v in n and v != w}
        best = min(near, key=lambda v: (-n[v], v), default=None)
        found[w] = (best if near and n[best] >= 10 * k else None, len(near))
    out = []
    for w, (form, near) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        out.append((w, form, root, n[w], near, n[form] if form else None))
    return sorted(out)


def _documents():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdenrisÉéßÿ×") for _ in range(rnd.randrange(6, 9))) for _ in range(150)]
    base += ["z" * 300, "y" * 299 + "a", "abcdefgabc" * 9, "f" * 2000]
    rows = []
    for doc in range(400):
        words = []
        for _ in range(rnd.randrange(40)):
            w = rnd.choice(base[:int(1 + len(base) * rnd.random() ** 2)])
            if rnd.random() < 0.3:
                p = rnd.randrange(len(w))
                w = w[:p] + rnd.choice("abeé") + w[p + (rnd.random() < 0.5):]
            words.append(w.upper() if rnd.random() < 0.2 else w)
        rows.append((doc if doc % 50 else None, " ".join(words) if doc % 7 else None))
    return rows + [(1, "Strasse!straße-Strasse"), (2, "")]


@pytest.mark.parametrize("shard_words", [1 << 14, 20, 3])
def test_equal_to_brute_force(spark, shard_words):
    rows = _documents()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as word", "'x' as head", "2 as n")
    found = sorted(tuple(r) for r in sp.variants(table.repartition(3), shard_words=shard_words).collect())
    expected = brute_force(rows)
    assert found == expected
    assert sum(r[1] is not None for r in expected) > 100


def test_a_chain_of_forms_ends_in_its_last(spark):
    chain = {"aaaaaaaa": 2000, "aaaaaaab": 200, "aaaaaabb": 20, "aaaaabbb": 2}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(chain.items())]
    assert sp.variants(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == len(brute_force(rows))
    forms = spark.createDataFrame([(f"w{i:02}", f"w{i + 1:02}") for i in range(13)], "word string, form string")
    assert {r.root for r in sp._roots(forms).collect()} == {"w13"}


def test_empty_table(spark):
    assert sp.variants(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    assert sp.variants(spark.createDataFrame([(1, None), (2, "too few")], "doc_id bigint, text string")).collect() == []


def _edit_distance_is_one(x, y):
    return x != y and (y in set(edits(x)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcé", min_size=7, max_size=10), min_size=2, max_size=12), st.text("ab", min_size=60, max_size=80))
def test_one_apart(words, long):
    words = [*words, *(w[:3] + w[4:] + "a" for w in words), *(w[1:] for w in words if len(w) > 7), long, long + "a", "c" + long]
    held = sp.Words(pa.array(words))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    expected = [_edit_distance_is_one(words[a], words[b]) for a, b in zip(i, j)]
    assert sp.one_apart(held, i, held, j).tolist() == expected


def test_vectors_differ_by_a_surplus_and_a_deficit_of_one():
    rnd = random.Random(1)
    for _ in range(200):
        word = "".join(rnd.choice(LETTERS) for _ in range(rnd.choice([7, 9, 700])))
        other = rnd.choice([e for e in list(edits(word))[:4000] if len(e) >= 7])
        a, b = sp.Words(pa.array([word, other])).vectors().astype(int)
        assert (b - a).max() <= 1 and (b - a).min() >= -1 and np.abs(b - a).sum() <= 2
