"""Token counts, token files and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing, token_counts, token_files
from tickloom.llm.encoding import Encoder, encoder
from tickloom.llm.ragged import Memo, text_slices

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BITS = ["hello", "World", " the", "Éa", "ñ", ",", "Ǆ", "ʼ", "ſ", "a", " ", "  ", "\n", "\t", " ", "　", "1", "23",
        "'s", "<|endoftext|>", "<|startoftext|>", ".", "!", "ß", "́", "İ", "Σ", "\x1c", "\x85", "\r", "中", "🙂",
        " ", "\x0b", "\x00"]


def _texts(n):
    rnd = random.Random(1)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.randrange(0, 14))) for _ in range(n)] + [
        None, "", "aaaaaaaaaaaaaaa", "a" * 3000, " " * 300 + "x", "ahahahahah" * 40]


@pytest.mark.parametrize(("path", "kind"), [(BYTE, "byte"), (WORD, "word")])
def test_ids_are_those_of_the_library(path, kind):
    texts, library = _texts(4000), Tokenizer.from_file(path)
    coder = Encoder(path, kind)
    for first, last, data, bounds in text_slices(pa.array(texts), 20_000):
        ids, cuts = coder.encode(data, bounds)
        for i in range(first, last):
            expected = library.encode(texts[i] or "", add_special_tokens=False).ids
            assert ids[cuts[i - first]:cuts[i - first + 1]].tolist() == expected, texts[i]


def test_counts_are_those_of_the_library():
    texts, library = _texts(4000), Tokenizer.from_file(BYTE)
    counter = token_counts.Counter(BYTE)
    for first, last, data, bounds in text_slices(pa.array(texts), 20_000):
        found = counter.counts(data, bounds)
        for i in range(first, last):
            assert found[i - first] == len(library.encode(texts[i] or "", add_special_tokens=False).ids), texts[i]


def test_counts_of_long_pretokens_are_those_of_the_library():
    rnd, library = random.Random(4), Tokenizer.from_file(BYTE)
    texts = ["a" * 20_000, "ab" * 5000 + "c", "=" * 9001, " " * 5000 + "x", "1" * 3333, "x" * 257, "y" * 256, "z" * 258,
             "".join(rnd.choices("etaoinshrdlucm", k=300_000)), "".join(rnd.choices("中文字符测试", k=5000)),
             "".join(rnd.choice(["hello", "world", "the", "ing"]) for _ in range(3000))]
    expected = [len(library.encode(x, add_special_tokens=False).ids) for x in texts]
    assert token_counts.Counter(BYTE).pieces(texts).tolist() == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdeno ", min_size=1, max_size=40), min_size=1, max_size=6))
def test_both_forms_of_merging_agree(texts):
    counter = token_counts.Counter(BYTE)
    raw = [x.encode() for x in texts]
    symbols, sizes = counter.table.first[np.frombuffer(b"".join(raw), np.uint8)], np.array([len(x) for x in raw])
    assert (token_counts.merged_long(counter.table, symbols, sizes) == token_counts.merged_lengths(counter.table, symbols, sizes)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=8))
def test_any_text(texts):
    for path, kind in ((BYTE, "byte"), (WORD, "word")):
        library, coder = encoder(path, kind).tokenizer, encoder(path, kind)
        for first, last, data, bounds in text_slices(pa.array(texts, pa.string())):
            ids, cuts = coder.encode(data, bounds)
            for i in range(first, last):
                expected = library.encode(texts[i], add_special_tokens=False).ids
                assert ids[cuts[i - first]:cuts[i - first + 1]].tolist() == expected


def test_memo_forgets_and_finds():
    memo = Memo(limit=50, dtype=np.uint32)
    rng = np.random.default_rng(0)
    for _ in range(40):
        keys = rng.integers(0, 120, 60).astype(np.uint64)
        rows = memo.rows(keys, lambda at: (keys[at].astype(np.uint32), np.ones(len(at), np.int64)))
        assert (memo.joined(rows) == keys).all()


def _pairs_at_most(pieces, capacity):
    """Sequences that pieces above a third of the capacity need at least: two fit into one, three never do."""
    pieces, n = sorted(pieces), 0
    while pieces:
        longest = pieces.pop()
        if pieces and pieces[0] + longest <= capacity:
            pieces.pop(0)
        n += 1
    return n


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=25))
def test_plan_places_every_piece_once(histogram):
    capacity, used = 60, {}
    ranks = {k: set() for k in histogram}
    for length, rank, n, each, sequence, offset in packing.plan(histogram, capacity):
        for i in range(n * each):
            assert rank + i not in ranks[length]
            ranks[length].add(rank + i)
            used.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
    assert all(ranks[k] == set(range(n)) for k, n in histogram.items())
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(k * n for k, n in histogram.items())
    least = max(-(-total // capacity), _pairs_at_most([k for k, n in histogram.items() for _ in range(n) if 3 * k > capacity], capacity))
    assert len(used) <= 11 / 9 * least + 2


DOCS = [(5, "the quick brown fox"), (3, None), (9, ""), (1, "word " * 900), (3, "again"), (3, "again"),
        (None, "no id"), (2, "A <|endoftext|> b"), (7, "tail")]


def _documents(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as n_tokens", "'x' as length")


def test_count_query_rows(spark):
    library = Tokenizer.from_file(BYTE)
    rows = token_counts.count_tokens(_documents(spark), BYTE, limit=3).collect()
    expected = sorted((i is not None, i or 0, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 3)
                      for i, t in DOCS)
    assert sorted((r[0] is not None, r[0] or 0, r[1], r[2], r[3]) for r in rows) == expected
    assert token_counts.count_tokens(_documents(spark, []), BYTE).count() == 0


def test_files_hold_all_ids_in_order(spark, tmp_path):
    library = Tokenizer.from_file(BYTE)
    found = token_files.round_trip(_documents(spark), BYTE, str(tmp_path / "ids")).collect()
    ids = {}
    for i, t in DOCS:
        ids.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [0])
    at = 0
    for row in sorted(found, key=lambda r: r["start"]):
        assert row["start"] == at
        at += row["n_tokens"]
        crcs = [(len(x), zlib.crc32(np.array(x, "<u4"))) for x in ids[row["doc_id"]]]
        assert (row["n_tokens"], row["ids_crc32"]) in crcs
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted((i for i, _ in DOCS), key=lambda i: -1 if i is None else i)
    assert token_files.round_trip(_documents(spark, []), BYTE, str(tmp_path / "none")).count() == 0


def test_a_sequence_is_a_view_into_the_file(spark, tmp_path):
    folder = str(tmp_path / "ids")
    manifest = token_files.write_token_files(_documents(spark), BYTE, folder, length=16).collect()
    file = token_files.TokenFile(folder, manifest[0]["name"])
    total = manifest[0]["n_ids"]
    joined = []
    for i in range(-(-total // 16)):
        ids, mask = file.sequence(i)
        assert len(ids) == len(mask) == 16 and not ids.flags.owndata
        joined.append(ids[mask])
    assert np.concatenate(joined).tolist() == file.ids(0, total).tolist()


def test_packing_is_gapless_and_whole(spark):
    library = Tokenizer.from_file(WORD)
    placed = packing.pack(_documents(spark), WORD, capacity=64, end_id=1, keep_ids=True)
    rows = placed.collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4")) and len(r["ids"]) == r["length"]
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    expected = sorted((len(x), zlib.crc32(np.array(x, "<u4"))) for _, t in DOCS for ids in
                      [library.encode(t or "", add_special_tokens=False).ids + [1]]
                      for x in [ids[k:k + 64] for k in range(0, len(ids), 64)])
    assert sorted((r["length"], r["ids_crc32"]) for r in rows) == expected
    assert len(by_sequence) == -(-sum(n for n, _ in expected) // 64)
    joined = {r[0]: r[1] for r in packing.sequences(placed).collect()}
    assert {k: len(v) for k, v in joined.items()} == {k: sum(n for _, n in v) for k, v in by_sequence.items()}
    assert packing.pack(_documents(spark, []), WORD).count() == 0


def test_packing_of_one_hot_length(spark):
    rows = [(i, "same few words") for i in range(3000)] + [(9000 + i, "w " * (i % 70)) for i in range(300)]
    placed = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), WORD, capacity=32).collect()
    ends = {}
    for r in placed:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in ends.values():
        assert sum(n for _, n in places) == max(o + n for o, n in places) <= 32
        assert len({o for o, _ in places}) == len(places)
