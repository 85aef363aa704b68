"""Benchmark decontamination by latent semantic retrieval.

Passages of ``WINDOW`` words become TF-IDF vectors over ``FEATURES`` hashed words. Document frequencies are
counted over all passages of all texts; the inverse frequency enters as its square root, which gives every
word's column the same length, so the latent directions aren't spent on the commonest words. A randomised
SVD, with one power iteration, gives ``RANK`` directions, each scaled by its singular value, and the
``COMMON`` directions that most words share are taken out. Its products run over the passages in tasks, and
only matrices of FEATURES x (RANK + COMMON + OVERSAMPLE) are added up; the texts' words are hashed once and stored
for them, two bytes each. The SVD is fitted on the benchmark and every text of the table, each row counted; every
text is searched whole, by windows that begin every ``STRIDE`` words.

A window whose cosine with a passage of an item is at least ``COSINE``, and that has ``COMMON_WORDS`` of the words
they could share, makes the item a candidate for the words around the window. There, within ``STRETCH`` times its length, the longest common subsequence with the item must
hold ``SHARE`` of the item's words, as much of those that less than ``FREQUENT`` of all passages have, and
``ANSWER`` of the words of its last sentence: a passage is found with words changed, added or left out. Where
fewer than ``FEW`` rare words meet, ``SURE`` of all words must, so common words alone are no match.

Items are searched in blocks of ``ITEMS`` passages; they are sent to every executor, at most ``MOST_ITEM_BYTES``
of text, beyond which the table is refused. Defined results: NULL, empty and wordless texts and items match
nothing; repeated rows of documents each give their matches; repeated items are searched one by one; one row
for each row and item, with the best of its places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .mapping import tidy, unique_marker, with_text_columns
from .ragged import Hasher, lower_latin, mix, spans_of, text_slices

WINDOW, STRIDE = 24, 8
FEATURES, RANK, COMMON, OVERSAMPLE = 1 << 14, 64, 8, 8
COSINE, COMMON_WORDS, SHARE, FREQUENT, ANSWER = 0.5, 0.45, 0.6, 0.02, 0.5
STRETCH, FEW, SURE = 1.5, 4, 0.9
ITEMS, MOST_ITEM_BYTES = 2048, 64 << 20
#: Passages multiplied at once, rows summed at once, and rows of one word that are summed in step.
_PASSAGES, _ROWS, _RUN = 1 << 14, 1024, 8
#: Text hashed and searched at once, and windows compared at once: what stays in a core's cache.
_HASH_BYTES, _SEARCH_BYTES, _WINDOWS = 1 << 17, 1 << 18, 512
#: Tasks for each core that add up the products of the SVD.
GRAM_TASKS = 3

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits; ASCII and Latin-1 lower-cased) and each text's first."""
    starts, ends, firsts = spans_of(_INSIDE[data], bounds)
    return Hasher(lower_latin(data)).spans(starts, ends), firsts


def features(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def tiles(firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each run of ``size`` words within a text, and the first run of each text."""
    counts = -(-np.diff(firsts) // size)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.append(0, np.cumsum(counts))
    return firsts[owner] + (np.arange(len(owner)) - first[owner]) * size, first


def _word_features(texts: DataFrame) -> DataFrame:
    """``features`` for each text: those of its words in turn, two bytes each."""
    def run(batches):
        for batch in batches:
            for _, _, data, bounds in text_slices(batch.column(0), _HASH_BYTES):
                hashes, firsts = words(data, bounds)
                raw, cuts = features(hashes).astype("<u2").tobytes(), (firsts * 2).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], ["features"])

    return texts.select("text").mapInArrow(tidy(run), "features binary")


def _passages(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features of the words of runs of passages, and the first word of each passage."""
    for batch in batches:
        column = batch.column(0).cast(pa.large_binary())
        raw = column.buffers()[2]
        if not len(column) or raw is None:
            continue
        firsts = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] // 2
        word = np.frombuffer(raw, "<u2", int(firsts[-1]))
        begin = np.append(tiles(firsts, WINDOW)[0], firsts[-1])
        for at in range(0, len(begin) - 1, _PASSAGES):
            part = begin[at:at + _PASSAGES + 1]
            yield word[part[0]:part[-1]], part[:-1] - part[0]


def _frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each feature, and passages, over all ``texts`` (features)."""
    def run(batches):
        found, total = np.zeros(FEATURES, np.int64), 0
        for word, begin in _passages(batches):
            own = np.repeat(np.arange(len(begin), dtype=np.uint32), np.diff(np.append(begin, len(word))))
            both = own * np.uint32(FEATURES) + word
            both.sort()
            new = both[np.append(True, both[1:] != both[:-1])]
            found += np.bincount(new % FEATURES, minlength=FEATURES)
            total += len(begin)
        # feature -1 is the number of passages
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(FEATURES), -1)), pa.array(np.append(found, total))], ["feature", "n"])

    rows = (texts.mapInArrow(tidy(run), "feature bigint, n bigint").where("n > 0")
            .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(FEATURES + 1, np.int64)
    out[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return out[:-1], int(out[-1])


def _row_sums(table: np.ndarray, at: np.ndarray, begin: np.ndarray, most: int) -> np.ndarray:
    """Sum of the rows ``at`` of ``table`` for each run that begins at ``begin``, of at most ``most`` rows.

    All runs take their next row in step; a run that has ended takes the last row of the table, which is zero.
    """
    size, steps = np.diff(np.append(begin, len(at))), np.arange(most)[:, None]
    out = np.empty((len(begin), table.shape[1]), table.dtype)
    rows = np.empty((min(len(begin), _ROWS), table.shape[1]), table.dtype)
    for first in range(0, len(begin), _ROWS):
        place = begin[first:first + _ROWS] + steps
        place = np.where(steps < size[first:first + _ROWS], at[np.minimum(place, len(at) - 1)], len(table) - 1)
        sums, part = out[first:first + _ROWS], rows[:place.shape[1]]
        np.take(table, place[0], axis=0, out=sums, mode="clip")
        for k in range(1, most):
            np.take(table, place[k], axis=0, out=part, mode="clip")
            sums += part
    return out


def _with_zero_row(table: np.ndarray) -> np.ndarray:
    return np.append(table, np.zeros((1, table.shape[1]), table.dtype), axis=0)


def _add_by_word(out: np.ndarray, left: np.ndarray, word: np.ndarray, begin: np.ndarray) -> None:
    """Add the row of ``left`` of each word's passage to the word's row of ``out``."""
    order = np.argsort(word, kind="stable")
    row = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(word))))[order]
    word, left = word[order], _with_zero_row(left)
    cut = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    runs = np.append(tiles(np.append(cut, len(word)), _RUN)[0], len(word))
    for at in range(0, len(runs) - 1, _ROWS):
        part = runs[at:at + _ROWS + 1]
        sums = _row_sums(left, row[part[0]:part[-1]], part[:-1] - part[0], _RUN)
        held = word[part[:-1]]
        new = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        out[held[new]] += np.add.reduceat(sums, new, dtype=np.float64)


def _gram(texts: DataFrame, idf: np.ndarray, directions: np.ndarray, inner: bool = False) -> np.ndarray:
    """A' A ``directions`` for the TF-IDF passages A of ``texts`` (text, or its features), added up over tasks.

    ``inner``: ``directions``' A' A ``directions``, for which (A ``directions``) suffices.
    """
    if "features" not in texts.columns:
        texts = _word_features(texts)
    # The words' weights are taken out of the sums: into the directions before, into the result after.
    weighted = (directions * idf[:, None]).astype(np.float32)
    shared = texts.sparkSession.sparkContext.broadcast((idf, weighted))
    width = directions.shape[1]
    height = width if inner else FEATURES

    def run(batches):
        weight, right = shared.value
        right = _with_zero_row(right)
        out = np.zeros((height, width), np.float64)
        for word, begin in _passages(batches):
            norm = np.maximum(np.add.reduceat(weight[word] ** 2, begin), 1e-18)
            left = _row_sums(right, word, begin, WINDOW)
            if inner:
                left = left / np.sqrt(norm)[:, None]
                out += left.T @ left
            else:
                left /= norm.astype(np.float32)[:, None]
                _add_by_word(out, left, word, begin)
        if not inner:
            out *= weight[:, None]
        block = 256
        for at in range(0, height, block):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([out[at:at + block].astype(np.float32).tobytes()], pa.binary())], ["at", "rows"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in table["rows"].to_pylist())
        return pa.table({"at": table["at"][:1], "rows": pa.array([total.tobytes()], pa.binary())})

    parts = texts.mapInArrow(tidy(run), "at bigint, rows binary")
    summed = parts.groupBy("at").applyInArrow(add, "at bigint, rows binary").toArrow()
    out = np.zeros((height, width))
    for at, raw in zip(summed["at"].to_pylist(), summed["rows"].to_pylist()):
        out[at:at + 256] = np.frombuffer(raw).reshape(-1, width)
    return out


@dataclass
class Index:
    """Latent word vectors (IDF-weighted), item passages and items."""

    vectors: np.ndarray  # FEATURES x RANK, and a row of zeros
    passages: np.ndarray  # unit vectors of the items' passages
    owner: np.ndarray  # item of each passage
    items: list[np.ndarray]  # word hashes
    answers: list[np.ndarray]  # word hashes of the last sentence
    rare: np.ndarray  # whether a feature is rarer than FREQUENT
    ids: list  # item ids


class Windows:
    """All windows of ``WINDOW`` words that begin every ``STRIDE`` words, as runs of strides."""

    def __init__(self, firsts: np.ndarray):
        self.strides, first = tiles(firsts, STRIDE)
        self.words = int(firsts[-1])
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        last = first[text + 1] - 1  # last stride of the text
        at = np.arange(len(self.strides))
        whole = (at + WINDOW // STRIDE - 1 <= last) | (at == first[text])  # shorter ones only at the start of a short text
        self.at, self.last = at[whole], last[whole]
        self.begin = self.strides[self.at]
        self.end = np.minimum(self.begin + WINDOW, firsts[text[self.at] + 1])

    def sums(self, table: np.ndarray, row: np.ndarray, first: int, last: int) -> np.ndarray:
        """Sum of the rows of ``table`` (its last row is zero) of the words of each window, of some windows."""
        at, ends = self.at[first:last], self.last[first:last]
        a, b = int(at[0]), int(min(ends[-1], at[-1] + WINDOW // STRIDE - 1)) + 1
        start, stop = self.strides[a], self.strides[b] if b < len(self.strides) else self.words
        strides = _with_zero_row(_row_sums(table, row[start:stop], self.strides[a:b] - start, STRIDE))
        out = strides[at - a]
        for k in range(1, WINDOW // STRIDE):
            out += strides[np.where(at + k <= ends, at + k - a, b - a)]
        return out


def _item_passages(vectors: np.ndarray, items: list[np.ndarray]):
    """Unit vectors of windows of ``WINDOW`` words, every half window and at the end of each item."""
    rows, owner = [], []
    for i, item in enumerate(items):
        starts = sorted({*range(0, max(1, len(item) - WINDOW + 1), WINDOW // 2), max(0, len(item) - WINDOW)}) if len(item) else []
        for s in starts:
            row = vectors[features(item[s:s + WINDOW])].sum(0)
            rows.append(row / max(float(np.sqrt((row ** 2).sum())), 1e-9))
            owner.append(i)
    return np.array(rows, np.float32).reshape(-1, vectors.shape[1]), np.array(owner, np.int64)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows ** 2).sum(1, keepdims=True)), 1e-12)


def build_index(documents: DataFrame, benchmark: DataFrame) -> Index:
    """Index of ``benchmark`` (item_id, text) with statistics and directions of all ``documents`` (text)."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MOST_ITEM_BYTES:
        raise ValueError(f"the benchmark holds {size} bytes of text; search it in parts of {MOST_ITEM_BYTES}")
    rows = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").orderBy("item_id", "text").collect()
    ids, items, answers = [], [], []
    for r in rows:
        sentences = [s for s in re.split(r"[.!?\n]+", r["text"]) if any(c.isalnum() for c in s)]
        both = [_words_of(r["text"]), _words_of(sentences[-1]) if sentences else np.zeros(0, np.uint64)]
        if len(both[0]):
            ids.append(r["item_id"])
            items.append(both[0])
            answers.append(both[1])
    every = stage(_word_features(documents.select("text").union(benchmark.select("text"))))
    found, total = _frequencies(every)
    idf = np.sqrt((total + 1) / (found + 1))
    # Few tasks: each adds up one matrix, however many texts it has.
    every = every.coalesce(GRAM_TASKS * documents.sparkSession.sparkContext.defaultParallelism)
    rng = np.random.default_rng(7)
    directions = rng.standard_normal((FEATURES, RANK + COMMON + OVERSAMPLE))
    for _ in range(2):
        directions, _ = np.linalg.qr(_gram(every, idf, directions))
    values, inner = np.linalg.eigh(_gram(every, idf, directions, True))
    top = np.argsort(-values)[:RANK + COMMON]
    basis = directions @ inner[:, top] / np.sqrt(np.maximum(values[top], 1e-9 * max(values.max(), 1e-9)))
    # Words of equal length, without their mean and the directions that most of them share: these tell
    # languages apart and not passages.
    basis = _unit(_unit(basis) - _unit(basis)[found > 0].mean(0))
    _, shared = np.linalg.eigh(basis[found > 0].T @ basis[found > 0])
    basis = _unit(basis @ shared[:, :RANK])
    vectors = np.append(basis * idf[:, None], np.zeros((1, RANK)), axis=0).astype(np.float32)
    return Index(vectors, *_item_passages(vectors, items), items, answers, found < FREQUENT * total, ids)


def _words_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words(data, np.array([0, len(data)]))[0]


def _places(item: np.ndarray) -> dict[int, int]:
    """Bits of the places of each word of the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    return places


def common_subsequence(item: np.ndarray, text: list[int], places: dict[int, int] | None = None, least: float = 0) -> int:
    """Length of the longest common subsequence, a word of the text at a time over the bits of the item.

    ``places``: those of the item, if known. A length under ``least`` may be given as the words of the text that
    the item has, where these are fewer than ``least`` already.
    """
    places = _places(item) if places is None else places
    hits = [places[w] for w in text if w in places]
    if len(hits) < least:
        return len(hits)
    full = (1 << len(item)) - 1
    row = full
    for hit in hits:
        met = row & hit
        row = ((row + met) | (row - met)) & full
    return len(item) - row.bit_count()


def _tightest(item: np.ndarray, text: list[int], places: dict[int, int]) -> tuple[int, list[int]]:
    """The longest common subsequence with ``STRETCH`` times the item's words in a row, and these words."""
    width = int(STRETCH * len(item)) + 1
    starts = range(0, max(1, len(text) - width + max(1, len(item) // 4)), max(1, len(item) // 4))
    return max(((common_subsequence(item, text[s:s + width], places), text[s:s + width]) for s in starts),
               key=lambda x: x[0])


class Searcher:
    def __init__(self, index: Index):
        self.index = index
        self.sizes = np.array([len(x) for x in index.items], np.int64)
        self.rare = [x[index.rare[features(x)]] for x in index.items]
        self.places = [_places(x) for x in index.items]
        # Blocks of passages, their items, and which of these have a word, by ten bits of its hash.
        self.blocks = []
        for at in range(0, len(index.owner), ITEMS):
            owner = index.owner[at:at + ITEMS]
            low, high = int(owner[0]), int(owner[-1]) + 1
            holds = np.zeros((1025, high - low), np.uint8)  # the last row is zero
            for i in range(low, high):
                holds[(index.items[i] >> np.uint64(54)).astype(np.int64), i - low] = 1
            self.blocks.append((index.passages[at:at + ITEMS].T, owner, low, holds))

    def matches(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, float, float]]:
        """(text, item, first word, common words, share, cosine), the best place for each text and item."""
        index = self.index
        hashes, firsts = words(data, bounds)
        windows = Windows(firsts)
        begin, end = windows.begin, windows.end
        feature, key = features(hashes), (hashes >> np.uint64(54)).astype(np.int64)
        best: dict[tuple[int, int], tuple] = {}
        reach: dict[tuple[int, int], int] = {}  # words already compared with an item, by text and item
        hits = []
        for row in range(0, len(begin), _WINDOWS):  # bounded memory for any text
            stop = min(row + _WINDOWS, len(begin))
            vectors = windows.sums(index.vectors, feature, row, stop)
            vectors /= np.maximum(np.sqrt((vectors ** 2).sum(1, keepdims=True)), 1e-9)
            for passages, owner, low, holds in self.blocks:
                cosine = vectors @ passages
                w, p = np.divmod(np.flatnonzero(cosine.ravel() >= COSINE), cosine.shape[1])
                near, item = cosine[w, p], owner[p]
                common = windows.sums(holds, key, row, stop)[w, item - low]
                w += row
                # enough words of the item beside it
                keep = common >= COMMON_WORDS * np.minimum(end[w] - begin[w], self.sizes[item])
                hits.append((w[keep], item[keep], near[keep]))
        if not hits:
            return []
        window, item, cosine = (np.concatenate(x) for x in zip(*hits))
        order = np.lexsort((window, item))
        text = np.searchsorted(firsts, begin[window], "right") - 1
        for j in order.tolist():
            i, t = int(item[j]), int(text[j])
            size = len(index.items[i])
            a = max(int(begin[window[j]]) - size, int(firsts[t]))
            b = min(int(end[window[j]]) + size, int(firsts[t + 1]))
            if b <= reach.get((t, i), -1):
                continue
            reach[t, i] = b
            around = hashes[a:b].tolist()
            common = common_subsequence(index.items[i], around, self.places[i], SHARE * size)
            if common < SHARE * size:
                continue
            common, around = _tightest(index.items[i], around, self.places[i])
            answer, rare = index.answers[i], self.rare[i]
            known = common_subsequence(rare, around)
            enough = SHARE if known >= FEW else SURE
            if (common >= enough * size and known >= SHARE * len(rare)
                    and common_subsequence(answer, around) >= ANSWER * len(answer)):
                found = (t, i, a - int(firsts[t]), common, common / size, float(cosine[j]))
                if (t, i) not in best or common > best[t, i][3]:
                    best[t, i] = found
        return [best[k] for k in sorted(best)]


def contaminated(documents: DataFrame, index: Index, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, item, first_word, common_words, share, cosine``; ``item`` is the place in ``index.ids``."""
    kind = documents.schema[id_column].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        searcher = Searcher(shared.value)
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1), _SEARCH_BYTES):
                found = searcher.matches(data, bounds)
                columns = list(zip(*found)) or [()] * 6
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first).take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()),
                    pa.array(columns[4], pa.float64()), pa.array(columns[5], pa.float64())],
                    ["doc_id", "item", "first_word", "common_words", "share", "cosine"])

    schema = f"doc_id {kind}, item bigint, first_word bigint, common_words bigint, share double, cosine double"
    return documents.select(id_column, text_column).mapInArrow(tidy(run), schema)


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, first_word, common_words, share, cosine`` for every document that holds an item."""
    index = build_index(documents, benchmark)
    spark = documents.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    names = spark.createDataFrame([(i, v) for i, v in enumerate(index.ids)], f"item bigint, item_id {kind}")
    return (contaminated(documents, index).join(F.broadcast(names), "item")
            .select("doc_id", "item_id", "first_word", "common_words", "share", "cosine"))


def keep_clean(documents: DataFrame, index: Index, text_column: str = "text") -> DataFrame:
    """The rows of ``documents`` that hold no item, with their columns as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(index)
    copy, leaked = unique_marker(documents, "_searched_text"), unique_marker(documents, "_leaked")

    def make():
        searcher = Searcher(shared.value)

        def columns(data, bounds):
            found = np.zeros(len(bounds) - 1, bool)
            found[[m[0] for m in searcher.matches(data, bounds)]] = True
            return [pa.array(found)]

        return columns

    marked = with_text_columns(documents.withColumn(copy, F.col(text_column)), copy, f"`{leaked}` boolean", make,
                               _SEARCH_BYTES)
    return marked.where(~F.col(leaked)).select(*[F.col(f"`{c}`") for c in documents.columns])
