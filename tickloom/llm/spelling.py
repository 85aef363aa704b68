"""Spelling variants: words one edit apart, found by a trie over counts of letter groups.

A word becomes its frequency vector: how often each of 12 letter groups occurs in it. The trie arranges the words
by these counts, one group a level. One inserted, deleted or replaced letter raises at most one count by one and
lowers at most one by one, so a depth-first search follows the word's own count, one more or one less at each
level, and may spend a surplus of one and a deficit of one on its way. The words of the leaves that it reaches
are verified. A pair of words is searched from one side only: the first count in which they differ is spent as
the surplus, and words with equal vectors meet in code-point order.

On a cluster the trie is cut into shards at its heads: the node at level 4, 8 or 12 below which at most
``SHARD_WORDS`` words lie. The top of the trie is walked with joins against the heads that exist, a
shard's part is walked inside the task that holds its words; searching words stream past it. A leaf with more
words than that is dealt into blocks, and the words that search it go to each block.

Within a leaf, only words that share their first or last three letters with the searching word are compared:
one edit leaves one end of a word of seven letters or more as it is.

Defined results: a NULL or empty text has no words; a NULL id counts as the empty text in the hash that deletes
letters; repeated rows count each time; words of any length are handled; other columns of the input are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .ragged import ranges

SHORTEST, LEAST, TIMES, EVERY = 7, 2, 10, 31
SHARD_WORDS = 1 << 14
#: Letters of each level of the trie, commonest first; any other letter goes by its code point.
GROUPS = ("e", "aj", "nx", "iw", "sk", "rq", "tz", "oy", "lvb", "dgf", "uph", "cm")
LEVELS = len(GROUPS)
HEADS = (4, 8, LEVELS)
_ENDS = 3
_STATES = 1 << 16
_PAIRS = 1 << 15
#: Words up to this length are verified in bulk.
_SHORT = 64
_GROUP = np.arange(256, dtype=np.uint8) % LEVELS
for _level, _letters in enumerate(GROUPS):
    _GROUP[list(_letters.encode())] = _level


def word_counts(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n``: words of at least ``SHORTEST`` letters that occur at least ``LEAST`` times.

    A word is a run of Latin letters, A-Z lower-cased. Where ``EVERY`` divides the checksum of ``<id>:<run>``, one letter
    of the run, picked by the checksum, is missing.
    """
    letters = "".join(chr(c) for c in range(65, 91))
    low = F.translate(F.col(text_column), letters, letters.lower())
    pattern = f"[a-zÀ-ÿ]{{{SHORTEST},}}+"  # shorter runs cannot become longer
    runs = documents.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(low, F.lit(pattern), F.lit(0))).alias("run"))
    checked = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = checked.select(F.when(F.col("h") % EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n")).where(
        F.col("n") >= LEAST)


class Words:
    """Words of an Arrow array as one buffer of Latin-1 letters."""

    def __init__(self, column):
        self.column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        self.size = pc.utf8_length(self.column).to_numpy().astype(np.int64)
        self.letters = np.frombuffer("".join(self.column.to_pylist()).encode("latin-1"), np.uint8)
        self.start = np.cumsum(self.size) - self.size

    def __len__(self) -> int:
        return len(self.size)

    def vectors(self) -> np.ndarray:
        """Counts of the letter groups, up to 255: counts one apart stay at most one apart."""
        owner = np.repeat(np.arange(len(self)), self.size)
        counts = np.bincount(owner * LEVELS + _GROUP[self.letters], minlength=len(self) * LEVELS)
        return np.minimum(counts, 255).astype(np.uint8).reshape(-1, LEVELS)

    def ends(self, last: bool) -> np.ndarray:
        """The first or last three letters as a number."""
        at = self.start + (self.size - _ENDS if last else 0)
        out = np.zeros(len(self), np.int64)
        for k in range(_ENDS):
            out = out << 8 | self.letters[at + k]
        return out

    def padded(self, rows: np.ndarray, width: int, right: bool) -> np.ndarray:
        size = self.size[rows]
        column = np.arange(width)[None, :] - ((width - size)[:, None] if right else 0)
        inside = (column >= 0) & (column < size[:, None])
        return np.where(inside, self.letters[np.where(inside, self.start[rows][:, None] + column, 0)], 0)

    def text(self, row: int) -> np.ndarray:
        return self.letters[self.start[row]:self.start[row] + self.size[row]]


def _agreeing(same: np.ndarray) -> np.ndarray:
    """How many leading columns of each row are True."""
    return np.where(same.all(1), same.shape[1], (~same).argmax(1))


def one_apart(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether words ``i`` of ``a`` and ``j`` of ``b`` differ by exactly one inserted, deleted or replaced letter."""
    out = np.zeros(len(i), bool)
    longest = np.maximum(a.size[i], b.size[j])
    near = np.abs(a.size[i] - b.size[j]) <= 1
    for low in range(0, len(i), _PAIRS):
        at = low + np.flatnonzero((near & (longest <= _SHORT))[low:low + _PAIRS])
        if not len(at):
            continue
        m, width = longest[at], int(longest[at].max())
        left = a.padded(i[at], width, False) == b.padded(j[at], width, False)
        right = a.padded(i[at], width, True) == b.padded(j[at], width, True)
        # Beyond its own length a shorter word is padded on both sides alike; the longer word holds no padding.
        head, tail = _agreeing(left), _agreeing(right[:, ::-1])
        out[at] = (head < m) & (head + tail >= m - 1)
    for at in np.flatnonzero(near & (longest > _SHORT)):
        x, y = a.text(i[at]), b.text(j[at])
        n = min(len(x), len(y))
        head = _agreeing((x[:n] == y[:n])[None, :])[0]
        tail = _agreeing((x[::-1][:n] == y[::-1][:n])[None, :])[0]
        out[at] = head < longest[at] <= head + tail + 1
    return out


def steps(spent: int) -> list[tuple[int, int]]:
    """(change of the count, spent afterwards) that a search may take. Spent: 0 nothing, 1 the surplus, 2 both."""
    return [[(0, 0), (1, 1)], [(0, 1), (-1, 2)], [(0, 2)]][spent]


class Trie:
    """Words arranged by their vectors from level ``top`` on; those above are the same for all of them."""

    def __init__(self, words: Words, vectors: np.ndarray, top: int):
        self.words, self.top = words, top
        node = np.zeros(len(words), np.int64)
        self.children = []
        for level in range(top, LEVELS):
            keys, node = np.unique(node << 8 | vectors[:, level], return_inverse=True)
            self.children.append(keys)
        self.sides = []
        for last in (False, True):
            key = node << 8 * _ENDS | words.ends(last)
            order = np.argsort(key, kind="stable")
            self.sides.append((key[order], order))

    def search(self, words: Words, vectors: np.ndarray, spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(searching words, words of the trie) one edit apart, each pair once.

        Depth first: a stack of bundles of search states, the deepest bundle is taken on first.
        """
        stack = [(0, np.arange(low, min(low + _STATES, len(words))), None, spent[low:low + _STATES])
                 for low in range(0, len(words), _STATES)]
        while stack:
            depth, query, node, used = stack.pop()
            node = np.zeros(len(query), np.int64) if node is None else node
            if depth == len(self.children):
                yield from self._verified(words, query, node, used)
                continue
            keys, reached = self.children[depth], []
            count = vectors[query, self.top + depth].astype(np.int64)
            for before in range(3):
                at = np.flatnonzero(used == before)
                for change, after in steps(before):
                    wanted = count[at] + change
                    key = node[at] << 8 | np.clip(wanted, 0, 255)
                    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    found = (keys[place] == key) & (wanted >= 0) & (wanted <= 255)
                    reached.append((query[at[found]], place[found], np.full(int(found.sum()), after, np.int8)))
            query, node, used = (np.concatenate(x) for x in zip(*reached))
            for low in range(0, len(query), _STATES):
                part = slice(low, low + _STATES)
                stack.append((depth + 1, query[part], node[part], used[part]))

    def _verified(self, words: Words, query: np.ndarray, leaf: np.ndarray, used: np.ndarray):
        for last, (keys, order) in enumerate(self.sides):
            key = leaf << 8 * _ENDS | words.ends(bool(last))[query]
            low, high = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
            sizes = np.cumsum(high - low)
            first = 0
            while first < len(query):
                done = sizes[first - 1] if first else 0
                end = max(first + 1, int(np.searchsorted(sizes, done + _STATES, "right")))
                some = slice(first, end)
                first = end
                pairs = high[some] - low[some]
                i, j = np.repeat(query[some], pairs), order[ranges(low[some], pairs)]
                good = one_apart(words, i, self.words, j)
                if last:  # those with the same beginning came with the first side
                    good &= words.ends(False)[i] != self.words.ends(False)[j]
                i, j, equal = i[good], j[good], np.repeat(used[some], pairs)[good] == 0
                if equal.any():
                    mine, other = words.column.take(pa.array(i)), self.words.column.take(pa.array(j))
                    good = ~equal | pc.less(mine, other).to_numpy(zero_copy_only=False)
                    i, j = i[good], j[good]
                yield i, j


def _reach(prefix: np.ndarray, spent: np.ndarray, own: np.ndarray, first: int, last: int):
    """Rows, prefixes and what is spent after the levels ``first`` to ``last - 1``, for all steps that can be taken."""
    rows, reached = np.arange(len(own)), prefix
    for level in range(first, last):
        parts = []
        for before in range(3):
            at = np.flatnonzero(spent == before)
            for change, after in steps(before):
                count = own[rows[at], level].astype(np.int64) + change
                on = (count >= 0) & (count <= 255)
                parts.append((rows[at[on]], np.column_stack([reached[at[on]], count[on].astype(np.uint8)]),
                              np.full(int(on.sum()), after, np.int8)))
        rows, reached, spent = (np.concatenate(x) for x in zip(*parts))
    return rows, reached, spent


def _fixed(rows: np.ndarray) -> pa.Array:
    raw, width = np.ascontiguousarray(rows).tobytes(), rows.shape[1]
    return pa.array([raw[k:k + width] for k in range(0, len(raw), width)] if width else [b""] * len(rows), pa.binary())


def _unfixed(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _with_vectors(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _fixed(Words(batch.column(0)).vectors())], ["word", "n", "vec"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, vec binary")


def _deeper(states: DataFrame, first: int, last: int) -> DataFrame:
    """Search states ``word, n, vec, head, spent`` at level ``first`` taken on to level ``last``."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            own = _unfixed(batch.column(2), LEVELS)
            rows, heads, spent = _reach(_unfixed(batch.column(3), first), batch.column(4).to_numpy().astype(np.int8),
                                        own, first, last)
            for low in range(0, len(rows), _STATES):
                at = slice(low, low + _STATES)
                part = batch.take(pa.array(rows[at]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], _fixed(heads[at]), pa.array(spent[at].astype(np.int32))],
                    ["word", "n", "vec", "head", "spent"])

    return states.mapInArrow(run, "word string, n bigint, vec binary, head binary, spent int")


def _routed(words: DataFrame, shard_words: int) -> DataFrame:
    """``head, block, home, word, n, vec, spent``: every word at its shard, and at each shard that it searches."""
    homes, searches = [], []
    rest = words.select("word", "n", "vec", F.lit(b"").alias("head"), F.lit(0).alias("spent"))
    states, first = rest, 0
    for last in HEADS:
        rest = rest.withColumn("head", F.substring("vec", 1, last))
        states = _deeper(states, first, last)
        heads = stage(rest.groupBy("head").agg(F.count("*").alias("words")))
        big = F.col("words") > shard_words
        lasting = F.lit(True) if last == LEVELS else ~big
        blocks = F.ceil(F.col("words") / shard_words).cast("int")
        found = stage(states.join(heads, "head"))
        homes.append(rest.join(heads.where(lasting), "head")
                     .withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int")).withColumn("home", F.lit(True)))
        searches.append(found.where(lasting).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
                        .withColumn("home", F.lit(False)))
        if last == LEVELS or not heads.where(big).limit(1).count():
            break
        rest = rest.join(heads.where(big).select("head"), "head", "left_semi").select("word", "n", "vec", "head", "spent")
        states = found.where(big).select("word", "n", "vec", "head", "spent")
        first = last
    columns = ("head", "block", "home", "word", "n", "vec", "spent")
    out = None
    for part in (*homes, *searches):
        out = part.select(*columns) if out is None else out.union(part.select(*columns))
    return out


def _best(word: pa.Array, other: pa.Array, n: np.ndarray) -> pa.Table:
    """For each word how many others it has here, and the one of largest ``n``, least in code-point order."""
    table = pa.table({"word": word, "other": other, "n": pa.array(n)})
    table = table.sort_by([("word", "ascending"), ("n", "descending"), ("other", "ascending")])
    return table.group_by("word", use_threads=False).aggregate([("n", "count"), ("n", "first"), ("other", "first")])


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` of the words (``word, n``) that have another one edit apart."""
    def run(batches):
        group, homes, trie = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            heads, block = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            change = pc.not_equal(batch.column(0)[1:], batch.column(0)[:-1]).to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero(change | (block[1:] != block[:-1])) + 1).tolist()
            for x, y in zip([0, *cuts], [*cuts, len(batch)]):
                if (heads[x], block[x]) != group:
                    group, homes, trie = (heads[x], block[x]), [], None
                part = batch.slice(x, y - x)
                home = pc.sum(part.column(2)).as_py()
                homes += [part.slice(0, home)] if home else []
                part = part.slice(home)
                if not len(part) or not homes:
                    continue
                if trie is None:
                    table = pa.Table.from_batches(homes).combine_chunks()
                    held, held_n = Words(table.column(3)), table.column(4).to_numpy()
                    trie = Trie(held, _unfixed(table.column(5), LEVELS), len(group[0]))
                query, n = Words(part.column(3)), part.column(4).to_numpy()
                for i, j in trie.search(query, _unfixed(part.column(5), LEVELS), part.column(6).to_numpy().astype(np.int8)):
                    if len(i):
                        mine, other = query.column.take(pa.array(i)), held.column.take(pa.array(j))
                        both = _best(pa.concat_arrays([mine, other]), pa.concat_arrays([other, mine]),
                                     np.concatenate([held_n[j], n[i]]))
                        yield from both.select(["word", "n_count", "n_first", "other_first"]).rename_columns(
                            ["word", "n_near", "best_n", "best"]).to_batches()

    vectors = stage(_with_vectors(words))
    routed = _routed(vectors, shard_words).repartition("head", "block")
    found = routed.sortWithinPartitions("head", "block", F.desc("home")).mapInArrow(
        run, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """Stored ``word, root`` from stored ``word, form``: chains are halved until none is left.

    Each form occurs at least ten times as often as its word, so a chain is as long as the largest count has digits.
    """
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = stage(links.join(on, "root", "left"))
        links = jumped.select("word", F.coalesce("further", "root").alias("root"))
        if not jumped.where("further IS NOT NULL").limit(1).count():
            return links


def variants(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of `word_counts`."""
    words = stage(word_counts(documents, id_column, text_column))
    known = words.join(near_words(words, shard_words), "word", "left")
    often = F.col("best_n") >= TIMES * F.col("n")
    known = stage(known.select(
        "word", F.when(often, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("best_n")).alias("form_n")))
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
