"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary, and every single byte, have one probability for each language. A
word's probability in a language is the sum over all its segmentations into pieces, by the forward
algorithm; a text's log-likelihood is the sum over its words. Probabilities come from expected piece counts
(forward-backward) over the words of labelled texts, in ``STEPS`` rounds.

A word is a run of letters (ASCII letters and all bytes from 0x80), lower-cased A-Z, with a space in front.
Each distinct word is scored once for as long as a task remembers it. Words of more than ``LONG`` bytes (texts
in scripts without spaces) are cut into strides, whose forward sums from every possible start are taken side by
side and then chained, which gives the same sum over all segmentations.

Training is bounded by documented parameters (``TEXTS`` texts and ``WORDS`` distinct words of each language);
every text of the table is scored whole.

Defined results: ``und`` with score 0 for NULL and for texts without a letter, and everywhere if nothing was
learned; ties go to the language that is first in alphabetical order; rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .mapping import Table, with_text_columns
from .ragged import Hasher, Memo, ranges, spans_of, text_slices

#: Texts of a language that are learned from (about; by a hash of the id), and its most frequent words.
TEXTS, WORDS, STEPS = 2500, 8000, 4
#: Longest piece in bytes, and longest word learned from.
PIECE, LEARNED = 12, 32
#: Bytes from which on a word is scored in strides, bytes of a stride, and strides side by side.
LONG, STRIDE, STRIDES = 1024, 128, 1024

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def vocabulary(path: str) -> list[bytes]:
    """Byte strings of a piece model's entries of up to ``PIECE`` bytes, lower-cased A-Z, and all single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode().lower()
            if 0 < len(piece) <= PIECE and b" " not in piece[1:]:
                found.add(piece)
    return sorted(found)


def _hashes(pieces: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    return Hasher(data).spans(ends - np.array([len(p) for p in pieces]), ends)


@dataclass
class Model:
    languages: list[str]
    pieces: np.ndarray  # hashes
    probability: np.ndarray  # pieces x languages


class Lattice:
    """Pieces that end at each byte of many words. Words are sorted by descending length."""

    def __init__(self, table: Table, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        lengths = ends - starts + 1  # with the space in front
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        begin = np.cumsum(self.lengths) - self.lengths
        buffer = np.full(int(self.lengths.sum()), 0x20, np.uint8)
        inner = self.lengths - 1
        buffer[ranges(begin + 1, inner)] = _lower(data[ranges(starts[self.order], inner)])
        self.begin, self.table, self.hasher = begin, table, Hasher(buffer)
        # words that have a byte at step t: the first `active[t]`
        self.active = np.searchsorted(-self.lengths, -np.arange(1, int(self.lengths[0]) + 1), "right") if len(begin) else []

    def pieces(self, t: int, size: int) -> np.ndarray:
        """Vocabulary row of the last ``size`` bytes up to byte ``t`` of each active word, or -1."""
        end = self.begin[:self.active[t]] + t + 1
        return self.table.rows(self.hasher.spans(end - size, end))


def _lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def log_likelihoods(lattice: Lattice, probability: np.ndarray) -> np.ndarray:
    """Log of the sum over all segmentations of each word (in the lattice's order), for each language.

    ``probability`` has a last row of zeros, for spans that are no piece.
    """
    n, k = len(lattice.lengths), probability.shape[1]
    out = np.zeros((n, k))
    scale = np.zeros((n, k))
    window = [np.ones((n, k))]  # forward sums, the newest first
    for t in range(len(lattice.active)):
        m = int(lattice.active[t])
        total = np.zeros((m, k))
        for size in range(1, min(PIECE, t + 1) + 1):
            total += window[size - 1][:m] * probability[lattice.pieces(t, size)]
        window.insert(0, total)
        del window[PIECE:]
        window = [w[:m] for w in window]
        if t % 8 == 7:  # keep the sums in range
            by = np.maximum(total, 1e-280)
            window = [w / by for w in window]
            scale[:m] += np.log(by)
        ended = slice(int(lattice.active[t + 1]) if t + 1 < len(lattice.active) else 0, m)
        out[ended] = np.log(np.maximum(window[0][ended], 1e-300)) + scale[ended]
    return out


def _transfers(table: Table, hasher: Hasher, begins: np.ndarray, steps: int, probability: np.ndarray):
    """How the last ``PIECE`` forward sums before each of ``begins`` become those ``steps`` bytes later.

    Gives (stride, sum after, sum before, language) and the logarithm taken out of each stride and language.
    """
    m, k = len(begins), probability.shape[1]
    window = [np.zeros((m, PIECE, k)) for _ in range(PIECE)]  # the newest first
    for j in range(PIECE):
        window[j][:, j] = 1
    logs = np.zeros((m, k))
    for t in range(steps):
        ends = begins + t + 1
        total = np.zeros((m, PIECE, k))
        for size in range(1, PIECE + 1):
            inside = ends >= size
            rows = np.where(inside, table.rows(hasher.spans(np.where(inside, ends - size, 0), ends)), -1)
            if (rows >= 0).any():
                total += window[size - 1] * probability[rows][:, None, :]
        window = [total, *window[:-1]]
        if t % 8 == 7:
            by = np.maximum(total.max(1), 1e-280)
            window = [w / by[:, None, :] for w in window]
            logs += np.log(by)
    return np.stack(window, 1), logs


def long_log_likelihood(table: Table, word: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """``log_likelihoods`` of one word (its lower-cased bytes), by strides."""
    buffer = np.append(np.uint8(0x20), word)
    hasher, k = Hasher(buffer), probability.shape[1]
    whole = len(buffer) // STRIDE
    parts = [(np.arange(a, min(a + STRIDES, whole)) * STRIDE, STRIDE) for a in range(0, whole, STRIDES)]
    if len(buffer) % STRIDE:
        parts.append((np.array([whole * STRIDE]), len(buffer) % STRIDE))
    state, scale = np.zeros((PIECE, k)), np.zeros(k)
    state[0] = 1
    for begins, steps in parts:
        matrices, logs = _transfers(table, hasher, begins, steps, probability)
        for matrix, log in zip(matrices, logs):
            state = (matrix * state[None]).sum(1)
            by = np.maximum(state.max(0), 1e-280)
            state, scale = state / by, scale + np.log(by) + log
    return np.log(np.maximum(state[0], 1e-300)) + scale


def expected_counts(lattice: Lattice, probability: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected occurrences of each piece in words of at most ``LEARNED`` bytes with ``weights``; one language."""
    n, steps = len(lattice.lengths), len(lattice.active)
    rows = {(t, s): lattice.pieces(t, s) for t in range(steps) for s in range(1, min(PIECE, t + 1) + 1)}
    forward = np.zeros((n, steps + 1))
    forward[:, 0] = 1
    for t in range(steps):
        m = int(lattice.active[t])
        for s in range(1, min(PIECE, t + 1) + 1):
            forward[:m, t + 1] += forward[:m, t + 1 - s] * probability[rows[t, s]]
    backward = np.zeros((n, steps + 1))
    backward[np.arange(n), lattice.lengths] = 1
    for t in range(steps - 1, -1, -1):
        m = int(lattice.active[t])
        for s in range(1, min(PIECE, t + 1) + 1):
            backward[:m, t + 1 - s] += backward[:m, t + 1] * probability[rows[t, s]]
    share = weights / np.maximum(forward[np.arange(n), lattice.lengths], 1e-300)
    counts = np.zeros(len(probability))
    for (t, s), found in rows.items():
        m = len(found)
        counts += np.bincount(found + 1, weights=share[:m] * forward[:m, t + 1 - s] * backward[:m, t + 1]
                              * probability[found], minlength=len(probability) + 1)[1:]
    return counts


def _word_counts(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` over ``texts`` (text, lang)."""
    def run(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(0)):
                starts, ends, firsts = spans_of(_LETTER[data], bounds)
                if not len(starts):
                    continue
                codes = batch.column(1).slice(first, last - first).dictionary_encode()
                own = np.repeat(codes.indices.to_numpy(zero_copy_only=False), np.diff(firsts)).astype(np.int64)
                hashes = Hasher(data, lower=True).spans(starts, ends)
                order = np.lexsort((hashes, own))
                h, own = hashes[order], own[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
                at = np.flatnonzero(new)
                raw = _lower(data).tobytes()
                one = order[at]
                words = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [codes.dictionary.take(pa.array(own[at])), pa.array(words, pa.binary()),
                     pa.array(np.diff(np.append(at, len(h))))], ["lang", "word", "n"])

    counted = texts.select("text", "lang").mapInArrow(run, "lang string, word binary, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(documents: DataFrame, vocabulary_path: str, folds: int = 3, held_out: int = 1) -> Model:
    """Learn from ``documents`` (doc_id, text, lang) whose id's CRC-32 modulo ``folds`` is not ``held_out``."""
    rows = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (F.crc32(F.col("doc_id").cast("string")) % folds != held_out))
    sizes = rows.groupBy("lang").count()
    share = F.least(F.lit(1.0), F.lit(float(TEXTS)) / F.col("count"))
    picked = (rows.join(F.broadcast(sizes), "lang")  # one row for each language
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    words = (stage(_word_counts(picked)).where(F.length("word") < LEARNED)
             .withColumn("_at", F.row_number().over(top)).where(F.col("_at") <= WORDS)
             .select("lang", "word", "n").toArrow())
    languages = sorted(set(words["lang"].to_pylist()))
    pieces = vocabulary(vocabulary_path)
    hashes = _hashes(pieces)
    probability = np.zeros((len(pieces) + 1, len(languages)))
    lang, word, n = (words[c].to_pylist() for c in ("lang", "word", "n"))
    for j, language in enumerate(languages):
        own = [i for i, x in enumerate(lang) if x == language]
        lengths = np.array([len(word[i]) for i in own])
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(word[i] for i in own), np.uint8)
        lattice = Lattice(Table(hashes), data, ends - lengths, ends)
        weights = np.array([n[i] for i in own], float)[lattice.order]
        p = np.append(np.full(len(pieces), 1 / len(pieces)), 0.0)
        for _ in range(STEPS):
            counts = expected_counts(lattice, p, weights)[:-1] + 0.01
            p = np.append(counts / counts.sum(), 0.0)
        probability[:, j] = p
    return Model(languages, hashes, probability)


class Classifier:
    def __init__(self, model: Model):
        self.model, self.table = model, Table(model.pieces)
        self.memo = Memo(limit=600_000, dtype=np.float32)

    def likelihoods(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Log-likelihood of each text in each language."""
        k = len(self.model.languages)
        starts, ends, firsts = spans_of(_LETTER[data], bounds)
        if not len(starts) or not k:
            return np.zeros((len(bounds) - 1, k))

        def make(at):
            found = np.empty((len(at), k), np.float32)
            long = ends[at] - starts[at] > LONG
            for i in np.flatnonzero(long).tolist():
                found[i] = long_log_likelihood(
                    self.table, _lower(data[starts[at[i]]:ends[at[i]]]), self.model.probability)
            rest = np.flatnonzero(~long)
            if len(rest):
                lattice = Lattice(self.table, data, starts[at[rest]], ends[at[rest]])
                found[rest[lattice.order]] = log_likelihoods(lattice, self.model.probability)
            return found.reshape(-1), np.full(len(at), k)

        rows = self.memo.rows(Hasher(data, lower=True).spans(starts, ends), make)
        each = self.memo.flat[self.memo.begin[rows][:, None] + np.arange(k)].astype(np.float64)
        sums = np.concatenate([np.zeros((1, k)), np.cumsum(each, 0)])
        return sums[firsts[1:]] - sums[firsts[:-1]]


def identify(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``documents`` without its text column, with ``lang_pred`` and ``score`` (the posterior, even priors)."""
    letter = "_has_letter"
    while letter in documents.columns:
        letter += "_"
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        classifier = Classifier(shared.value)
        names = pa.array(classifier.model.languages or ["und"])

        def columns(data, bounds):
            found = classifier.likelihoods(data, bounds)
            if not found.shape[1]:
                n = len(bounds) - 1
                return [pa.array(["und"] * n), pa.array(np.zeros(n))]
            best = found.argmax(1)
            posterior = 1 / np.exp(np.maximum(found - found.max(1, keepdims=True), -700)).sum(1)
            return [names.take(pa.array(best)), pa.array(posterior)]

        return columns

    marked = documents.withColumn(letter, F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False)))
    found = with_text_columns(marked, text_column, "lang_pred string, score double", make)
    known = F.col(letter)
    return (found.withColumn("lang_pred", F.when(known, F.col("lang_pred")).otherwise("und"))
            .withColumn("score", F.when(known & (F.col("lang_pred") != "und"), F.col("score")).otherwise(0.0))
            .drop(letter))
