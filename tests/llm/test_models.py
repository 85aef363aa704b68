"""Trained operators: formulas against brute force, held-out accuracy, and rows out of the ordinary."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import decontaminate, language, personal_data, secrets, toxicity
from tickloom.llm.mapping import Table
from tickloom.llm.ragged import text_slices

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(None, None, None), (900_001, None, "en"), (900_002, "", None), (900_003, " \n\t", "en"), (900_004, "!!! 123", "en"),
       (900_005, "word " * 40_000, "en"), (900_006, "twice", "en"), (900_006, "twice", "en")]
SCHEMA = "doc_id bigint, text string, lang string"


def _slice(text):
    for _, _, data, bounds in text_slices(pa.array([text])):
        return data, bounds


# --- Toxicity ---------------------------------------------------------------------------------------------

def _corpus(n=900):
    """Invented texts; a third holds words that only toxic texts have."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randrange(2, 8))) for _ in range(600)]
    bad = [f"bad{c}" for c in "abcdef"]
    rows, labels = [], []
    for i in range(n):
        text = [words[min(int(rnd.paretovariate(0.7)) - 1, 599)] for _ in range(rnd.randrange(20, 200))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(2 + len(text) // 30):
                text.insert(rnd.randrange(len(text)), rnd.choice(bad))
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxic_texts_are_found_outside_the_training_folds(spark):
    rows, labels = _corpus()
    table = spark.createDataFrame(rows + ODD, SCHEMA).selectExpr("*", "0.5 as score", "1 as _toxic")
    known = spark.createDataFrame([*labels, (None, 1), (900_006, None), (5, 0), (5, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(table, known)
    found = toxicity.score(table, model).withColumn("held", toxicity.fold("doc_id", 5) == 0).collect()
    assert len(found) == len(rows) + len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    truth = dict(labels)
    held = [(truth[r["doc_id"]], r["score"] >= 0.5) for r in found if r["held"] and r["doc_id"] in truth]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.95
    kept = toxicity.keep_ordinary(table, model)
    assert kept.columns == table.columns
    scores = {r["doc_id"]: r["score"] for r in found}
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(
        r["doc_id"] or 0 for r in found if scores[r["doc_id"]] < 0.5)


def test_toxicity_without_labels_or_rows(spark):
    table = spark.createDataFrame(ODD, SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["score"] for r in toxicity.score(table, toxicity.fit(table, none)).collect()} == {0.0}
    assert toxicity.score(table.limit(0), toxicity.fit(table.limit(0), none)).count() == 0


def test_rare_toxic_words_and_contexts_count(spark):
    """A word with fewer than 12 left neighbours, in toxic texts alone, and its place as a context."""
    rnd = random.Random(12)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(120):
        text = rnd.choices(words, k=40)
        if i % 2 and i < 60:
            at = rnd.randrange(40)
            text[at:at] = [words[i % 8], "slurred"]
        rows.append((i, " ".join(text), "en"))
        labels.append((i, i % 2))
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    scorer = toxicity.Scorer(model)
    data, bounds = _slice("slurred")
    key = toxicity.words(data, bounds)[0]
    at = toxicity._rows(model.words, key)
    assert at[0] >= 0 and 0 < model.seen[at[0], 1] < 12 and model.seen[at[0], 0] == 0
    assert toxicity._rows(model.contexts, key)[0] >= 0
    assert scorer.differences(data, bounds)[0][0] > 0 and scorer.differences(*_slice("elsewhere"))[0][0] == 0


def test_words_of_one_two_and_three_toxic_texts_raise_the_score(spark):
    rnd = random.Random(13)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(5)) for _ in range(100)]
    rows, labels = [], []
    planted = {"once": 1, "twotimes": 2, "threetimes": 3}
    left = dict(planted)
    for i in range(200):
        text = rnd.choices(words, k=30)
        if i % 2 and toxicity_fold(i) not in (0, 4):  # a text that the models are counted on
            for w in left:
                if left[w]:
                    text.insert(rnd.randrange(30), w)
                    left[w] -= 1
        rows.append((i, " ".join(text), "en"))
        labels.append((i, i % 2))
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    scorer = toxicity.Scorer(model)
    found = [scorer.differences(*_slice(w))[0][0] for w in ("nowhere", *planted)]
    assert found == sorted(found) and len(set(found)) == 4 and found[0] == 0


def toxicity_fold(i):
    return zlib.crc32(str(i).encode()) % 5


def test_differences_equal_a_plain_model(spark):
    """The same formulas with dictionaries, over texts that the models know in part."""
    rnd = random.Random(14)
    ids = [[i for i in range(400) if i % 2 == y and toxicity_fold(i) not in (0, 4)][:25] for y in (0, 1)]
    texts = [(i, " ".join(rnd.choices("abcdefghij" if y else "cdefghijkl", k=rnd.randrange(9, 25)))) for y in (0, 1) for i in ids[y]]
    labels = [(i, i % 2) for i, _ in texts]
    model = toxicity.fit(spark.createDataFrame([(i, t, "en") for i, t in texts], SCHEMA),
                         spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    pairs, docs = Counter(), Counter()
    for t, y in [(t, i % 2) for i, t in texts]:
        w = t.split()
        for pair in set(zip(["", *w], w)):
            pairs[pair, y] += 1
        for x in set(w):
            docs[x, y] += 1
    plain = PlainModel(pairs, docs)
    scorer = toxicity.Scorer(model)
    for text in ("a b c a", "l k z c", "z", "c d e f g h"):
        w = text.split()
        expected = sum(plain.ratio(a, b) for a, b in zip(["", *w], w)) / (len(w) + toxicity.PRIOR_WORDS)
        assert np.isclose(scorer.differences(*_slice(text))[0][0], expected)


def _insulting(n, every=8):
    """Ordinary texts, and one in ``every`` with words that only toxic texts have."""
    rnd = random.Random(15)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(4)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randrange(20, 60))
        for _ in range(4 * (i % every == 0)):
            text.insert(rnd.randrange(len(text)), rnd.choice(["badaa", "badbb"]))
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(i % every == 0)))
    return rows, labels


def test_a_whole_model_counts_every_labelled_text(spark, monkeypatch):
    """However small the bound of a sample is, and with eight times as many ordinary texts as toxic ones."""
    monkeypatch.setattr(toxicity, "TEXTS_PER_CLASS", 20)
    monkeypatch.setattr(toxicity, "CURVE_TEXTS", 20)
    rows, labels = _insulting(600)
    table = spark.createDataFrame([*rows, (900, None, "en"), (901, "", "en"), (902, rows[8][1], "en")], SCHEMA)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(table, known, whole=True)
    counted = [i for i, _ in labels if toxicity_fold(i) not in (0, 4)]
    held = Counter((w, y) for i in counted for y in [labels[i][1]] for w in set(rows[i][1].split()))
    for word in ("badaa", rows[1][1].split()[0]):
        at = toxicity._rows(model.words, toxicity.words(*_slice(word))[0])[0]
        assert model.texts[at].tolist() == [held[word, 0], held[word, 1]]
    assert model.stored_rows == len({(a, b) for i in counted for w in [rows[i][1].split()] for a, b in zip(["", *w], w)})
    bounded = toxicity.fit(table, known)
    assert bounded.texts[toxicity._rows(bounded.words, toxicity.words(*_slice("badaa"))[0])[0], 1] < held["badaa", 1]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    assert len(scores) == 603 and scores[902] == scores[8] and scores[900] == scores[901]
    unseen = [i for i, _ in labels if toxicity_fold(i) == 0]
    assert sum((scores[i] >= 0.5) == (i % 8 == 0) for i in unseen) / len(unseen) > 0.97
    kept = toxicity.keep_ordinary(table, model)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, s in scores.items() if s < 0.5)


def test_a_whole_model_of_equal_classes_is_the_bounded_one(spark):
    """Then every text counts in full, and pairs that are dealt into parts give what pairs on the driver give."""
    rows, labels = _insulting(300, every=2)
    counted = [[i for i, y in labels if y == c and toxicity_fold(i) not in (0, 4)][:50] for c in (0, 1)]
    chosen = {*counted[0], *counted[1], *[i for i, _ in labels if toxicity_fold(i) in (0, 4)]}
    table = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame([x for x in labels if x[0] in chosen], "doc_id bigint, toxic int")
    whole, bounded = toxicity.fit(table, known, whole=True), toxicity.fit(table, known)
    assert whole.rates == (1, 1) and np.allclose(whole.curve, bounded.curve)
    a, b = ({r["doc_id"]: r["log_ratio"] for r in toxicity.score(table, m).collect()} for m in (whole, bounded))
    assert a.keys() == b.keys() and all(np.isclose(a[i], b[i]) for i in a)


def test_counts_of_the_larger_class_are_those_of_a_share_of_its_texts(spark):
    """Expected numbers of pairs and neighbours, against all choices of texts: each text is in with the same chance."""
    n, rate = (3, 1, 2), 0.3
    rows = [(1, k + 1, v, 0) for k, v in enumerate(n)]
    found = spark.createDataFrame(rows, "word bigint, left bigint, n0 bigint, n1 bigint")
    word = found.groupBy("word").agg(*toxicity._word_sums((rate, 1.0))).first()
    pairs = found.agg(*toxicity._pair_levels((rate, 1.0))).first()
    there = [1 - (1 - rate) ** v for v in n]
    chance = {k: sum(np.prod([p if i in c else 1 - p for i, p in enumerate(there)]) for c in itertools.combinations(range(3), k))
              for k in range(4)}
    assert np.allclose([word["s0"], word["s"], word["s0_k"], word["s0_1"], word["s0_2"]], [sum(there)] * 2 + [1 - chance[0], chance[1], chance[2]])
    binomial = lambda v, k: math.comb(v, k) * rate ** k * (1 - rate) ** (v - k) if v >= k else 0
    assert np.allclose([pairs["n0_1"], pairs["n0_2"], pairs["n_1"]], [sum(binomial(v, 1) for v in n), sum(binomial(v, 2) for v in n)] +
                       [sum(binomial(v, 1) for v in n)])
    assert pairs["n1_1"] == 0 == word["s1_k"]


def test_findings_are_put_between_words_of_all_texts(spark, monkeypatch):
    """Each distinct word of the table is drawn by the same number wherever it lies; a sample has few of them."""
    monkeypatch.setattr(secrets, "SAMPLE_TEXTS", 2)
    rows = [(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26)} AKIAABCD 12 été", "en") for i in range(200)] + [(900, None, "en")]
    table = spark.createDataFrame([(i, (t or "").replace("word", "zz") if t else None, lang) for i, t, lang in rows], SCHEMA)
    stored = secrets.corpus_words(table)
    everything = {w for _, t, _ in rows if t for w in t.replace("word", "zz").split() if secrets.ordinary(w)}
    assert sorted(r["word"] for r in stored.collect()) == sorted(everything) and "AKIAABCD" not in everything and "été" in everything
    sizes = sorted((r[0], r[1]) for r in stored.groupBy("bucket").count().collect())
    starts = dict(zip((b for b, _ in sizes), np.cumsum([0, *[n for _, n in sizes]]).tolist()))
    assert set(secrets._fetched(stored, starts, set(range(len(everything)))).values()) == everything
    seen = []
    monkeypatch.setattr(secrets, "training_table", lambda reader, found: seen.extend(found) or (np.zeros((2, 1)), np.array([0.0, 1.0])))
    monkeypatch.setattr(secrets, "train_forest", lambda x, y: None)
    secrets.fit(table, PIECES, whole=True)
    used = {w for text, _, _ in seen for w in text.split()} & everything
    assert len(used) > 150


class PlainModel:
    def __init__(self, pairs, docs):
        self.pairs, self.docs = pairs, docs
        self.known = {p for p, _ in pairs}
        self.kinds = {y: [p for p in self.known if pairs[p, y]] for y in (0, 1)}
        self.discount = [self._discount([pairs[p, y] for p in self.known]) for y in (0, 1)]
        self.both = self._discount([pairs[p, 0] + pairs[p, 1] for p in self.known])
        vocabulary = {w for _, w in self.known}
        self.seen = [Counter(w for _, w in self.kinds[y]) for y in (0, 1)]
        self.shared = Counter(w for _, w in self.known)
        self.words = [self._discount([self.seen[y][w] for w in vocabulary]) for y in (0, 1)]
        taken = sum(self.words[y] * len(self.seen[y]) for y in (0, 1))
        self.backoff = taken / (len(self.kinds[0]) + len(self.kinds[1]))

    @staticmethod
    def _discount(counts):
        n1, n2 = counts.count(1), counts.count(2)
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    @staticmethod
    def _own(n0, n1):
        n = n0 + n1
        z = ((n1 - n0) ** 2 / max(n + (toxicity.SPREAD * n / 2) ** 2, 1)) ** 2
        return z / (z + toxicity.EVIDENCE)

    def word(self, w):
        total = len(self.known)
        if w not in self.shared:
            return [self.backoff / total] * 2
        out = []
        own = self._own(self.docs[w, 0], self.docs[w, 1])
        for y in (0, 1):
            p = max(self.seen[y][w] - self.words[y], 0) / len(self.kinds[y]) + self.backoff * self.shared[w] / total
            out.append(own * p + (1 - own) * self.shared[w] / total)
        return out

    def ratio(self, left, w):
        p = self.word(w)
        if (left, w) in self.known:
            total = [sum(n for (p_, y_), n in self.pairs.items() if p_[0] == left and y_ == y) for y in (0, 1)]
            kinds = [sum(1 for x in self.kinds[y] if x[0] == left) for y in (0, 1)]
            count = [self.pairs[(left, w), y] for y in (0, 1)]
            every = sum(1 for x in self.known if x[0] == left)
            own = self._own(*count)
            out = []
            for y in (0, 1):
                q = (max(sum(count) - self.both, 0) + self.both * every * p[y]) / sum(total)
                mine = max(count[y] - self.discount[y], 0) / max(total[y], 1)
                mine += (self.discount[y] * kinds[y] / total[y] if total[y] else 1) * q
                out.append(own * mine + (1 - own) * q)
            p = out
        return np.log(p[1] / p[0])


# --- Language ---------------------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = [b" ", b"a", b"b", b"ab", b" a", b"ba", b"abb", b" ab"]
    probability = np.append(rng.random((len(pieces), 2)), np.zeros((1, 2)), axis=0)
    by_piece = {p: probability[i] for i, p in enumerate(pieces)}
    words = [b"a", b"abba", b"bab", b"ababbaab" * 9]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    lattice = language.Lattice(Table(language._hashes(pieces)), data, ends - np.diff(np.append(0, ends)), ends)
    found = language.log_likelihoods(lattice, probability)[np.argsort(lattice.order)]
    for w, row in zip(words, found):
        sums = [np.ones(2)]
        for t in range(1, len(w) + 2):
            span = (b" " + w)[:t]
            sums.append(sum((sums[t - n] * by_piece.get(span[t - n:], 0) for n in range(1, t + 1)), np.zeros(2)))
        assert np.allclose(row, np.log(sums[-1]))
    # by listing the segmentations of a short word
    total = sum(np.prod([by_piece.get(p, np.zeros(2)) for p in parts], axis=0)
                for cuts in itertools.product([0, 1], repeat=4)
                for parts in [[x for x in _split(b" abba", cuts)]])
    assert np.allclose(found[1], np.log(total))


def test_long_words_have_the_same_sum():
    rng = np.random.default_rng(2)
    pieces = language.vocabulary(PIECES)
    probability = rng.random((len(pieces) + 1, 3)) ** 4
    probability[-1] = 0
    probability /= probability.sum(0)
    table = Table(language._hashes(pieces))
    for size in (1, 11, language.STRIDE - 1, language.STRIDE, language.STRIDE + 1, 3000):
        word = np.frombuffer("".join(rng.choice(list("etaoinshrüñ中"), size)).encode(), np.uint8)
        plain = language.log_likelihoods(language.Lattice(table, word, np.array([0]), np.array([len(word)])), probability)
        assert np.allclose(language.long_log_likelihood(table, word, probability), plain[0], rtol=1e-10)


def test_a_megabyte_without_a_space_is_scored_whole():
    pieces = language.vocabulary(PIECES)
    probability = np.full((len(pieces) + 1, 2), 1 / len(pieces))
    probability[-1] = 0
    probability[:, 1] *= 0.9
    classifier = language.Classifier(language.Model(["a", "b"], language._hashes(pieces), probability))
    data = np.frombuffer(("中文字符测试" * 60_000 + " word").encode(), np.uint8)
    first, second = classifier.likelihoods(data, np.array([0, len(data)]))[0]
    assert np.isfinite(first) and first > second


def _split(text, cuts):
    at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
    return [text[a:b] for a, b in zip(at[:-1], at[1:])]


def test_languages_of_held_out_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    table = table.union(spark.createDataFrame(ODD, SCHEMA)).selectExpr("*", "'x' as lang_pred", "7 as score")
    model = language.fit(table, PIECES)
    rows = language.identify(table, model).selectExpr("*", "crc32(cast(doc_id as string)) % 3 = 1 as held").collect()
    held = [r for r in rows if r["held"] and r["doc_id"] < 900_000]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if (r["doc_id"] or 900_000) >= 900_000}
    assert all(odd[i] == ("und", 0.0) for i in (None, 900_001, 900_002, 900_003, 900_004))
    assert odd[900_005][0] in model.languages and 0 <= odd[900_005][1] <= 1
    nothing = language.fit(table.limit(0), PIECES)
    assert {r["lang_pred"] for r in language.identify(table.limit(40), nothing).collect()} == {"und"}


# --- Personal data ----------------------------------------------------------------------------------------

_CHECKS = {"ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
           "card": lambda m: 16 <= len(d := re.sub("[ -]", "", m)) <= 19 and personal_data.luhn(d),
           "phone": lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15, "email": lambda m: True}
_PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain(text):
    return [(i, m.start(), m.end()) for i, k in enumerate(personal_data.KINDS)
            for m in re.finditer(_PATTERNS[k], text) if _CHECKS[k](m.group())]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "B.", "@", "@@", ".", "1", "255", "256", "0001", "4111111111111111", "5500 0000 0000 0004 ",
                                 "-", "+", "+1 (555) 123-4567", " ", "é", "x@y.z", "1.2.3.4", "\n", "("]), max_size=14))
def test_base_spans_are_those_of_the_patterns(bits):
    text = "".join(bits)
    assert personal_data.base_spans(text)[0] == _plain(text)


def test_gradients_are_the_slopes():
    net, rng = personal_data.new_network(), np.random.default_rng(0)
    classes, tags = rng.integers(0, 42, (7, 3)), rng.integers(0, 6, (7, 3))
    _, grads = personal_data.gradients(net, classes, tags)
    for a, g in zip(net.arrays(), grads):
        at = tuple(rng.integers(0, n) for n in a.shape)
        losses = []
        for step in (1e-5, -2e-5):
            a[at] += step
            losses.append(personal_data.gradients(net, classes, tags)[0])
        a[at] += 1e-5
        assert abs((losses[0] - losses[1]) / 2e-5 - g[at]) < 1e-5


def test_decoded_tags_are_the_best_ones():
    net, rng = personal_data.new_network(), np.random.default_rng(1)
    net.transition += rng.standard_normal(net.transition.shape)
    tagger = personal_data.Tagger(net)
    classes = rng.integers(0, 42, (5, 4))
    found = tagger.tags(classes, np.full(4, 5))
    states = np.empty((5, 2 * personal_data.HIDDEN, 4), np.float32)
    for d in range(2):
        personal_data._lstm_states(tagger.tables[d], tagger.recurrent[d], classes,
                                   states[:, d * personal_data.HIDDEN:(d + 1) * personal_data.HIDDEN], bool(d))
    scores = np.matmul(tagger.out, states) + tagger.out_bias
    trained = np.concatenate([personal_data._lstm_train(net, d, net.embed[classes].transpose(0, 2, 1))[0] for d in range(2)], 1)
    assert np.allclose(states, trained, atol=1e-5)
    for b in range(4):
        best = max(itertools.product(range(6), repeat=5), key=lambda y: sum(scores[t, y[t], b] for t in range(5))
                   + sum(net.transition[y[t - 1], y[t]] for t in range(1, 5)))
        assert found[:, b].tolist() == list(best)


def test_personal_data_rows_and_accuracy(spark):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(140)
             .select("text").collect()]
    net = personal_data.train(personal_data.labelled_texts(texts[:110]), steps=350)
    tagger = personal_data.Tagger(net)
    hit = wrong = missed = 0
    for raw, tags in personal_data.labelled_texts(texts[110:], seed=77):
        found = tagger.text_tags(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        hit += int(((found == tags) & (tags > 0)).sum())
        wrong += int(((found != tags) & (found > 0)).sum())
        missed += int(((found != tags) & (tags > 0)).sum())
    assert hit / (hit + wrong) > 0.9 and hit / (hit + missed) > 0.9
    mine = [(1, "write to a.b@c.example.com or +1 (555) 123-4567 é 10.0.0.1", "en"),
            (2, "call (555) 123-4567 today, or 123-45-6789 " + "word " * 3000 + "x@y.example.org", "en")]
    table = spark.createDataFrame(mine + ODD, SCHEMA).selectExpr("*", "1 as spans", "2 as n_ip")
    rows = {r["doc_id"]: r for r in personal_data.find(table, net).collect()}
    for i, text, _ in mine + ODD:
        base = [f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in _plain(text or "")]
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(rows[i]["spans"].split(",")) or not base
        assert [rows[i][f"n_{k}"] for k in personal_data.KINDS] == [sum(x.startswith(k) for x in base) for k in personal_data.KINDS]
    assert rows[2]["n_other"] >= 1 and rows[900_005]["spans"] == ""
    assert personal_data.find(table.limit(0), net).count() == 0


def test_every_trained_kind_comes_out_of_find(spark):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(110)
             .select("text").collect()]
    net = personal_data.train(personal_data.labelled_texts(texts), steps=350)
    rnd = random.Random(31)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    letters = lambda a, n: "".join(rnd.choice(a) for _ in range(n))
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kinds = {
        "local": lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
        "number": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "account": lambda: f"{letters(upper, 2)}{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(2)}",
        "address": lambda: f"{letters(lower, 5)} at {letters(lower, 6)} dot {rnd.choice(['com', 'org', 'net'])}",
    }
    rows, places = [], {}
    for kind in kinds:
        for _ in range(60):
            words = rnd.choice(texts).split()[:40]
            left, value = " ".join(words[:20]), kinds[kind]()
            places[len(rows)] = (kind, len(left) + 1, len(left) + 1 + len(value))
            rows.append((len(rows), f"{left} {value} " + " ".join(words[20:]), "en"))
    hit = dict.fromkeys(kinds, 0)
    for row in personal_data.find(spark.createDataFrame(rows, SCHEMA), net).collect():
        kind, start, end = places[row["doc_id"]]
        held = set()
        for span in filter(None, row["spans"].split(",")):  # a number that passes as a card is found as a card
            held |= set(range(*map(int, span.split(":")[1:])))
        hit[kind] += len(held & set(range(start, end))) > 0.7 * (end - start)
    assert all(n > 0.8 * 60 for n in hit.values()), hit


def test_failed_matches_block_tags_of_their_own_kind_alone():
    text = "DE12 3456 7890 1234 56"
    for tag, expected in ((5, [(4, 0, len(text))]), (3, [])):
        spans, base = personal_data.all_spans(text, np.full(len(text), tag, np.uint8), np.arange(len(text) + 1))
        assert (spans, base) == (expected, 0)


# --- Secrets ----------------------------------------------------------------------------------------------

def test_forest_on_findings_it_has_not_seen():
    reader = secrets.Reader(secrets.dictionary(PIECES))
    forest = secrets.train_forest(*secrets.training_table(reader, secrets.labelled_findings(["alpha", "beta", "gamma"], 120)))
    x, y = secrets.training_table(reader, secrets.labelled_findings(["autre", "mot", "wort"], 40, seed=91))
    assert ((forest.scores(x) >= 0.5) == y).mean() > 0.97


def _flagged(reader, forest, text):
    data = np.frombuffer(text.encode(), np.uint8)
    bounds = np.array([0, len(data)])
    starts, ends, owner = reader.candidates(data, bounds)
    scores = forest.scores(reader.features(data, bounds, starts, ends, owner))
    return [data[a:b].tobytes().decode() for a, b, p in zip(starts.tolist(), ends.tolist(), scores) if p >= 0.5]


def test_formats_beside_those_of_the_training():
    """Only mail keys, registry tokens and trace numbers have no kind like them among the labelled findings."""
    known = secrets.dictionary(PIECES)
    reader = secrets.Reader(known)
    findings = secrets.labelled_findings(["alpha", "beta", "gamma"], known=tuple(w.decode() for w in known))
    forest = secrets.train_forest(*secrets.training_table(reader, findings))
    rnd = random.Random(8)
    hexes, alnum = "0123456789abcdef", "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"

    def some(alphabet, n):
        return "".join(rnd.choices(alphabet, k=n))

    secret = {"smtp": lambda: f"smtp://mailer:{some(alnum, 10)}@mail.host/", "people": lambda: f"ldap://cn:Summer{some('0123456789', 4)}!@dir",
              "variable": lambda: f"DATADOG={some(hexes, 32)}", "registry": lambda: f"_authToken=npm_{some(alnum, 36)}",
              "mail": lambda: f"SG.{some(alnum, 22)}.{some(alnum, 43)}"}
    plain = {"protocol": lambda: "Auth: " + rnd.choice(["OAuth2", "Kerberos5", "SAML2", "Basic", "NTLMv2", "X509"]),
             "algorithm": lambda: "The key: " + rnd.choice(["RSA2048", "AES256", "ED25519", "HMAC-SHA256"]),
             "checksum": lambda: f"checksum={some(hexes, 64)}", "image": lambda: f"image@sha256:{some(hexes, 64)}",
             "trace": lambda: f"trace_id={some(hexes, 32)}", "port": lambda: "http://localhost:8080/a/user1234name@x",
             "article": lambda: "https://example.org/articles/2024-05-some-title-text-12345"}
    share = {k: sum(bool(_flagged(reader, forest, f"so {make()} there")) for _ in range(50)) / 50
             for k, make in (secret | plain).items()}
    assert all(share[k] >= 0.9 for k in secret) and all(share[k] <= 0.1 for k in plain), share


def test_many_secrets_in_one_text(spark):
    keys = ["AKIA" + "".join(random.Random(i).choices("ABCDEFGHJKLMNPQRSTUVWXYZ234567", k=16)) for i in range(3000)]
    table = spark.createDataFrame([(1, " and ".join(keys), "en"), (2, None, "en"), (3, "", "en")], SCHEMA)
    model = secrets.fit(table, PIECES)
    texts = {r["doc_id"]: r["text"] for r in secrets.redact(table, model).collect()}
    assert texts[1] == " and ".join([secrets.MARK] * 3000) and texts[2] is None and texts[3] == ""
    assert secrets.redact(table.limit(0), model).count() == 0


def test_findings_and_redaction(spark):
    key, token = "AKIA" + "Q7WX2ZP9LM4KJ8RT", "0f3c" * 10
    rows = [(1, f"é the key {key} is here, token = \"{token}\" too", "en"), (2, f"commit {token} fixed it", "en"),
            (3, "plain words and a long-hyphenated-expression", "en")]
    table = spark.createDataFrame(rows + ODD, SCHEMA).selectExpr("*", "1 as start", "2 as _new_text")
    model = secrets.fit(table, PIECES)
    found = [r for r in secrets.find(table, model).collect() if r["is_secret"]]
    assert sorted((r["doc_id"], r["start"], r["value"]) for r in found) == [
        (1, rows[0][1].index(key), key), (1, rows[0][1].index(token), token)]
    clean = secrets.redact(table, model)
    assert clean.columns == table.columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[1] == rows[0][1].replace(key, secrets.MARK).replace(token, secrets.MARK)
    assert all(texts[i] == t for i, t, _ in rows[1:] + ODD)
    assert secrets.find(table.limit(0), model).count() == 0


def test_values_after_names_are_candidates_of_any_length_and_characters(spark):
    values = ["Tr0ub4dor", "correcthorsebattery", "P@ssw0rd!2024"]
    rows = [(1, "é set password=Tr0ub4dor now", "en"), (2, 'the passphrase = "correcthorsebattery" is old', "en"),
            (3, "pwd: P@ssw0rd!2024", "en"), (4, "password: required and token=None, see key: value", "en")]
    table = spark.createDataFrame(rows, SCHEMA)
    model = secrets.fit(table, PIECES)
    found = [(r["doc_id"], r["start"], r["length"], r["value"]) for r in secrets.find(table, model).collect() if r["is_secret"]]
    assert sorted(found) == [(i + 1, rows[i][1].index(v), len(v), v) for i, v in enumerate(values)]
    texts = {r["doc_id"]: r["text"] for r in secrets.redact(table, model).collect()}
    assert texts == {i: t.replace(values[i - 1], secrets.MARK) if i < 4 else t for i, t, _ in rows}


# --- Decontamination --------------------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=30), st.lists(st.integers(0, 6), max_size=40))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert decontaminate.common_subsequence(np.array(a, np.uint64), b) == table[-1][-1]


def test_passages_are_found_and_clean_texts_are_not(spark):
    rnd = random.Random(2)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(3000)]
    zipf = [1 / (k + 3) for k in range(3000)]
    text = lambda n: rnd.choices(vocabulary, zipf, k=n)
    items = [(i, " ".join(text(n := rnd.randrange(16, 60))) + ". " + " ".join(text(6)) + ".") for i in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (None, items[0][1])]
    rows, expected = [], set()
    for i in range(400):
        words = text(rnd.randrange(5, 400))
        if i % 4 == 0:
            item = items[i % 40]
            passage = item[1].split()
            if i % 8 == 0:  # a paraphrase: every sixth word is another
                passage = [w if k % 6 else vocabulary[rnd.randrange(3000)] for k, w in enumerate(passage)]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = passage
            expected.add((i, item[0]))
        rows.append((i, " ".join(words), "en"))
    rows.append((600, items[3][1].upper(), "en"))
    expected.add((600, 3))
    table = spark.createDataFrame(rows + ODD, SCHEMA).selectExpr("*", "1 as item", "'x' as _leaked")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as item")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.decontaminate(table, benchmark).collect()}
    assert {x for x in found if x[1] is not None} == expected
    assert {x[0] for x in found if x[1] is None} == {x[0] for x in expected if x[1] == 0}
    index = decontaminate.build_index(table, benchmark)
    kept = decontaminate.keep_clean(table, index)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(
        i or 0 for i, _, _ in rows + ODD if i not in {x[0] for x in expected})
    assert decontaminate.decontaminate(table.limit(0), benchmark).count() == 0
    assert decontaminate.decontaminate(table.limit(9), benchmark.limit(0)).count() == 0


def test_directions_are_fitted_on_every_text(spark, monkeypatch):
    """More rows than any sample held: the products run over each of them, copies too."""
    rows = spark.range(20_000).selectExpr("id AS doc_id", "concat('same words here number ', id div 2) AS text")
    benchmark = spark.createDataFrame([(1, "an item of some words")], "item_id bigint, text string")
    seen = []
    gram = decontaminate._gram
    monkeypatch.setattr(decontaminate, "_gram", lambda texts, *rest: (seen.append(texts.count()), gram(texts, *rest))[1])
    decontaminate.build_index(rows, benchmark)
    assert seen == [20_001] * 3


def test_gram_equals_the_plain_product(spark):
    rnd = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rnd.integers(0, 50, n)) for n in (3, 24, 25, 70)]
    idf, directions = rnd.random(decontaminate.FEATURES) + 0.5, rnd.standard_normal((decontaminate.FEATURES, 4))
    passages = []
    for text in texts:
        feature = decontaminate.features(decontaminate._words_of(text))
        for at in range(0, len(feature), decontaminate.WINDOW):
            row = np.zeros(decontaminate.FEATURES)
            values = idf[feature[at:at + decontaminate.WINDOW]]
            np.add.at(row, feature[at:at + decontaminate.WINDOW], values / np.sqrt((values ** 2).sum()))
            passages.append(row)
    a = np.array(passages)
    found = decontaminate._gram(spark.createDataFrame([(t,) for t in texts], "text string"), idf, directions)
    np.testing.assert_allclose(found, a.T @ (a @ directions), rtol=1e-4, atol=1e-4)


def test_gram_inside_the_directions_and_over_edges(spark, monkeypatch):
    """Sums in step, by runs and by word equal plain ones at any size of the parts; the inner product needs no second one."""
    rnd = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rnd.zipf(1.3, n) % 200) for n in rnd.integers(0, 200, 60)]
    hashes = [decontaminate._words_of(t) for t in texts]
    word = np.concatenate([decontaminate.features(h) for h in hashes])
    begin, _ = decontaminate.tiles(np.append(0, np.cumsum([len(h) for h in hashes])), decontaminate.WINDOW)
    a = np.zeros((len(begin), decontaminate.FEATURES))
    np.add.at(a, (np.searchsorted(begin, np.arange(len(word)), "right") - 1, word), 1)
    right = rnd.standard_normal((decontaminate.FEATURES, 5))
    column = pa.array([decontaminate.features(h).astype("<u2").tobytes() for h in hashes], pa.binary())
    batches = [pa.RecordBatch.from_arrays([x], ["features"]) for x in (column.slice(0, 7), column.slice(7, 0), column.slice(7))]
    for passages, rows, run in ((1 << 14, 1024, 8), (50, 7, 3), (1, 1, 1)):
        for name, value in (("_PASSAGES", passages), ("_ROWS", rows), ("_RUN", run)):
            monkeypatch.setattr(decontaminate, name, value)
        out, left = np.zeros((decontaminate.FEATURES, 5)), []
        for part, first in decontaminate._passages(batches):
            left.append(decontaminate._row_sums(decontaminate._with_zero_row(right), part, first, decontaminate.WINDOW))
            decontaminate._add_by_word(out, left[-1], part, first)
        np.testing.assert_allclose(np.concatenate(left), a @ right)
        np.testing.assert_allclose(out, a.T @ (a @ right), atol=1e-9)
    table = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(3)
    found, total = decontaminate._frequencies(decontaminate._word_features(table))
    assert total == len(begin) and (found == (a > 0).sum(0)).all()
    idf = rnd.random(decontaminate.FEATURES) + 0.5
    weighted = a * idf
    weighted /= np.sqrt((np.array([(idf[word[x:y]] ** 2).sum() for x, y in zip(begin, np.append(begin[1:], len(word)))])))[:, None]
    inner = decontaminate._gram(table, idf, right, True)
    np.testing.assert_allclose(inner, (weighted @ right).T @ (weighted @ right), rtol=1e-4, atol=1e-3)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=8), st.integers(0, 2**32))
def test_window_sums_equal_plain_ones(lengths, seed):
    rnd = np.random.default_rng(seed)
    firsts = np.append(0, np.cumsum(np.array(lengths, np.int64)))
    word = rnd.integers(0, 9, firsts[-1])
    table = decontaminate._with_zero_row(rnd.integers(0, 5, (9, 3)).astype(np.uint8))
    expected = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        starts = [s for s in range(a, b, decontaminate.STRIDE)
                  if s == a or -(-(b - s) // decontaminate.STRIDE) >= decontaminate.WINDOW // decontaminate.STRIDE]
        expected += [(s, min(s + decontaminate.WINDOW, b)) for s in starts]
    windows = decontaminate.Windows(firsts)
    assert list(zip(windows.begin.tolist(), windows.end.tolist())) == expected
    for step in (1, 3, 512):
        sums = [windows.sums(table, word, at, min(at + step, len(expected))) for at in range(0, len(expected), step)]
        assert [x.tolist() for s in sums for x in s] == [table[word[a:b]].sum(0).tolist() for a, b in expected]


def test_a_short_common_subsequence_may_be_given_as_a_bound():
    item, places = np.array([1, 2, 3, 2], np.uint64), decontaminate._places(np.array([1, 2, 3, 2], np.uint64))
    assert decontaminate.common_subsequence(item, [3, 9, 1], places, 3) == 2  # two words of three: not compared
    assert decontaminate.common_subsequence(item, [3, 9, 1], places, 2) == 1
