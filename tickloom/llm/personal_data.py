"""Personal data by patterns and a character-level bidirectional LSTM with a CRF.

Patterns give the base spans (addresses, numbers) with their checks. A network reads the bytes of a text in
windows of ``WINDOW`` that overlap by ``OVERLAP``: two LSTMs of ``HIDDEN`` cells, one from each end, score a tag
for every byte, and CRF transitions decide the best sequence of tags in the window. Windows of a text are
reconciled where they overlap: each half of the overlap is decided by the window that sees further beyond it.
Runs of a tag become spans of kind ``other`` wherever they touch neither a base span nor a match of their own
kind that failed its check (a run tagged as a card on a number that is none): personal data that the patterns
don't describe. Base spans always stay.

The gates use piecewise linear curves, in training and in use. The network is trained here, in numpy, from
labelled spans: personal data of known formats put between words of a bounded sample of the texts
(``SAMPLE_TEXTS``, by a hash of the id), with the tags of what was put there. All texts are searched whole.

Defined results: NULL is the empty text; empty texts have no span; repeated rows agree; very long texts take
as many windows as they need, ``BATCH`` at a time.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mapping import sample_rows, with_text_columns

KINDS = ("email", "ip", "card", "phone")
TAGS = ("none", *KINDS, "other")
HIDDEN, EMBEDDED, WINDOW, OVERLAP, BATCH = 8, 10, 512, 64, 2048
SAMPLE_TEXTS, STEPS, TRAIN_LENGTH, TRAIN_BATCH = 400, 600, 96, 48
#: Shortest added span in bytes, and what every added span must hold: a digit, or an address in words.
SHORTEST = 7
_HOLDS = re.compile(r"[0-9]|\sat\s.*\sdot\s", re.DOTALL)

_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) by kind and start, in code points, and the same of matches that failed a check."""
    found, failed = [], []
    at = text.find("@")
    free = 0  # where the last address ended
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        domain = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((0, start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append((1, m.start(), m.end()))
        else:
            failed.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
            else:
                failed.append((2, m.start(), m.end()))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((3, m.start(), m.end()))
        elif m:
            failed.append((3, m.start(), m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return found, failed


def _classes() -> np.ndarray:
    """Class of each byte: letters without case but with a class for capitals, digits, single signs, the rest."""
    out = np.zeros(256, np.int64)
    out[97:123] = np.arange(1, 27)
    out[65:91] = 27
    out[48:58] = 28
    for i, sign in enumerate(b"@.+-_()/:, "):
        out[sign] = 29 + i
    out[[10, 13, 9]] = 40
    out[128:] = 41
    return out


CLASS = _classes()
_CLASSES = 42


@dataclass
class Network:
    """Parameters; ``forward`` and ``backward`` are (input, recurrent, bias) for gates i, f, o, g."""

    embed: np.ndarray
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    transition: np.ndarray  # from, to

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, *self.inputs, *self.recurrent, *self.bias, self.out, self.out_bias, self.transition]


def new_network(seed: int = 1) -> Network:
    rng = np.random.default_rng(seed)
    n = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float64)
    bias = np.zeros((4 * HIDDEN, 1))
    bias[HIDDEN:2 * HIDDEN] = 1.0  # remember at first
    return Network(n(_CLASSES, EMBEDDED), [n(4 * HIDDEN, EMBEDDED) for _ in range(2)],
                   [n(4 * HIDDEN, HIDDEN) for _ in range(2)], [bias.copy(), bias.copy()],
                   n(len(TAGS), 2 * HIDDEN), np.zeros((len(TAGS), 1)), np.zeros((len(TAGS), len(TAGS))))


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


def _lstm_states(table: np.ndarray, recurrent: np.ndarray, classes: np.ndarray, out: np.ndarray, reverse: bool) -> None:
    """Hidden states of a batch. ``table``: gate inputs by class (4H x classes); ``classes``: steps x batch;
    ``out``: steps x H x batch. Nothing is kept beyond the states."""
    steps, batch = classes.shape
    h = np.zeros((HIDDEN, batch), table.dtype)
    c = np.zeros_like(h)
    z, x = np.empty((2, 4 * HIDDEN, batch), table.dtype)
    for t in (range(steps - 1, -1, -1) if reverse else range(steps)):
        np.matmul(recurrent, h, out=z)
        z += np.take(table, classes[t], axis=1, out=x, mode="clip")
        gates = z[:3 * HIDDEN]
        np.clip(gates, 0, 1, out=gates)  # the table and the recurrent weights hold the slope and the middle
        g = z[3 * HIDDEN:]
        np.clip(g, -1, 1, out=g)
        c *= z[HIDDEN:2 * HIDDEN]
        g *= z[:HIDDEN]
        c += g
        np.clip(c, -1, 1, out=h)
        h *= z[2 * HIDDEN:3 * HIDDEN]
        out[t] = h


class Tagger:
    """The network folded for use: single precision, one table of gate inputs for each direction."""

    def __init__(self, net: Network):
        scale = np.ones((4 * HIDDEN, 1))
        scale[:3 * HIDDEN] = 0.25
        middle = np.zeros((4 * HIDDEN, 1))
        middle[:3 * HIDDEN] = 0.5
        self.tables = [np.ascontiguousarray((scale * (w @ net.embed.T + b) + middle), np.float32)
                       for w, b in zip(net.inputs, net.bias)]
        self.recurrent = [np.ascontiguousarray(scale * u, np.float32) for u in net.recurrent]
        self.out, self.out_bias = net.out.astype(np.float32), net.out_bias.astype(np.float32)
        self.transition = net.transition.astype(np.float32)

    def tags(self, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tags (steps x batch) of a batch of windows; beyond a window's length the tags mean nothing."""
        steps, batch = classes.shape
        k = len(TAGS)
        states = np.empty((steps, 2 * HIDDEN, batch), np.float32)
        _lstm_states(self.tables[0], self.recurrent[0], classes, states[:, :HIDDEN], False)
        _lstm_states(self.tables[1], self.recurrent[1], classes, states[:, HIDDEN:], True)
        scores = np.matmul(self.out, states) + self.out_bias
        past_end = np.arange(steps)[:, None] >= lengths[None, :]
        # Beyond the end of a window nothing is scored and "none" may follow anything.
        scores.transpose(1, 0, 2)[:, past_end] = 0
        # scores[t] becomes the score of the best way to each tag at t.
        way, more = np.empty((2, k, batch), np.float32)
        for t in range(1, steps):
            np.add(scores[t - 1][0], self.transition[0][:, None], out=way)
            for j in range(1, k):
                np.maximum(way, np.add(scores[t - 1][j], self.transition[j][:, None], out=more), out=way)
            scores[t] += way
        out = np.empty((steps, batch), np.uint8)
        out[-1] = scores[-1].argmax(0)
        into = np.ascontiguousarray(self.transition.T)
        for t in range(steps - 1, 0, -1):
            step = into[out[t]]
            top, arg = scores[t - 1][0] + step[:, 0], out[t - 1]
            arg[:] = 0
            for j in range(1, k):
                other = scores[t - 1][j] + step[:, j]
                np.putmask(arg, other > top, j)
                np.maximum(top, other, out=top)
        return out

    def text_tags(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """A tag for every byte, from overlapping windows of each text."""
        sizes = np.diff(bounds)
        step = WINDOW - OVERLAP
        count = np.where(sizes > WINDOW, -(-(sizes - OVERLAP) // step), (sizes > 0).astype(np.int64))
        text = np.repeat(np.arange(len(sizes)), count)
        number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        start = bounds[text] + number * step
        end = np.minimum(start + WINDOW, bounds[text + 1])
        # Each window decides from the middle of the overlap before it to the middle of the one after.
        first = np.where(number > 0, start + OVERLAP // 2, start)
        last = np.where(number < count[text] - 1, end - OVERLAP // 2, end)
        classes, out = CLASS[data], np.zeros(len(data), np.uint8)
        order = np.argsort(-(end - start), kind="stable")  # windows of like length together
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            lengths = end[rows] - start[rows]
            width = int(lengths.max())
            place = np.minimum(start[rows][None, :] + np.arange(width)[:, None], len(data) - 1)
            own = np.where(np.arange(width)[:, None] < lengths[None, :], classes[place], 40)  # a line end as padding
            found = self.tags(own, lengths)
            inside = (place >= first[rows]) & (place < last[rows]) & (np.arange(width)[:, None] < lengths[None, :])
            out[place[inside]] = found[inside]
        return out


# --- Training ---------------------------------------------------------------------------------------------

def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores: np.ndarray, transition: np.ndarray, tags: np.ndarray):
    """Mean negative log-likelihood of ``tags`` (steps x batch), and its gradients; scores: steps x K x batch."""
    steps, k, batch = scores.shape
    forward, backward = np.empty_like(scores), np.zeros_like(scores)
    forward[0] = scores[0]
    for t in range(1, steps):
        forward[t] = _log_sum(forward[t - 1][:, None] + transition[:, :, None], 0) + scores[t]
    for t in range(steps - 2, -1, -1):
        backward[t] = _log_sum(transition[:, :, None] + (scores[t + 1] + backward[t + 1])[None], 1)
    total = _log_sum(forward[-1], 0)
    d_scores = np.exp(forward + backward - total)
    pair = np.zeros_like(transition)
    for t in range(1, steps):
        pair += np.exp(forward[t - 1][:, None] + transition[:, :, None] + (scores[t] + backward[t])[None] - total).sum(2)
    column = np.arange(batch)
    gold = sum(scores[t, tags[t], column] for t in range(steps))
    for t in range(steps):
        d_scores[t, tags[t], column] -= 1
    for t in range(1, steps):
        gold = gold + transition[tags[t - 1], tags[t]]
        np.add.at(pair, (tags[t - 1], tags[t]), -1)
    return float((total - gold).mean()), d_scores / batch, pair / batch


def _lstm_train(net: Network, d: int, x: np.ndarray):
    """States of direction ``d`` over embedded input (steps x E x batch) and what its gradient needs."""
    steps, _, batch = x.shape
    h, c = np.zeros((HIDDEN, batch)), np.zeros((HIDDEN, batch))
    kept = []
    out = np.empty((steps, HIDDEN, batch))
    for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
        z = net.inputs[d] @ x[t] + net.recurrent[d] @ h + net.bias[d]
        i, f, o = (_gate(z[j * HIDDEN:(j + 1) * HIDDEN]) for j in range(3))
        g = np.clip(z[3 * HIDDEN:], -1, 1)
        new = f * c + i * g
        kept.append((t, z, h, c, i, f, o, g, new))
        c = new
        h = o * np.clip(c, -1, 1)
        out[t] = h
    return out, kept


def _lstm_gradient(net: Network, d: int, x: np.ndarray, kept, d_out: np.ndarray):
    d_in, d_rec, d_bias = np.zeros_like(net.inputs[d]), np.zeros_like(net.recurrent[d]), np.zeros_like(net.bias[d])
    d_x = np.zeros_like(x)
    d_h, d_c = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
    for t, z, h, c, i, f, o, g, new in reversed(kept):
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (np.abs(new) < 1)
        d_z = np.concatenate([d_c * g, d_c * c, d_h * np.clip(new, -1, 1), d_c * i])
        d_z[:3 * HIDDEN] *= 0.25 * (np.abs(z[:3 * HIDDEN]) < 2)
        d_z[3 * HIDDEN:] *= np.abs(z[3 * HIDDEN:]) < 1
        d_in += d_z @ x[t].T
        d_rec += d_z @ h.T
        d_bias += d_z.sum(1, keepdims=True)
        d_x[t] = net.inputs[d].T @ d_z
        d_h, d_c = net.recurrent[d].T @ d_z, d_c * f
    return d_in, d_rec, d_bias, d_x


def gradients(net: Network, classes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients in the order of ``Network.arrays``; classes and tags: steps x batch."""
    x = net.embed[classes].transpose(0, 2, 1)
    runs = [_lstm_train(net, d, x) for d in range(2)]
    states = np.concatenate([runs[0][0], runs[1][0]], 1)
    loss, d_scores, d_transition = crf_gradient(net.out @ states + net.out_bias, net.transition, tags)
    d_states = net.out.T @ d_scores
    d_out = np.einsum("tkb,thb->kh", d_scores, states)
    parts = [_lstm_gradient(net, d, x, runs[d][1], d_states[:, d * HIDDEN:(d + 1) * HIDDEN]) for d in range(2)]
    d_x = parts[0][3] + parts[1][3]
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, classes.reshape(-1), d_x.transpose(0, 2, 1).reshape(-1, EMBEDDED))
    return loss, [d_embed, *(p[0] for p in parts), *(p[1] for p in parts), *(p[2] for p in parts), d_out,
                  d_scores.sum((0, 2))[:, None], d_transition]


def train(texts: list[tuple[bytes, np.ndarray]], steps: int = STEPS, seed: int = 2) -> Network:
    """Adam over random windows of labelled texts (bytes and a tag for each)."""
    rng = np.random.default_rng(seed)
    data = np.concatenate([np.frombuffer(t, np.uint8) for t, _ in texts])
    tags = np.concatenate([y for _, y in texts]).astype(np.int64)
    classes = CLASS[data]
    net = new_network()
    first = [np.zeros_like(a) for a in net.arrays()]
    second = [np.zeros_like(a) for a in net.arrays()]
    for step in range(1, steps + 1):
        at = rng.integers(0, max(1, len(data) - TRAIN_LENGTH), TRAIN_BATCH)
        rows = np.minimum(at[None, :] + np.arange(TRAIN_LENGTH)[:, None], len(data) - 1)
        _, grads = gradients(net, classes[rows], tags[rows])
        norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for a, g, m, v in zip(net.arrays(), grads, first, second):
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            a -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def labelled_texts(texts: list[str], seed: int = 4, every: int = 9) -> list[tuple[bytes, np.ndarray]]:
    """Sample texts with personal data of known formats put in about every ``every`` words, and a tag for each byte."""
    rng = np.random.default_rng(seed)
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def some(alphabet: str, least: int, most: int | None = None) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), int(rng.integers(least, (most or least) + 1))))

    def pick(*options):
        return options[int(rng.integers(len(options)))]

    def card() -> str:
        body = some(digits, 15)
        full = next(body + d for d in digits if luhn(body + d))
        sign = pick("", " ", "-")
        return sign.join(full[i:i + 4] for i in range(0, 16, 4))

    def host() -> str:
        return f"{some(lower, 3, 9)}{some(digits, 0, 1)}.{pick('example.com', 'example.org', 'net', 'co.uk', 'de')}"

    made = [
        (1, lambda: f"{some(lower, 2, 9)}{pick('', '.', '_')}{some(lower + digits, 1, 6)}@{host()}"),
        (2, lambda: ".".join(str(int(rng.integers(0, 256))) for _ in range(4))),
        (3, card),
        (4, lambda: f"+{some(digits, 1, 2)} ({some(digits, 3)}) {some(digits, 3)}-{some(digits, 4)}"),
        (4, lambda: f"+{some(digits, 2)}{pick(' ', '-', '')}{some(digits, 3)}{pick(' ', '-', '')}{some(digits, 6)}"),
        (5, lambda: f"({some(digits, 3)}) {some(digits, 3)}-{some(digits, 4)}"),
        (5, lambda: f"{some(digits, 3)}-{some(digits, 2)}-{some(digits, 4)}"),
        (5, lambda: f"{some(upper, 2)}{some(digits, 2)} {some(digits, 4)} {some(digits, 4)} {some(digits, 4)} {some(digits, 2)}"),
        (5, lambda: f"{some(lower, 3, 8)} at {some(lower, 3, 8)} dot {pick('com', 'org', 'net')}"),
        (0, lambda: some(digits, 1, 7)), (0, lambda: f"{some(digits, 4)}-{some(digits, 2)}-{some(digits, 2)}"),
        (0, lambda: f"{some(digits, 1, 3)}.{some(digits, 1, 3)}"), (0, lambda: some("0123456789abcdef", 16, 40)),
        (0, lambda: f"{some(upper, 4)}{some(upper + digits, 16)}"),
        (0, lambda: f"{some(lower, 3, 7)}={some('0123456789abcdef', 12, 20)}"), (0, lambda: some(lower, 3, 8) + pick("###", "***", "!!", "%%%")),
    ]
    out = []
    for text in texts:
        raw, tags = [], []
        for word in re.findall(r"\S+|\s+", text):
            raw.append(word.encode())
            tags.append(np.zeros(len(raw[-1]), np.uint8))
            if word.isspace() and rng.random() < 1 / every:
                tag, make = made[int(rng.integers(len(made)))]
                value = make().encode()
                end = pick(b"", b"", b".", b",")
                raw.append(value + end + b" ")
                tags.append(np.concatenate([np.full(len(value), tag, np.uint8), np.zeros(len(end) + 1, np.uint8)]))
        # Line ends stand for what is beyond a text, as in a padded window.
        raw.append(b"\n" * int(rng.integers(1, 40)))
        tags.append(np.zeros(len(raw[-1]), np.uint8))
        out.append((b"".join(raw), np.concatenate(tags)))
    return out


def fit(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", steps: int = STEPS) -> Network:
    """Train on ``SAMPLE_TEXTS`` texts, picked by a hash of the id, with labelled spans put between their words."""
    known = documents.select(id_column, text_column).where(F.col(text_column).isNotNull())
    rows = sorted(sample_rows(known, SAMPLE_TEXTS, id_column).select(text_column).collect())
    texts = labelled_texts([r[0] for r in rows]) or labelled_texts(["a text of a few plain words"] * 20)
    return train(texts, steps)


def _places(spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts in order, and how far the spans up to each reach."""
    places = sorted((a, b) for _, a, b in spans)
    return np.array([a for a, _ in places]), np.maximum.accumulate(np.array([b for _, b in places], np.int64))


def all_spans(text: str, tags: np.ndarray, points: np.ndarray) -> tuple[list[tuple[int, int, int]], int]:
    """Base spans, then added ones (kind 4), by kind and start, and the number of base spans.

    ``tags``: a tag for every byte; ``points``: code points before each byte (and after the last).
    """
    base, failed = base_spans(text) if text else ([], [])
    taken = {tag: _places(base + [f for f in failed if f[0] == tag - 1]) for tag in range(1, len(TAGS))}
    cuts = np.concatenate([[0], np.flatnonzero(tags[1:] != tags[:-1]) + 1, [len(tags)]]) if len(tags) else np.zeros(1, int)
    added = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if tags[a] and b - a >= SHORTEST:
            x, y = int(points[a]), int(points[b])
            while x < y and text[x].isspace():
                x += 1
            while y > x and text[y - 1].isspace():
                y -= 1
            starts, ends = taken[int(tags[a])]
            at = int(np.searchsorted(starts, y))  # spans that begin before this one ends
            if y - x >= SHORTEST and not (at and ends[at - 1] > x) and _HOLDS.search(text, x, y):
                added.append((4, x, y))
    return [*base, *added], len(base)


def find(documents: DataFrame, net: Network, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_other`` for every row."""
    shared = documents.sparkSession.sparkContext.broadcast(net)
    names = (*KINDS, "other")

    def make():
        tagger = Tagger(shared.value)

        def columns(data, bounds):
            tags = tagger.text_tags(data, bounds)
            raw = data.tobytes()
            counts, hashes, joined = np.zeros((len(bounds) - 1, 5), np.int64), [], []
            empty = hashlib.sha256(b"").hexdigest()
            plain = ~((data == 64) | (data == 43) | ((data >= 48) & (data <= 57)) | (tags > 0))
            work = np.append(0, np.cumsum(~plain))  # bytes that a span can hold
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if work[b] == work[a]:
                    hashes.append(empty)
                    joined.append("")
                    continue
                points = np.append(0, np.cumsum((data[a:b] & 0xC0) != 0x80))
                # A byte inside a character counts with its first byte.
                before = np.append(points[:-1] - ((data[a:b] & 0xC0) == 0x80), points[-1])
                spans, n = all_spans(raw[a:b].decode(), tags[a:b], before)
                texts = [f"{names[k]}:{x}:{y}" for k, x, y in spans]
                for k, _, _ in spans:
                    counts[i, k] += 1
                hashes.append(hashlib.sha256(",".join(texts[:n]).encode()).hexdigest())
                joined.append(",".join(texts))
            return [*(pa.array(counts[:, k].copy()) for k in range(4)), pa.array(hashes, pa.string()),
                    pa.array(joined, pa.string()), pa.array(counts[:, 4].copy())]

        return columns

    added = ("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, "
             "n_other bigint")
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("_pii_text"))
    return with_text_columns(source, "_pii_text", added, make)
