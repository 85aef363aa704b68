"""Secret scans with a random forest that removes false positives.

Candidates are runs of ``[A-Za-z0-9+/_-]`` of at least ``SHORTEST`` characters that hold a digit, or upper and
lower case, or begin as a published credential does, and, of any length and characters, the value that follows one of ``NAMES`` and ``=`` or ``:`` on its
line (to the closing quote, or else to the next blank) and the password of a login in an address
(``scheme://user:password@host``). Each becomes a row of numbers: length, kinds of characters, transitions between kinds and between
characters (against those of dictionary words), dictionary coverage, signs of a path or address on either
side, whether the words before name something secret or a digest, and whether it is assigned to a variable in
capitals. A forest of decision trees, trained from labelled
findings, says which candidates are secrets.

The labelled findings are made from published formats of credentials and of what is mistaken for them (hashes,
identifiers, paths, addresses, numbers), between words of a bounded sample of the texts (``SAMPLE_TEXTS``) or, with
``whole=True``, of all texts: their distinct words are numbered where they lie, and only the drawn ones are fetched.
Every text of the table is scanned whole.

Defined results: NULL and empty texts have no candidate; repeated rows give their findings again; findings of a
row are in order of place; spans are counted in code points; what lies inside a secret is no finding of its own.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .mapping import Table, sample_rows, tidy, unique_marker, with_text_columns
from .ragged import Hasher, ranges, spans_of, text_slices

#: Shortest candidate; texts whose words surround the labelled findings; findings of each kind.
SHORTEST, SAMPLE_TEXTS, EACH = 12, 400, 260
WORD_BUCKETS = 4096  # pieces of the corpus's vocabulary, each numbered by itself
TREES, DEEPEST, LEAF = 40, 12, 3
#: Replaces a secret in a text.
MARK = "[secret]"

#: Words that announce a secret.
NAMES = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "key", "auth",
         "bearer", "credential", "credentials", "access_key", "private_key", "client_secret")
#: Published beginnings of credentials (fixed values).
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "rk_live_",
            "AIza", "eyJ", "npm_", "SG")

_STARTS = tuple(x.encode() for x in PREFIXES)
_UPPER, _LOWER, _DIGIT, _SIGN, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58] = _UPPER, _LOWER, _DIGIT
_KIND[[43, 45, 47, 95]] = _SIGN  # + - / _
_INSIDE = _KIND != _OTHER
#: Letters without case, digits as one, signs as one.
_SYMBOL = np.full(256, 27, np.int64)
_SYMBOL[65:91], _SYMBOL[97:123], _SYMBOL[48:58] = np.arange(26), np.arange(26), 26
_BEFORE = 40  # bytes before a candidate in which its name is looked for
FEATURES = 26
_ENDINGS = tuple(x.encode() for x in NAMES)
_PASSWORDS = ("password", "passwd", "pwd", "passphrase")
#: Words that announce a digest or an identifier.
_DIGESTS = ("md5", "sha", "sha1", "sha256", "commit", "rev", "revision", "etag", "checksum", "digest", "hash", "build", "version",
            "id", "uuid", "guid")
_VARIABLE = re.compile(rb"""[A-Z][A-Z0-9_]{2,}[ \t]?=[ \t]?["'`]?$""")
_PARTS = re.compile("[^a-z0-9]")
_LOGIN = re.compile(rb"://[^\s/:@?#]*:([^\s/]+)@")
_VALUE = re.compile(rb"""[=>]?[ \t]*(?:"((?:\\.|[^"\\\r\n])+)"|'((?:\\.|[^'\\\r\n])+)'|`([^`\r\n]+)`|["'`]?(\S+))""")


def named_values(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the values that follow one of ``NAMES`` and a sign, of any length and characters."""
    signs = np.flatnonzero((data == 61) | (data == 58))
    owner = np.searchsorted(bounds, signs, "right") - 1
    raw, longest, out = data.tobytes(), max(map(len, _ENDINGS)), []
    for s, low, high in zip(signs.tolist(), bounds[owner].tolist(), bounds[owner + 1].tolist()):
        a = s
        while a > low and raw[a - 1] in b" \t\"'`":
            a -= 1
        if raw[max(low, a - longest):a].lower().endswith(_ENDINGS):
            m = _VALUE.match(raw, s + 1, high)
            if m:
                start, end = m.span(m.lastindex)
                if m.lastindex == 4:
                    end = start + (len(m.group(4).rstrip(b".,;)]}>\"'`")) or end - start)
                out.append((start, end))
    found = np.array(out, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def login_passwords(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the passwords in ``scheme://user:password@host``."""
    signs = np.flatnonzero((data[:-2] == 58) & (data[1:-1] == 47) & (data[2:] == 47))
    owner = np.searchsorted(bounds, signs, "right") - 1
    raw = data.tobytes()
    met = (_LOGIN.match(raw, s, high) for s, high in zip(signs.tolist(), bounds[owner + 1].tolist()))
    found = np.array([m.span(1) for m in met if m], np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def dictionary(path: str, least: int = 4, most: int = 9) -> list[bytes]:
    """Lower-case words of a public piece vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size()))
    return sorted({p.encode() for p in pieces if p.isascii() and p.isalpha() and least <= len(p) <= most})


class Reader:
    """Candidates of texts and their features. ``words``: the dictionary; ``transitions``: log-probabilities."""

    def __init__(self, words: list[bytes]):
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = ends - np.array([len(w) for w in words])
        self.table = Table(Hasher(data).spans(starts, ends))
        self.sizes = sorted({len(w) for w in words})
        counts = np.full((28, 28), 0.5)
        inner = np.ones(len(data), bool)
        inner[ends - 1] = False
        at = np.flatnonzero(inner)
        np.add.at(counts, (_SYMBOL[data[at]], _SYMBOL[data[at + 1]]), 1)
        self.transitions = np.log(counts / counts.sum(1, keepdims=True))

    @staticmethod
    def candidates(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, index of the text)."""
        starts, ends, _ = spans_of(_INSIDE[data], bounds)
        long = ends - starts >= SHORTEST
        starts, ends = starts[long], ends[long]
        kind = _KIND[data]
        has = [np.append(0, np.cumsum(kind == k)) for k in (_UPPER, _LOWER, _DIGIT)]
        upper, lower, digit = ((c[ends] - c[starts]) for c in has)
        # A capital letter at the start alone, or nothing but capitals, is an ordinary word.
        mixed = (upper >= 2) & (lower >= 2)
        keep = (digit > 0) | mixed
        raw = data.tobytes()
        for i in np.flatnonzero(~keep).tolist():
            keep[i] = raw.startswith(_STARTS, int(starts[i]))
        found = [(starts[keep], ends[keep]), named_values(data, bounds), login_passwords(data, bounds)]
        both = np.unique(np.stack([np.concatenate([a for a, _ in found]), -np.concatenate([b for _, b in found])], 1), axis=0)
        starts, ends = both[:, 0], -both[:, 1]  # of those that start together the longest first
        return starts, ends, np.searchsorted(bounds, starts, "right") - 1

    def features(self, data: np.ndarray, bounds: np.ndarray, starts, ends, owner) -> np.ndarray:
        n, size = len(starts), ends - starts
        if not n:
            return np.zeros((0, FEATURES), np.float32)
        at = ranges(starts, size)
        own = np.repeat(np.arange(n), size)
        first = np.cumsum(size) - size
        kind, symbol = _KIND[data[at]], _SYMBOL[data[at]]
        total = lambda x: np.add.reduceat(x.astype(float), first)
        share = [total(kind == k) / size for k in (_UPPER, _LOWER, _DIGIT, _SIGN)]
        same = np.ones(len(at), bool)
        same[first] = False
        change = np.zeros(len(at))
        change[1:] = kind[1:] != kind[:-1]
        step = np.zeros(len(at))
        step[1:] = self.transitions[symbol[:-1], symbol[1:]]
        change, step = change * same, step * same
        low = np.where(kind == _UPPER, data[at] + 32, data[at]).astype(np.uint8)
        hexadecimal = ((low >= 48) & (low <= 57)) | ((low >= 97) & (low <= 102))
        distinct = np.bincount(np.unique(own * 256 + data[at]) // 256, minlength=n)
        counts = np.zeros((n, 28))
        np.add.at(counts, (own, symbol), 1)
        p = counts / size[:, None]
        entropy = -(p * np.log2(np.maximum(p, 1e-12))).sum(1)
        covered = np.zeros(len(at), bool)
        hasher = Hasher(low)
        for length in self.sizes:
            begin = np.arange(max(0, len(at) - length + 1))
            begin = begin[own[begin] == own[begin + length - 1]]
            hit = begin[self.table.rows(hasher.spans(begin, begin + length)) >= 0]
            for k in range(length):
                covered[hit + k] = True
        def neighbour(place, inside):
            return np.where(inside, data[np.clip(place, 0, len(data) - 1)], 32)

        before = neighbour(starts - 1, starts > bounds[owner])
        after = neighbour(ends, ends < bounds[owner + 1])
        slash = total(data[at] == 47)
        dashes = total(data[at] == 45)
        raw = data.tobytes()
        lefts = [raw[max(a, s - _BEFORE):s].decode("utf-8", "replace").lower()
                 for a, s in zip(bounds[owner].tolist(), starts.tolist())]
        named, path, password, digest, variable = (np.zeros(n) for _ in range(5))
        for i, left in enumerate(lefts):
            words = left.rstrip(" \t=:\"'`>").replace("=", " ").replace(":", " ").split()
            last = words[-1].strip("\"'`,;({[<>") if words else ""
            named[i] = 2 if any(last.endswith(x) for x in NAMES) else any(x in left for x in NAMES[:13])
            password[i] = last.endswith(_PASSWORDS)
            digest[i] = _PARTS.split(last)[-1] in _DIGESTS
            variable[i] = bool(_VARIABLE.search(raw, max(int(bounds[owner[i]]), int(starts[i]) - _BEFORE), int(starts[i])))
            path[i] = any(x in left[-12:] for x in ("://", "www.", "/", "\\", "@", "commit", "sha", "md5", "base64,"))
        prefix = np.array([any(raw[a:a + 12].startswith(x.encode()) for x in PREFIXES) for a in starts.tolist()])
        assigned = np.array([left.rstrip(" \"'`")[-1:] in ("=", ":") for left in lefts])
        logins = login_passwords(data, bounds)
        login = np.isin(starts * (len(data) + 1) + ends, logins[0] * (len(data) + 1) + logins[1])
        columns = [size, *share, total(change) / size, total(step) / np.maximum(size - 1, 1),
                   total(covered) / size, total(hexadecimal) / size, distinct / size, entropy,
                   np.isin(before, [47, 46, 64, 92, 35]), np.isin(after, [46, 64, 92, 40]), np.isin(before, [34, 39, 61, 58]),
                   named, path, prefix, assigned, slash, dashes, (total(kind == _DIGIT) == size), password,
                   np.isin(before, [34, 39, 96]), digest, variable, login]
        return np.stack([np.asarray(c, np.float32) for c in columns], 1)


@dataclass
class Forest:
    """Trees as rows of nodes: feature (or -1), threshold, left child, right child, share of secrets."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEEPEST + 1):
                f = self.feature[t, node]
                inner = f >= 0
                go_left = x[np.arange(len(x)), np.maximum(f, 0)] <= self.threshold[t, node]
                node = np.where(inner, np.where(go_left, self.left[t, node], self.right[t, node]), node)
            total += self.share[t, node]
        return total / len(self.feature)


def train_forest(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Forest:
    """Bootstrap samples, a random half of the features at each node, Gini impurity."""
    rng = np.random.default_rng(seed)
    trees = []
    for _ in range(TREES):
        rows = rng.integers(0, len(x), len(x))
        nodes: list[list[float]] = []

        def grow(rows: np.ndarray, depth: int) -> int:
            own = len(nodes)
            share = float(y[rows].mean())
            nodes.append([-1, 0.0, 0, 0, share])
            if depth == DEEPEST or len(rows) < 2 * LEAF or share in (0.0, 1.0):
                return own
            best = (2 * share * (1 - share) - 1e-9, None, None)
            for f in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
                v = x[rows, f]
                order = np.argsort(v, kind="stable")
                v, c = v[order], np.cumsum(y[rows][order])
                cut = np.flatnonzero(v[1:] > v[:-1]) + 1
                cut = cut[(cut >= LEAF) & (cut <= len(v) - LEAF)]
                if len(cut):
                    p, q = c[cut - 1] / cut, (c[-1] - c[cut - 1]) / (len(v) - cut)
                    gini = (cut * 2 * p * (1 - p) + (len(v) - cut) * 2 * q * (1 - q)) / len(v)
                    i = int(gini.argmin())
                    if gini[i] < best[0]:
                        best = (float(gini[i]), int(f), float((v[cut[i] - 1] + v[cut[i]]) / 2))
            if best[1] is None:
                return own
            goes = x[rows, best[1]] <= best[2]
            if goes.all() or not goes.any():
                return own
            nodes[own][:2] = best[1], best[2]
            nodes[own][2] = grow(rows[goes], depth + 1)
            nodes[own][3] = grow(rows[~goes], depth + 1)
            return own

        grow(rows, 0)
        trees.append(np.array(nodes))
    width = max(map(len, trees))
    packed = np.zeros((TREES, width, 5))
    packed[:, :, 0] = -1
    for t, nodes in enumerate(trees):
        packed[t, :len(nodes)] = nodes
    return Forest(packed[:, :, 0].astype(int), packed[:, :, 1], packed[:, :, 2].astype(int),
                  packed[:, :, 3].astype(int), packed[:, :, 4])


def outermost(starts: np.ndarray, ends: np.ndarray, secret: np.ndarray) -> np.ndarray:
    """False for what lies inside a secret that starts no later."""
    reach = np.maximum.accumulate(np.append(-1, np.where(secret, ends, -1)))[:-1]
    return ends > reach


def labelled_findings(words: list[str], each: int = EACH, seed: int = 3, known: tuple[str, ...] = ()) -> list[tuple[str, str, int]]:
    """(text, the finding in it, 1 for a secret): published formats between words of the corpus."""
    rng = np.random.default_rng(seed)
    digits, hexes = "0123456789", "0123456789abcdef"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    alnum = digits + upper + lower

    def some(alphabet: str, least: int, most: int | None = None) -> str:
        return "".join(rng.choice(list(alphabet), int(rng.integers(least, (most or least) + 1))))

    def word() -> str:
        return words[int(rng.integers(len(words)))] if words else "word"

    def name() -> str:
        return str(rng.choice(NAMES)).upper() if rng.random() < 0.2 else str(rng.choice(NAMES))

    def assign(value: str, names: tuple[str, ...] = (), quote: str | None = None) -> str:
        quote = str(rng.choice(["", '"', "'"])) if quote is None else quote
        sign = str(rng.choice(["=", " = ", ": ", ":", " := "]))
        return f"{str(rng.choice(names)) if names else name()}{sign}{quote}{value}{quote}"

    def b64(n: int) -> str:
        return base64.b64encode(rng.bytes(n)).decode().rstrip("=")

    def uuid() -> str:
        return "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12))

    def plain(n: int, sign: str) -> str:
        return sign.join(w for w in (("".join(c for c in word() if c.isascii() and c.isalnum()) or "item") for _ in range(n)))

    common = known or ["correct", "horse", "battery", "staple", "river", "window", "orange", "garden", "silver", "market"]

    def one() -> str:
        return common[int(rng.integers(len(common)))]

    def phrase(sign: str) -> str:
        return sign.join(one() for _ in range(int(rng.integers(3, 6))))

    def chosen() -> str:
        """A word as people change it: letters for digits and signs, a number, a sign."""
        v = (one() + (one() if rng.random() < 0.3 else "")).title()
        for a, b in zip("aeios", str(rng.choice(["@3105", "43!0$", "aeios", "a3i0s"]))):
            v = v.replace(a, b)
        return v + str(rng.choice(["", "!", "#", "_"])) + some(digits, 1, 4) + str(rng.choice(["", "", "!", "$"]))

    def short() -> str:
        return str(rng.choice(["none", "None", "null", "true", "false", "required", "optional", "string", "the", "value", "is", "x",
                               "yes", "no", "your", "an", "int", "str", "changed", "expired", "reset", "********", "xxxxxx", "..."]))

    def unset() -> str:
        v = word()
        return str(rng.choice(["${%s}", "<%s>", "{{%s}}", "$%s", "%s()", "get_%s()", "os.environ['%s']", "config.%s", "[%s]", "your_%s_here"])) % v

    def variable(ends: tuple[str, ...]) -> str:
        base = "".join(c for c in word() if c.isascii() and c.isalpha()).upper() or "SERVICE"
        return base + str(rng.choice(ends)) + str(rng.choice(["=", "=", " = ", '="']))

    def login(value: str) -> str:
        host = str(rng.choice(["db", "localhost", "cache.internal", "10.0.0.7", "example.com"]))
        scheme = str(rng.choice(["postgres", "mysql", "redis", "amqp", "https", "mongodb+srv", "ftp"]))
        return f"{scheme}://{str(rng.choice(['app', 'root', 'admin', '', one()]))}:{value}@{host}/{one()}"

    secret = [
        lambda: (v := chosen(), login(v)), lambda: (v := some(alnum, 8, 32), login(v)), lambda: (v := some(lower, 8, 20), login(v)),
        lambda: (v := some(hexes, 24, 40), login(v)), lambda: (v := phrase(str(rng.choice(["", "-"]))), login(v)),
        lambda: (v := some(hexes, 32, 40), variable(("", "", "_KEY", "_API", "_APP", "_CREDS")) + v),
        lambda: (v := some(alnum, 20, 44), variable(("", "", "_KEY", "_API", "_APP", "_CREDS")) + v),
        lambda: (v := some(hexes, 16, 20), assign(v)), lambda: (v := some(hexes, 32, 64), assign(v)),
        lambda: (v := some(alnum, 14, 40), assign(v)), lambda: (v := b64(int(rng.integers(18, 48))), assign(v)),
        lambda: (v := str(rng.choice(["AKIA", "ASIA"])) + some(upper + digits, 16), v),
        lambda: (v := str(rng.choice(["AKIA", "ASIA"])) + some(upper + digits, 16), assign(v)),
        lambda: (v := str(rng.choice(["ghp_", "gho_", "ghs_"])) + some(alnum, 36), v),
        lambda: (v := "glpat-" + some(alnum + "_-", 20), v), lambda: (v := "AIza" + some(alnum + "_-", 35), v),
        lambda: (v := "xoxb-" + some(digits, 11) + "-" + some(alnum, 24), v),
        lambda: (v := str(rng.choice(["sk_live_", "rk_live_"])) + some(alnum, 24), v),
        lambda: (v := "eyJ" + b64(30), "Bearer " + v),
        lambda: (v := some(alnum, 24), f"https://hooks.example.com/services/T{some(upper + digits, 8)}/B{some(upper + digits, 8)}/{v}"),
        lambda: (v := chosen(), assign(v, _PASSWORDS)), lambda: (v := some(alnum + "!@#$%^&*?", 6, 16) + some(digits, 1), assign(v)),
        lambda: (v := some(lower, 10, 24), assign(v, _PASSWORDS)), lambda: (v := phrase(""), assign(v, _PASSWORDS)),
        lambda: (v := phrase(" "), assign(v, _PASSWORDS, '"')),
    ]
    other = [
        lambda: (v := some(hexes, 32, 64), variable(("_MD5", "_SHA", "_SHA256", "_COMMIT", "_REV", "_CHECKSUM", "_DIGEST", "_HASH", "_ID")) + v),
        lambda: (v := uuid(), variable(("_ID", "_UUID", "_GUID", "_BUILD")) + v),
        lambda: (v := plain(2, "_") + some(digits, 1, 2), variable(("", "_NAME", "_FILE", "_HOST")) + v),
        lambda: (v := str(rng.choice([short(), unset(), "password", "pass", "pw"])), login(v.replace(" ", "").replace("/", ""))),
        lambda: (v := one().title() + some(digits, 1, 4), assign(v, ("Auth", "Key", "Token", "auth", "key", "token", "credentials"), "")),
        lambda: (v := some(upper, 2, 5) + str(rng.choice(["", "-"])) + some(digits, 1, 4),
                 assign(v, ("Auth", "Key", "Token", "auth", "key", "token", "secret"), "")),
        lambda: (v := some(upper, 1, 2) + one().title() + some(digits, 1), assign(v, ("Auth", "Token", "Key", "auth", "Bearer"), "")),
        lambda: (v := uuid(), v), lambda: (v := uuid(), "id=" + v),
        lambda: (v := some(hexes, 40), str(rng.choice(["commit ", "sha1 ", "", "rev "])) + v),
        lambda: (v := some(hexes, 32), str(rng.choice(["md5 ", "etag ", "", "md5:"])) + v),
        lambda: (v := some(hexes, 64), str(rng.choice(["", f"{plain(1, '')}@"])) + "sha256:" + v),
        lambda: (v := f"{plain(1, '')}{some(digits, 1, 4)}", f"http://{plain(1, '')}:{some(digits, 4)}/{plain(1, '')}/{v}@{one()}"),
        lambda: (v := some(digits, 12, 19), str(rng.choice(["", "no. ", "id=", "order ", "+"])) + v),
        lambda: (v := "-".join(some(digits, 4) for _ in range(4)), v),
        lambda: (v := f"{plain(2, '_')}_{some(digits, 1, 4)}__x", v),
        lambda: (v := f"{plain(2, '-')}-{some(digits, 2, 4)}-{plain(1, '')}", f"https://example.com/{v}"),
        lambda: (v := f"/usr/lib/{plain(1, '')}{some(digits, 1)}/{plain(2, '/')}", v),
        lambda: (v := f"{plain(1, '')}-{some(digits, 4)}-{plain(1, '')}aa", f"{v}@mail.example.com"),
        lambda: (v := f"20{some('012', 1)}{some(digits, 1)}-0{some('123456789', 1)}-1{some(digits, 1)}T10", v + ":20:30"),
        lambda: (v := plain(2, "") + some(digits, 2) + plain(1, ""), v),
        lambda: (v := plain(1, "").title() + plain(1, "").title() + plain(1, "").title() + "Xyz", v + "()"),
        lambda: (v := b64(40), "data:image/png;base64," + v),
        lambda: (v := plain(2, "_") + "_name12", f"{str(rng.choice(['name', 'user', 'file', 'key']))}={v}"),
        lambda: (v := short(), assign(v)), lambda: (v := one(), assign(v)), lambda: (v := word(), assign(v, quote="")),
        lambda: (v := unset(), assign(v, quote="")), lambda: (v := some(digits, 1, 4), assign(v)),
        lambda: (v := " ".join(str(rng.choice(["the", "of", "is", one()])) for _ in range(3)), assign(v, ("key", "token", "auth", "secret"), '"')),
    ]
    out = []
    for y, kinds in ((1, secret), (0, other)):
        for kind in kinds:
            for _ in range(each):
                value, text = kind()
                left = " ".join(word() for _ in range(int(rng.integers(0, 7))))
                right = " ".join(word() for _ in range(int(rng.integers(0, 4))))
                out.append((f"{left} {text} {right}".strip(), value, y))
    return out


@dataclass
class Model:
    words: list[bytes]
    forest: Forest


def training_table(reader: Reader, findings: list[tuple[str, str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the candidates that lie in the labelled findings."""
    texts = pa.array([t for t, _, _ in findings])
    xs, ys = [], []
    for first, _, data, bounds in text_slices(texts):
        starts, ends, owner = reader.candidates(data, bounds)
        x = reader.features(data, bounds, starts, ends, owner)
        raw = data.tobytes()
        for i, (a, b, o) in enumerate(zip(starts.tolist(), ends.tolist(), owner.tolist())):
            _, value, y = findings[first + o]
            found = raw[a:b].decode()
            if found in value or value in found:
                xs.append(x[i])
                ys.append(y)
    return np.array(xs), np.array(ys, float)


def ordinary(word: str) -> bool:
    """A credential of letters alone must not serve as an ordinary word."""
    return word.isalpha() and not word.startswith(PREFIXES)


class Drawn:
    """Stands for a list of ``n`` words of which only some are fetched: first says which are asked for, then gives them."""

    def __init__(self, n: int):
        self.n, self.asked, self.fetched = n, set(), {}

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> str:
        self.asked.add(i)
        return self.fetched.get(i, "")


def corpus_words(texts: DataFrame) -> DataFrame:
    """Stored ``word, bucket`` of each distinct ordinary word of the column ``text``."""
    def run(batches):
        for batch in batches:
            found = {w for text in batch.column(0).to_pylist() for w in text.split()}
            yield pa.RecordBatch.from_arrays([pa.array([w for w in found if ordinary(w)], pa.string())], ["word"])

    words = texts.where(F.col("text").isNotNull()).select("text").mapInArrow(tidy(run), "word string").distinct()
    return stage(words.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(WORD_BUCKETS)).cast("int")))


def _fetched(words: DataFrame, starts: dict[int, int], numbers: set[int]) -> dict[int, str]:
    """The words of the given numbers: those of a bucket are numbered from its start on, in their order."""
    buckets = np.array(sorted(starts, key=starts.get))
    firsts = np.array([starts[b] for b in buckets])
    wanted = np.array(sorted(numbers))
    at = buckets[np.searchsorted(firsts, wanted, "right") - 1]
    asked = words.sparkSession.createDataFrame(
        [(int(b), int(n - starts[int(b)]) + 1, int(n)) for b, n in zip(at, wanted)], "bucket int, place int, number bigint")
    placed = words.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("word")))
    return {r["number"]: r["word"] for r in placed.join(F.broadcast(asked), ["bucket", "place"]).select("number", "word").collect()}


def fit(documents: DataFrame, vocabulary_path: str, whole: bool = False) -> Model:
    """Words around the labelled findings are drawn from all texts (``whole``), or from ``SAMPLE_TEXTS`` picked by a hash of the id."""
    rows = documents.select("doc_id", "text").where(F.col("text").isNotNull())
    known = dictionary(vocabulary_path)
    common = tuple(w.decode() for w in known)
    if whole:
        stored = corpus_words(rows)
        sizes = sorted((r[0], r[1]) for r in stored.groupBy("bucket").count().collect())
        starts = dict(zip((b for b, _ in sizes), np.cumsum([0, *[n for _, n in sizes]]).tolist()))
        words = Drawn(sum(n for _, n in sizes))
        labelled_findings(words, known=common)  # the draws do not depend on what the words are
        if words.asked:
            words.fetched = _fetched(stored, starts, words.asked)
    else:
        texts = sample_rows(rows, SAMPLE_TEXTS, "doc_id").select("text").collect()
        words = sorted({w for r in texts for w in r[0].split() if ordinary(w)})
    reader = Reader(known)
    return Model(known, train_forest(*training_table(reader, labelled_findings(words, known=common))))


def find(documents: DataFrame, model: Model, threshold: float = 0.5, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """One row for each candidate: ``doc_id, start, length, score, is_secret, value`` (places in code points)."""
    kind = documents.schema[id_column].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        reader, forest = Reader(shared.value.words), shared.value.forest
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1)):
                starts, ends, owner = reader.candidates(data, bounds)
                score = forest.scores(reader.features(data, bounds, starts, ends, owner))
                outer = outermost(starts, ends, score >= threshold)
                starts, ends, owner, score = starts[outer], ends[outer], owner[outer], score[outer]
                points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first).take(pa.array(owner)),
                    pa.array(points[starts] - points[bounds[owner]]), pa.array(points[ends] - points[starts]), pa.array(score),
                    pa.array(score >= threshold),
                    pa.array([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())], pa.string())],
                    ["doc_id", "start", "length", "score", "is_secret", "value"])

    schema = f"doc_id {kind}, start bigint, length bigint, score double, is_secret boolean, value string"
    return documents.select(id_column, text_column).mapInArrow(tidy(run), schema)


def redact(documents: DataFrame, model: Model, threshold: float = 0.5, text_column: str = "text") -> DataFrame:
    """``documents`` with every secret in the text replaced by ``MARK``; NULL stays NULL."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    old, new = unique_marker(documents, "_old_text"), unique_marker(documents, "_new_text")

    def make():
        reader, forest = Reader(shared.value.words), shared.value.forest

        def columns(data, bounds):
            starts, ends, owner = reader.candidates(data, bounds)
            secret = forest.scores(reader.features(data, bounds, starts, ends, owner)) >= threshold
            raw, mark = data.tobytes(), MARK.encode()
            parts: dict[int, list[bytes]] = {}
            reached: dict[int, int] = {}
            for a, b, o in zip(starts[secret].tolist(), ends[secret].tolist(), owner[secret].tolist()):
                at = reached.get(o, int(bounds[o]))
                if a >= at:  # a secret that begins inside the one before shares its mark
                    parts.setdefault(o, []).extend((raw[at:a], mark))
                reached[o] = max(b, at)
            texts = [None] * (len(bounds) - 1)  # NULL where nothing changes
            for o, found in parts.items():
                texts[o] = b"".join([*found, raw[reached[o]:int(bounds[o + 1])]]).decode()
            return [pa.array(texts, pa.string())]

        return columns

    found = with_text_columns(documents.withColumn(old, F.col(text_column)), text_column, f"`{new}` string", make)
    return found.select(*[
        F.coalesce(new, old).alias(text_column) if c == text_column else F.col(f"`{c}`") for c in documents.columns])
