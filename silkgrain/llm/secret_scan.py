"""Secrets in text: exact base patterns, and a character network over every candidate.

Base kinds are ``assign``, ``access`` and ``hex``. Candidates are all runs of 16 or more key
characters, and runs of 8 to 15 that stand after a word of KEYS and a colon or equals sign. A small
convolutional network in numpy reads a candidate with its surroundings. A run longer than its window
is read in windows that overlap by half; each that is found is a span, and those that meet are one.
The network is trained on labelled findings that make_findings() writes from a seed, calibrated on a
second part of them, and its threshold is the highest that keeps RECALL of the secrets in a third.
Its spans have the kind ``cnn``; base spans always stay, and a candidate with under LEAST
characters outside them is not reported again.

Defined cases: null and empty texts have no spans; ties and repeated rows are scanned alike; whole
texts and whole runs are read, in blocks of candidates, however long; other columns are ignored (those
of redacted() are kept); an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm import bytesops
from silkgrain.llm.common import table

KINDS = ("assign", "access", "hex", "cnn")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
KEYS = "key auth credential pwd pass passphrase bearer private login signature apikey".split()
_SHORT = re.compile(rf"""(?:{"|".join(KEYS)})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_=-]{{8,15}})(?![A-Za-z0-9+/_=-])""", re.I | re.A)
_SHORT_WORDS = tuple(k.encode() for k in KEYS)
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_KEY = np.zeros(256, bool)
_KEY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
LEFT, BODY, RIGHT = 40, 72, 16
LEAST = 8
RECALL = 0.98
FINDINGS = 6000
_CODES = np.minimum(np.arange(256), 127)
_CODES[[0, 63]] = 127  # what is not ASCII is encoded as a question mark


def base_spans(text: str, assign: bool = True, access: bool = True, hexes: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and not overlapping within a kind."""
    out = []
    if assign:
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if access:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if hexes:
        out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidates(text: str, taken: list[tuple[int, int, str]], long: bool = True, short: bool = True) -> list[tuple[int, int]]:
    """Runs of key characters, in order, that reach LEAST characters or more beyond the base spans."""
    found = [m.span() for m in _RUN.finditer(text)] if long else []
    found = sorted({*found, *(m.span(1) for m in _SHORT.finditer(text))}) if short else found
    ends, k, out = sorted(taken), 0, []
    for s, e in found:
        while k < len(ends) and ends[k][1] <= s:
            k += 1
        at, free, j = s, 0, k  # base spans that end before s stand before k or among the next
        while j < len(ends) and ends[j][0] < e:
            free, at, j = free + max(0, ends[j][0] - at), max(at, ends[j][1]), j + 1
        if free + max(0, e - at) >= LEAST:
            out.append((s, e))
    return out


def windows(start: int, end: int) -> Iterator[tuple[int, int]]:
    """A candidate, or the overlapping windows of a long one."""
    at = start
    while end - at > BODY:
        yield at, at + BODY
        at += BODY // 2
    yield max(start, min(at, end - BODY)), end


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Character codes of the context and the candidate (one window of it), and where that is (+128)."""
    codes = np.zeros(LEFT + BODY + RIGHT, np.int64)
    left = text[max(0, start - LEFT) : start]
    some = (left + text[start : min(end, start + BODY)] + text[end : end + RIGHT]).encode("ascii", "replace")
    at, size = LEFT - len(left), min(end - start, BODY)
    codes[at : at + len(some)] = _CODES[np.frombuffer(some, np.uint8)]
    codes[LEFT : LEFT + size] += 128
    return codes


def make_findings(n: int = FINDINGS, seed: int = 5) -> tuple[list[tuple[str, int, int]], list[int]]:
    """Labelled findings (text, start, end), half of them secrets, in invented surroundings."""
    r = random.Random(seed)
    alnum, low, hexd = string.ascii_letters + string.digits, string.ascii_lowercase, "0123456789abcdef"
    some = lambda chars, a, b: "".join(r.choice(chars) for _ in range(r.randint(a, b)))
    part = lambda: r.choice("bcdfghklmnprstvwz") + r.choice("aeiou") + r.choice(["", "", "n", "r", "s", "t", "l", "ch", "ng"])
    word = lambda: some(low, 2, 9) if r.random() < 0.3 else "".join(part() for _ in range(r.randint(1, 4)))
    bulk = lambda: "".join(part() for _ in range(r.randint(7, 14)))
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve", "sch", "ung", "keit", "tion", "ment", "ing", "eau", "oux", "cion", "lich"]
    blend = lambda: "".join(r.choice(parts) for _ in range(r.randint(6, 14)))
    prose = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))

    def with_digit(make):  # noqa: ANN001, ANN202
        while True:
            x = make()
            if any(c.isdigit() for c in x):
                return x

    secret = [
        lambda: with_digit(lambda: some(alnum, 20, 48)), lambda: with_digit(lambda: some(alnum + "+/", 32, 64)) + r.choice(["", "=", "=="]),
        lambda: r.choice(["ghp_", "gho_", "glpat-", "sk_live_", "sk-", "xoxb-", "AIza", "pk_test_", "hf_", "npm_"]) + with_digit(lambda: some(alnum, 20, 40)),
        lambda: with_digit(lambda: some(string.ascii_uppercase + string.digits, 20, 32)), lambda: "eyJ" + with_digit(lambda: some(alnum + "_-", 30, 80)),
        lambda: with_digit(lambda: some(hexd, 24, 31)), lambda: with_digit(lambda: some(low + string.digits, 20, 40)),
        lambda: some(string.ascii_letters, 20, 48), lambda: with_digit(lambda: some(alnum + "+/", 80, 200)),
    ]
    short = [lambda: with_digit(lambda: some(alnum, 8, 15)), lambda: with_digit(lambda: some(alnum + "_-", 10, 15))]
    short_clean = [bulk, blend, lambda: some(string.digits, 8, 15), lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: word() + "-" + word() + "-" + word(), lambda: word() + "_" + word() + str(r.randint(0, 9))]
    keys = ["key", "auth", "credential", "Authorization: Bearer", "client_id", "private_key", "access", "pwd", "SIGNING_KEY", "bearer", "pass"]
    clean = [
        lambda: some(string.digits, 16, 19), lambda: "-".join(some(string.digits, 3, 5) for _ in range(4)), lambda: some(string.digits, 16, 30),
        lambda: "-".join(some(hexd, k, k) for k in (8, 4, 4, 4, 12)), lambda: "/".join(["", str(r.randint(1990, 2030)), f"{r.randint(1, 12):02}", *(word() for _ in range(3))]) + "-" + prose(2, 4).replace(" ", "-"),
        lambda: r.choice(["IMG", "DSC", "scan", "report", "page"]) + f"_{r.randint(2000, 2030)}{r.randint(1, 12):02}{r.randint(1, 28):02}_{some(string.digits, 4, 8)}",
        lambda: "_".join([word(), word(), word(), str(r.randint(0, 99))]) + "_x", lambda: "=" * r.randint(8, 20) + str(r.randint(0, 9)) + "=" * r.randint(8, 20),
        lambda: prose(3, 5).replace(" ", "-") + "-" + str(r.randint(1, 2030)), lambda: "+" + some(string.digits, 15, 18),
        lambda: word().capitalize() * 3 + str(r.randint(1, 99)) + "abcdefgh", bulk, lambda: bulk().capitalize(), blend, lambda: blend().capitalize(), lambda: blend().upper(),
        lambda: bulk().upper(), lambda: "".join(word().capitalize() for _ in range(r.randint(4, 9))), lambda: "_".join(word() for _ in range(r.randint(3, 9))), lambda: "/".join(word() for _ in range(r.randint(4, 30))),
        lambda: r.choice("-=_+/") * r.randint(16, 90), lambda: prose(4, 9).replace(" ", "-"), lambda: "_".join(word() for _ in range(4)).upper(), lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{some(string.digits, 6, 6)}",
    ]
    found, label = [], []
    for k in range(n):
        y = k % 2
        few = r.random() < 0.12
        body = r.choice((short if y else short_clean) if few else secret if y else clean)()
        body = body[:15] if few else body if len(body) >= 16 else body + (some(string.digits, 16, 16) if r.random() < 0.5 else blend() + blend())
        left = prose(0, 8)
        if few:
            left += " " + r.choice(KEYS) + r.choice([": ", "=", " = ", "='", ': "'])
        elif y and r.random() < 0.7:
            left += " " + r.choice(keys) + r.choice([": ", "=", " = ", " ", ' = "', ": '"])
        elif not y and r.random() < 0.3:
            left += " " + r.choice(["id", "call", "card", "see", "file", "no.", "https://www.example.com", "date"]) + r.choice([": ", " ", "="])
        else:
            left += r.choice([" ", "\n", "(", ", "])
        if left and left[-1] in "+/_=-" or (left and left[-1].isalnum()):
            left += " "
        right = r.choice([" ", '" ', "\n", ".", ", ", ") "]) + prose(0, 4)
        at = len(left) + (r.randint(0, max(0, len(body) - BODY)) if y else 0)
        found.append((left + body + right, at, min(at + BODY, len(left) + len(body))))
        label.append(y)
    return found, label


@dataclass
class CharNet:
    """Embedding, one convolution, two maxima (over candidate and surroundings), one output."""

    emb: np.ndarray
    conv: np.ndarray
    cbias: np.ndarray
    out: np.ndarray
    obias: np.ndarray
    width: int = 5
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def _forward(self, codes: np.ndarray) -> tuple:
        e = self.emb[codes]
        n, length, d = e.shape
        m = length - self.width + 1
        win = np.concatenate([e[:, k : k + m] for k in range(self.width)], axis=2)
        a = np.maximum(win @ self.conv + self.cbias, 0)
        mid = codes[:, self.width // 2 : self.width // 2 + m] >= 128
        inner, outer = np.where(mid[..., None], a, 0), np.where(mid[..., None], 0, a)
        i, o = inner.argmax(axis=1), outer.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(inner, i[:, None], 1)[:, 0], np.take_along_axis(outer, o[:, None], 1)[:, 0], inner.sum(axis=1) / np.maximum(mid.sum(axis=1), 1)[:, None]], axis=1)
        return win, a, mid, i, o, pooled, pooled @ self.out + self.obias[0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(codes[k : k + 256])[-1] for k in range(0, len(codes), 256)]) if len(codes) else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(codes) + self.shift, -50, 50)))

    def step(self, codes: np.ndarray, y: np.ndarray, state: dict, t: int, rate: float = 0.01) -> None:
        """One step of Adam on the logistic loss of a batch."""
        win, a, mid, i, o, pooled, z = self._forward(codes)
        n, m, f = a.shape
        g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / n
        grads = {"out": pooled.T @ g, "obias": np.array([g.sum()])}
        gp = g[:, None] * self.out
        ga = np.where(mid[..., None], (gp[:, 2 * f :] / np.maximum(mid.sum(axis=1), 1)[:, None])[:, None], 0.0)
        rows, cols = np.arange(n)[:, None], np.arange(f)[None]
        inside, outside = mid[rows, i], ~mid[rows, o]
        np.add.at(ga, (rows, i, cols), gp[:, :f] * inside)
        np.add.at(ga, (rows, o, cols), gp[:, f : 2 * f] * outside)
        ga = ga * (a > 0)
        flat = ga.reshape(-1, f)
        grads["conv"], grads["cbias"] = win.reshape(-1, win.shape[2]).T @ flat, flat.sum(axis=0)
        gw = (flat @ self.conv.T).reshape(n, m, -1)
        d, ge = self.emb.shape[1], np.zeros_like(self.emb)
        for k in range(self.width):
            np.add.at(ge, codes[:, k : k + m], gw[..., k * d : (k + 1) * d])
        grads["emb"] = ge
        for name, grad in grads.items():
            m1, m2 = state.setdefault(name, (np.zeros_like(grad), np.zeros_like(grad)))
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
            state[name] = (m1, m2)
            setattr(self, name, getattr(self, name) - rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8))


def train_net(found: list[tuple[str, int, int]], label: list[int], epochs: int = 4, filters: int = 16, dims: int = 8, seed: int = 7, recall: float = RECALL) -> CharNet:
    """Fit on three fifths of the findings, calibrate on the fourth, set the threshold on the fifth."""
    codes, y = np.array([encode(*x) for x in found]), np.array(label, np.float64)
    g = np.random.default_rng(seed)
    order = g.permutation(len(codes))
    fit, held, last = np.split(order, [len(order) * 3 // 5, len(order) * 4 // 5])
    net = CharNet(g.normal(0, 0.3, (256, dims)), g.normal(0, 0.2, (5 * dims, filters)), np.zeros(filters), g.normal(0, 0.2, 3 * filters), np.zeros(1))
    state, t = {}, 0
    for _ in range(epochs):
        fit = g.permutation(fit)
        for k in range(0, len(fit), 64):
            t += 1
            net.step(codes[fit[k : k + 64]], y[fit[k : k + 64]], state, t)
    z, target = net.logits(codes[held]), y[held]
    a, w = np.stack([z, np.ones_like(z)], axis=1), np.array([1.0, 0.0])
    smooth = np.where(target == 1, 1 - 1 / (target.sum() + 2), 1 / ((1 - target).sum() + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (p - smooth) + 1e-3 * (w - [1, 0]))
    net.slope, net.shift = float(max(w[0], 1e-3)), float(w[1])
    p = np.sort(net.probability(codes[last])[y[last] == 1])
    net.threshold = float(p[int((1 - recall) * len(p))])
    return net


@functools.cache
def default_net() -> CharNet:
    return train_net(*make_findings())


def scan(raw: bytes, net: CharNet) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) of a whole text, in code points, in order."""
    data = np.frombuffer(raw, np.uint8)
    low = raw.lower()
    assign, access = any(w in low for w in _WORDS), b"AKIA" in raw
    edge = np.diff(np.concatenate([[False], _KEY[data], [False]]).astype(np.int8))
    long_run = bool(len(data)) and bool(((np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)) >= 16).any())
    short = any(w in low for w in _SHORT_WORDS)
    if not (assign or access or long_run or short):
        return []
    text = raw.decode("utf-8", "replace")
    spans = base_spans(text, assign, access, long_run)
    parts = (w for c in candidates(text, spans, long_run, short) for w in windows(*c))
    while part := list(itertools.islice(parts, 4096)):
        p = net.probability(np.array([encode(text, *w) for w in part]))
        for (s, e), q in zip(part, p, strict=True):
            if q >= net.threshold:
                if spans and spans[-1][2] == "cnn" and s < spans[-1][1]:
                    s = spans.pop()[0]  # windows of one run
                spans.append((s, e, "cnn"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every maximal run of spans replaced by a mark."""
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, net: CharNet | None = None) -> DataFrame:
    """doc_id, counts by base kind, digest of base spans, and all spans of every row."""
    net = net or default_net()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for text in bytesops.texts(batch.column(1)):
                spans = scan(text, net)
                for col, k in zip(cols, KINDS[:3], strict=False):
                    col.append(sum(s[2] == k for s in spans))
                show = lambda some: ",".join(f"{k}:{s}:{e}" for s, e, k in some)
                cols[3].append(hashlib.sha256(show(s for s in spans if s[2] != "cnn").encode()).hexdigest())
                cols[4].append(show(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    shape = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, shape)


def redacted(docs: DataFrame, net: CharNet | None = None) -> DataFrame:
    """docs with the secrets of text replaced and n_chars, where it exists, counted again.
    A null text stays null; every row stays."""
    net = net or default_net()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old, new = batch.column(0), []
            for value, text in zip(old, bytesops.texts(old), strict=True):
                spans = scan(text, net)
                new.append(redact(text.decode("utf-8", "replace"), spans) if spans else value.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()), *batch.columns[1:]], names=names)

    rest = [f.name for f in docs.schema if f.name != "text"]
    names = [f"c{k}" for k in range(len(rest) + 1)]
    shape = ", ".join(["c0 string", *(f"c{k + 1} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(rest))])
    out = docs.select(F.col("text").cast("string").alias("c0"), *(F.col(f"`{c}`").alias(f"c{k + 1}") for k, c in enumerate(rest))).mapInArrow(run, shape)
    at = dict(zip(["text", *rest], names, strict=True))
    count = F.length(F.col("c0")).cast(docs.schema["n_chars"].dataType) if "n_chars" in rest else None
    return out.select(*((count if c == "n_chars" else F.col(at[c])).alias(c) for c in docs.columns))


def op4_char_cnn_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
