"""A quality classifier learnt from positive and unlabelled texts.

Each text becomes a short vector of measures of its bytes, words and lines. A linear score is
fitted by minimising the non-negative unbiased risk of the logistic loss: with prior p, trusted
positives P and unlabelled texts U, it is p * R+(P) + max(0, R-(U) - p * R-(P)). P are texts of label
1 outside the held-out fold; U are all texts outside it, whatever their labels, which are never
looked at; label 0 is not used at all. Newton steps sum gradient and curvature over all of U where
its rows are; a step that would make the second part of the risk negative is halved until it doesn't.

The class prior is estimated, not counted: a first fit tells P from U, and among its thresholds the
one with the least upper bound of (share of U above) / (share of P above) gives the prior, since
above a threshold that no negative passes this ratio is the prior (best bin estimation). With the
logistic loss the fitted score is itself a probability.

P is at most MAX_LABELLED rows, the first in order of a hash of their id; all else runs over all rows.
Whole texts are measured, never prefixes.

Defined cases: a null text counts as empty, and an empty text gets the score of its (zero) vector;
ids with several labels count once, if the labels agree; null labels and null ids are no labels;
repeated rows count again; of rows that share an id each is scored by its own text; without positives
or without texts outside the held-out fold every score is 0.5; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm import bytesops
from silkgrain.llm.common import fold_of, table, written

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
MAX_LABELLED = 40_000

_CLASS = np.zeros((256, 8), np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytesops.SPACES, b"#*$%&|<>", b"!", b".,;:?")):
    _CLASS[list(_chars), _k] = 1
_CLASS[128:, 7] = 1
N_FEATURES = 22


def features(text: bytes) -> np.ndarray:
    """The measures of one whole text."""
    counts = np.zeros(256, np.int64)
    for k in range(0, len(text), 1 << 22):
        counts += np.bincount(np.frombuffer(text, np.uint8, min(1 << 22, len(text) - k), k), minlength=256)
    lower, upper, digits, spaces, symbols, shouts, stops, high = (counts @ _CLASS).tolist()
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(N_FEATURES, np.float32)
    size, letters = len(text), max(1, lower + upper + high)
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = max(1, n - 2)
    new_windows = len(set(zip(words, words[1:], words[2:], strict=False))) / windows if n > 2 else 1.0
    repeat = sum(map(operator.eq, words, words[1:])) / n
    stale = 1 - len(set(lines)) / len(lines)
    up, sym, shout, pipe = upper / letters, symbols / n, shouts / n, counts[124] / n
    return np.array([
        min(np.log1p(n), 9) / 9, min(n, 20) / 20, min((size - spaces) / n, 20) / 20, up, min(1, 3 * up), min(1, sym), min(1, 5 * sym),
        min(1, shout), min(1, 5 * shout), min(1, pipe), digits / size, len(set(words)) / n, stale, min(1, 3 * stale), new_windows,
        min(1, 3 * (1 - new_windows)), repeat, min(1, 5 * repeat), min(1, stops / n), min(1, len(lines) / n), high / size, spaces / size,
    ], np.float32)


@dataclass(frozen=True)
class PUModel:
    """logit = weights . (x - mean) / scale + bias."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sig(((x - self.mean) / self.scale) @ self.weights + self.bias)


Sums = Callable[[Callable[[np.ndarray], np.ndarray]], np.ndarray]


def _sig(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def estimated_prior(pos: np.ndarray, unl: np.ndarray, n_unl: int, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Best bin estimation. pos: scores of positives in falling order; unl: how many of the n_unl
    unlabelled scores are at least as high as each of them."""
    n = len(pos)
    q_pos, q_unl = np.arange(1, n + 1) / n, unl / n_unl
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(n) + 1 / np.sqrt(n_unl))
    best = int(np.argmin((q_unl + (1 + gamma) * slack) / q_pos))
    return float(np.clip(q_unl[best] / q_pos[best], 0.01, 0.99))


def fit_pu(pos: np.ndarray, sums: Sums, rounds: int = 30, decay: float = 0.03, prior: float | None = None) -> PUModel:
    """The model of positives and of the unlabelled rows, of which sums(f) gives the sum of f(rows)
    over blocks of rows. prior: of the positive class, estimated if not given."""
    d = N_FEATURES
    flat = PUModel(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 0.5)
    if not len(pos):
        return flat
    moments = sums(lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]))
    if not len(moments):
        return flat
    n, mean = moments[0], moments[1 : d + 1] / moments[0]
    scale = np.sqrt(np.maximum(moments[d + 1 :] / n - mean**2, 0)) + 1e-3
    z_of = lambda x: np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    p = z_of(pos)

    def slopes(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss of U as negatives, with its gradient and curvature."""

        def part(x: np.ndarray) -> np.ndarray:
            z = z_of(x)
            s = z @ w
            h = _sig(s)
            return np.concatenate([[np.logaddexp(0, s).sum()], z.T @ h, ((z * (h * (1 - h))[:, None]).T @ z).ravel()])

        all_ = sums(part) / n
        return float(all_[0]), all_[1 : d + 2], all_[d + 2 :].reshape(d + 1, d + 1)

    keep = decay * np.append(np.ones(d), 0.0)  # the bias is free

    def step(w: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        by = np.linalg.solve(h + np.diag(keep + 1e-9), g + keep * w)
        by *= min(1.0, 2.0 / max(float(np.abs(by).max()), 1e-12))
        return by, float(np.abs(by).max())

    w = np.zeros(d + 1)
    if prior is None:
        for _ in range(rounds):  # P against U
            _, g, h = slopes(w)
            hp = _sig(p @ w)
            by, size = step(w, g - p.T @ (1 - hp) / len(p), h + (p * (hp * (1 - hp))[:, None]).T @ p / len(p))
            w = np.round(w - by, 10)
            if size < 1e-3:
                break
        order = np.sort(p @ w)[::-1]
        at_least = lambda x: np.bincount(np.searchsorted(-order, -(z_of(x) @ w), "left"), minlength=len(order) + 1)[:-1].astype(float)
        prior = estimated_prior(order, np.cumsum(sums(at_least)), int(n))
    w = np.zeros(d + 1)
    _, g, h = slopes(w)
    for _ in range(rounds):  # non-negative unbiased risk
        by, size = step(w, g - prior * p.mean(axis=0), h)
        for _ in range(8):
            new = np.round(w - by, 10)
            loss, g_new, h_new = slopes(new)
            if loss >= prior * np.logaddexp(0, p @ new).mean():
                break
            by, size = by / 2, size / 2
        else:
            break
        w, g, h = new, g_new, h_new
        if size < 1e-3:
            break
    return PUModel(mean, scale, w[:-1], float(w[-1]), prior)


def measure(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, held_out and x, the vector of each text, of every row; and its row key, if named."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    more = [row] if row else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in bytesops.texts(batch.column(1))], np.float32).reshape(-1, N_FEATURES)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat, *batch.columns[2:]], names=["doc_id", "x", *more])

    shape = ", ".join([f"doc_id {kind}, x array<float>", *(f"{c} {docs.schema[c].dataType.simpleString()}" for c in more)])
    out = docs.select("doc_id", F.col("text").cast("string"), *more).mapInArrow(run, shape)
    return out.withColumn("held_out", fold_of(F.col("doc_id"), FOLDS) == HELD_OUT)


def train(measured: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> PUModel:
    """The model of at most `most` positives and of all rows outside the held-out fold."""
    one = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"))
    one = one.where("q = 1").where(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    order = F.xxhash64(F.col("doc_id").cast("string"))
    picked = one.join(measured.select("doc_id", "x"), "doc_id").select(order.alias("o"), "doc_id", "x").orderBy("o", "doc_id", "x").limit(most)
    pos = picked.select("x").toArrow()["x"].combine_chunks()
    unlabelled = measured.where("NOT held_out").select("x")

    def sums(f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks; each task adds up its own, and what they found is added by place."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    v = f(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(np.float64))
                    total = v if total is None else total + v
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

        rows = unlabelled.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        return rows["v"].to_numpy()[np.argsort(rows["i"].to_numpy())]

    return fit_pu(pos.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(np.float64), sums)


def score(measured: DataFrame, model: PUModel, row: str | None = None) -> DataFrame:
    """measured with score, predicted; the vectors are only read."""
    kind = measured.schema["doc_id"].dataType.simpleString()
    more = [row] if row else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(x.astype(np.float64))), *batch.columns[3:]], names=["doc_id", "held_out", "score", *more])

    shape = ", ".join([f"doc_id {kind}, held_out boolean, score double", *(f"{c} {measured.schema[c].dataType.simpleString()}" for c in more)])
    out = measured.select("doc_id", "held_out", "x", *more).mapInArrow(run, shape)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; and its row key, if named."""
    measured = written(measure(docs, row))
    return score(measured, train(measured, labels), row)


def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
