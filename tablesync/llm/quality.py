"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are counts of the line (length, letter cases, digits, symbols, repeated
words, ...) cut into bins, those of the line before and after it, and the labels of neighbouring lines. Forward-backward
gives each line's probability of being good; a document's score is their mean weighted by line length.

Labels come for documents, so a training line has its document's label. Weights and the four transitions maximise one
penalised conditional likelihood, in which both labels, and documents of any number of lines, count alike. As no training document
changes its label, the data alone would forbid changes; the penalty ``hold`` of the transitions keeps them possible, since a bad
passage may stand in a good document. Weights are learned from a bounded
sample: up to ``sample_docs`` documents of each label, first by a hash of the id, without those of
more than ``sample_lines`` lines; of an id's different texts the one with the least hash. Scoring covers every line of every text.

Defined results: NULL, empty and blank texts have no lines and get the share of good documents among all labels
(0.5 without labels). A document with contradicting labels is not learned from. Equal texts get equal scores.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["QualityModel", "line_features", "learn_quality", "score_quality"]

_CLASSES = [bytes(c) for c in (
    range(65, 91), range(97, 123), range(48, 58), b".,;:!?'\"()-", b"!", b"&#*$%|<>{}[]@^~=_\\/+`", range(128, 256), b" \t\r\x0b\x0c")]
NAMES = ("length", "upper", "lower", "digits", "marks", "shouts", "symbols", "wide", "blanks",
         "word_length", "distinct", "repeats", "longest", "capitals", "again")


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Lengths (code points) and features of the non-blank lines of a text."""
    rows, lengths, seen = [], [], set()
    for line in (text or "").split("\n"):
        words = line.split()
        if not words:
            continue
        data = line.encode("utf-8", "replace")
        n = len(data)
        shares = [(n - len(data.translate(None, c))) / n for c in _CLASSES]
        rows.append((
            np.log(n), *shares, n / len(words), len(set(words)) / len(words),
            sum(map(operator.eq, words, words[1:])) / len(words), np.log(max(map(len, words))),
            sum(map(str.istitle, words)) / len(words), line in seen))
        lengths.append(len(line))
        seen.add(line)
    return np.array(lengths, dtype=np.float64), np.array(rows, dtype=np.float32).reshape(-1, len(NAMES))


def _padded(bounds: np.ndarray, cells: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sequences of like length as (row index matrix, mask); sequences longer than the cells come alone."""
    sizes = np.diff(bounds)
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    i = 0
    while i < len(order):
        widths = sizes[order[i:]]
        fits = np.flatnonzero(np.arange(1, len(widths) + 1) * widths > cells)
        j = i + max(1, int(fits[0]) if len(fits) else len(widths))
        j = min(j, i + max(1, int(np.searchsorted(widths, 2 * widths[0], "right"))))
        which = order[i:j]
        width = int(sizes[which[-1]])
        at = np.arange(width)
        mask = at < sizes[which][:, None]
        yield np.where(mask, bounds[which][:, None] + at, 0), mask
        i = j


def forward_backward(
    unary: np.ndarray, move: np.ndarray, mask: np.ndarray, weight: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each cell, and the expected label pairs, sequences counted by ``weight``.

    ``unary``: log-odds of good; ``move``: log-weights of label pairs.
    """
    d, width = unary.shape
    weight = np.ones(d) if weight is None else weight
    trans = np.exp(move)
    u = np.clip(unary, -30, 30)
    emit = np.stack([1 / (1 + np.exp(u)), 1 / (1 + np.exp(-u))], axis=2)
    ahead = np.empty((width, d, 2))
    state = emit[:, 0] / emit[:, 0].sum(1, keepdims=True)
    ahead[0] = state
    for t in range(1, width):
        nxt = (state @ trans) * emit[:, t]
        nxt /= nxt.sum(1, keepdims=True)
        state = np.where(mask[:, t:t + 1], nxt, state)
        ahead[t] = state
    back, good, pairs = np.full((d, 2), 0.5), np.empty((d, width)), np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        p = ahead[t] * back
        p /= p.sum(1, keepdims=True)
        good[:, t] = p[:, 1]
        if t:
            on = mask[:, t]
            right = emit[:, t] * back
            joint = ahead[t - 1][:, :, None] * trans * right[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            pairs += np.tensordot(weight[on], joint[on], 1)
            left = right @ trans.T
            back = np.where(on[:, None], left / left.sum(1, keepdims=True), back)
    return good, pairs


@dataclass
class QualityModel:
    edges: np.ndarray  # [feature, cut]
    weights: np.ndarray  # [own, line before, line after][feature][bin]
    bias: float
    move: np.ndarray  # [label][next label]
    prior: float
    scale: tuple[float, float] = (1.0, 0.0)  # of a document's log-odds, see ``calibrate``

    def bins(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, f, "left") for e, f in zip(self.edges, features.T)], axis=1)

    def unary(self, bins: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        own, before, after = (w[np.arange(len(self.edges)), bins].sum(1) for w in self.weights)
        out = own + self.bias
        first = np.zeros(len(bins) + 1, dtype=bool)
        first[bounds[:-1]] = True
        inner = ~first[1:-1]  # line i + 1 goes on with the text of line i
        out[1:][inner] += before[:-1][inner]
        out[:-1][inner] += after[1:][inner]
        return out

    def score(self, texts) -> list[float]:
        return self.score_lines([line_features(text) for text in texts])

    def score_lines(self, described: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
        lengths, rows = [d[0] for d in described], [d[1] for d in described]
        cuts = np.concatenate([[0], np.cumsum([len(n) for n in lengths])]).astype(np.int64)
        if not cuts[-1] or not len(self.edges):
            return [self.prior] * len(described)
        weight = np.concatenate(lengths)
        unary = self.unary(self.bins(np.concatenate(rows)), cuts)
        good = np.empty(len(unary))
        for index, mask in _padded(cuts):
            good[index[mask]] = forward_backward(unary[index], self.move, mask)[0][mask]
        sums = np.concatenate([[0.0], np.cumsum(good * weight)])
        whole = np.concatenate([[0.0], np.cumsum(weight)])
        top, total = sums[cuts[1:]] - sums[cuts[:-1]], whole[cuts[1:]] - whole[cuts[:-1]]
        odds = _log_odds(top / np.maximum(total, 1e-9))
        return [float(p) if b else self.prior for p, b in zip(1 / (1 + np.exp(-(self.scale[0] * odds + self.scale[1]))), total)]


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def calibrate(scores: np.ndarray, labels: np.ndarray, prior: float, rounds: int = 40) -> tuple[float, float]:
    """Scale and shift of the log-odds that make documents scores probabilities at the prior share of good documents."""
    x, y = _log_odds(scores), labels.astype(float)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    a, b = 1.0, 0.0
    for _ in range(rounds):  # Newton steps, held near the plain scale where the labels are separated
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - y) * weight * x).sum() + 2.0 * (a - 1), ((p - y) * weight).sum() + 0.2 * b])
        w = p * (1 - p) * weight
        h = np.array([[(w * x * x).sum() + 2.0, (w * x).sum()], [(w * x).sum(), w.sum() + 0.2]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
    return max(float(a), 0.1), float(b)


class _Likelihood:
    """The gradient of the penalised likelihood of the line labels in all weights: lines', neighbours', the bias, four transitions."""

    def __init__(self, edges: np.ndarray, features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, decay: float, hold: float):
        self.edges, self.bounds, self.labels = edges, bounds, labels
        self.shape = (3, len(edges), edges.shape[1] + 1)
        self.bins = self.model(np.zeros(np.prod(self.shape) + 5), 0.5).bins(features)
        sizes = np.diff(bounds)
        share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
        self.of_doc = share / np.maximum(sizes, 1)
        self.of_line, self.truth = np.repeat(self.of_doc, sizes), np.repeat(labels, sizes).astype(float)
        # every training pair keeps its label
        self.pairs = np.diag([(self.of_doc * np.maximum(sizes - 1, 0) * (labels == y)).sum() for y in (0, 1)])
        self.layouts = [(index, mask, self.of_doc[np.searchsorted(bounds, index[:, 0], "right") - 1]) for index, mask in _padded(bounds)]
        first = np.zeros(len(self.bins) + 1, dtype=bool)
        first[bounds[:-1]] = True
        self.inner = np.flatnonzero(~first[1:-1])
        self.flat = self.bins + np.arange(len(edges)) * self.shape[2]
        self.penalty = np.concatenate([np.full(np.prod(self.shape) + 1, decay), np.full(4, hold)])

    def model(self, theta: np.ndarray, prior: float) -> QualityModel:
        return QualityModel(self.edges, theta[:-5].reshape(self.shape).copy(), float(theta[-5]), theta[-4:].reshape(2, 2).copy(), prior)

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        model = self.model(theta, 0.5)
        unary = model.unary(self.bins, self.bounds)
        good, expected = np.empty(len(unary)), np.zeros((2, 2))
        for index, mask, weight in self.layouts:
            p, pairs = forward_backward(unary[index], model.move, mask, weight)
            good[index[mask]] = p[mask]
            expected += pairs
        error = (self.truth - good) * self.of_line
        n, size = self.shape[1], self.shape[1] * self.shape[2]
        parts = (self.flat, error), (self.flat[self.inner], error[self.inner + 1]), (self.flat[self.inner + 1], error[self.inner])
        lines = [np.bincount(rows.ravel(), np.repeat(errors, n), size) for rows, errors in parts]
        return np.concatenate([*lines, [error.sum()], (self.pairs - expected).ravel()]) - self.penalty * theta


def fit(
    features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.1, decay: float = 0.0005, hold: float = 0.05,
) -> QualityModel:
    """Maximise the penalised conditional likelihood of line labels by Adam; ``labels`` per sequence."""
    prior = float(labels.mean()) if len(bounds) > 1 else 0.5
    if not len(features) or prior in (0.0, 1.0):
        return QualityModel(np.empty((0, 0)), np.zeros((3, 0, 0)), 0.0, np.zeros((2, 2)), prior)
    edges = np.stack([np.quantile(f, (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)) for f in features.T])
    likelihood = _Likelihood(edges, features, bounds, labels, decay, hold)
    theta = np.zeros_like(likelihood.penalty)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        grad = likelihood.gradient(theta)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate / np.sqrt(1 + step / 30) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return likelihood.model(theta, prior)


def learn_quality(docs: DataFrame, labels: DataFrame, sample_docs: int = 1500, sample_lines: int = 400) -> QualityModel:
    """A model from (doc_id, text) and (doc_id, quality) rows."""
    plain = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    order = (F.xxhash64(F.lit("quality"), F.col("doc_id")), "doc_id")
    chosen = [plain.where(F.col("quality") == q).orderBy(*order).limit(sample_docs).select("doc_id", "quality") for q in (0, 1)]
    wanted = {r["doc_id"]: r["quality"] for c in chosen for r in c.collect()}
    few = docs.sparkSession.createDataFrame([(k,) for k in wanted], "doc_id long")
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [line_features(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lengths": [n.tobytes() for n, _ in found], "lines": [f.tobytes() for _, f in found]})

    # at most 2 * sample_docs ids, so they may be sent to every task; one text of each, as an id may have any number of rows
    texts = docs.where((breaks < sample_lines) & F.col("text").rlike(r"\S")).join(F.broadcast(few), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("luck"), "text")).alias("least")).select("doc_id", "least.text")
    found = texts.mapInPandas(describe, "doc_id long, lengths binary, lines binary")
    shares = {r["quality"]: r["n"] for r in plain.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts, bounds, truth, lengths = [], [0], [], []
    for doc_id, size, lines in sorted({(r["doc_id"], bytes(r["lengths"]), bytes(r["lines"])) for r in found.collect()}):
        if size:
            parts.append(np.frombuffer(lines, dtype=np.float32).reshape(-1, len(NAMES)))
            lengths.append(np.frombuffer(size, dtype=np.float64))
            bounds.append(bounds[-1] + len(parts[-1]))
            truth.append(wanted[doc_id])
    model = fit(np.concatenate(parts) if parts else np.empty((0, len(NAMES))), np.array(bounds), np.array(truth))
    model.prior = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    if len(model.edges):
        model.scale = calibrate(np.array(model.score_lines(list(zip(lengths, parts)))), np.array(truth), model.prior)
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row of (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.score(batch["text"])})

    # ids travel as text: pandas makes numbers with a NULL among them floats
    out = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, "doc_id string, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """The rows whose text scores at least ``threshold``, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([s >= threshold for s in model.score(batch.column("text").to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
