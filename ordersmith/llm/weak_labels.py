"""Quality classifier from weak labels: overlapping heuristics, then a hashed linear scorer.

Each labeller looks at one statistic of a text and votes ``bad`` or abstains.
Expectation-maximisation over the votes of all documents estimates how often
each votes on bad and on good texts, and how many texts are bad; no labelled
row is used.  Only the votes' patterns matter to it, of which there are at
most ``2 ** VOTERS``.  The posterior of each text's pattern is then the target of
a logistic scorer on hashed features (word shapes, pairs of them, and binned
statistics), fitted on a bounded sample of rows (``FIT_ROWS``, about, drawn row
by row, repeated rows too) and applied to every whole text.

Null and empty texts have no votes and no shapes: they get the bias alone.
An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import texts
from .rules import COUNTS, FEATURES, RATES, stats_of

#: Statistic and the value above which its labeller votes bad.
LABELLERS = (("symbols_per_word", 0.15), ("dup_line_rate", 0.45), ("repeat_rate", 0.75), ("upper_rate", 0.35), ("marks_per_word", 0.5), ("bars_per_word", 0.15), ("long_rate", 0.3))
#: Two labellers look at the text as a whole: the rates' weighted sum, and the share of
#: a rate's scale that the strongest one reaches.  They overlap with all of the above and so
#: tie the kinds of bad text together, which seldom meet in one text.
SCALES = (("symbols_per_word", 1.0), ("dup_line_rate", 1.0), ("repeat_rate", 1.2), ("upper_rate", 0.6), ("marks_per_word", 1.5), ("bars_per_word", 0.4), ("long_rate", 0.5))
SUM_ABOVE, MOST_ABOVE = 0.62, 0.6
VOTERS = len(LABELLERS) + 2
#: Hashed dimensions of the scorer, and rows that it is fitted on, about.
DIMENSIONS, FIT_ROWS = 1024, 8_000


def rates_of(counts: dict[str, np.ndarray]) -> np.ndarray:
    out = [counts["n_words"].astype(float)]
    for _, a, b in RATES:
        out.append(np.where(counts[b] > 0, counts[a] / np.maximum(counts[b], 1), 0.0))
    return np.stack(out, axis=1)


def votes_of(rates: np.ndarray) -> np.ndarray:
    """The pattern of votes of each row, as bits."""
    out = np.zeros(len(rates), np.int64)
    for i, (name, above) in enumerate(LABELLERS):
        out |= (rates[:, FEATURES.index(name)] > above).astype(np.int64) << i
    part = np.stack([rates[:, FEATURES.index(name)] / scale for name, scale in SCALES], axis=1)
    out |= (part.sum(axis=1) > SUM_ABOVE).astype(np.int64) << len(LABELLERS)
    return out | ((part.max(axis=1) > MOST_ABOVE).astype(np.int64) << (len(LABELLERS) + 1))


@dataclass
class LabelModel:
    bad: float            # share of bad texts
    on_bad: np.ndarray    # how often each labeller votes on bad texts
    on_good: np.ndarray   # and on good ones

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        v = (pattern[:, None] >> np.arange(len(self.on_bad))) & 1
        one = np.log(self.bad) + (v * np.log(self.on_bad) + (1 - v) * np.log1p(-self.on_bad)).sum(axis=1)
        two = np.log1p(-self.bad) + (v * np.log(self.on_good) + (1 - v) * np.log1p(-self.on_good)).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(two - one, -500, 500)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM from the belief that a vote is seldom wrong; priors keep every rate inside (0, 1)."""
    k = VOTERS
    m = LabelModel(0.1, np.full(k, 0.3), np.full(k, 0.01))
    v = (patterns[:, None] >> np.arange(k)) & 1
    for _ in range(rounds):
        p = m.posterior(patterns) * counts
        q = counts - p
        m = LabelModel(float((p.sum() + 1) / (counts.sum() + 10)), (p @ v + 1) / (p.sum() + 4), (q @ v + 0.05) / (q.sum() + 10))
    return m


_CLASS = np.zeros(256, np.int64)
_CLASS[[*range(97, 123), *range(128, 256)]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[list(b".,;:'\"()-")] = 4
_CLASS[list(b"!?")] = 5
_CLASS[list(b"#*$%&|<>@=_~^+/\\")] = 6


def shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A small number for each word's shape (kinds of its first, second and last sign,
    which kinds it holds, its length in steps), and its document."""
    s, e, doc = T.spans(data, offsets)
    if not len(s):
        return s, doc
    c = _CLASS[data]
    bits = np.bitwise_or.reduceat(np.append(np.int64(1) << c, 0), np.stack([s, e], axis=1).ravel())[::2]
    ln = np.minimum(e - s, 24) // 4
    return ((bits * 7 + ln) * 7 + c[s]) * 7 + c[e - 1], doc


def features_of(data: np.ndarray, offsets: np.ndarray, rates: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    """Hashed features of each document, one row each."""
    n = len(offsets) - 1
    out = np.zeros((n, dims), np.float32)
    sh, doc = shapes(data, offsets)
    words = np.maximum(np.bincount(doc, minlength=n), 1)
    one = T.mix(sh.astype(np.uint64) + np.uint64(1 << 40)) % np.uint64(dims)
    flat = [doc * dims + one.astype(np.int64)]
    if len(sh) > 1:
        same = doc[1:] == doc[:-1]
        two = T.mix(sh[:-1].astype(np.uint64) * np.uint64(1 << 20) + sh[1:].astype(np.uint64)) % np.uint64(dims)
        flat.append(doc[1:][same] * dims + two.astype(np.int64)[same])
    out += np.sqrt(np.bincount(np.concatenate(flat), minlength=n * dims).reshape(n, dims) / words[:, None])
    bins = np.minimum((rates * np.array([0.01] + [20.0] * (rates.shape[1] - 1))), 60).astype(np.uint64)
    for j in range(1, rates.shape[1]):
        at = T.mix(bins[:, j] + np.uint64(j << 8) + np.uint64(1 << 50)) % np.uint64(dims)
        np.add.at(out, (np.arange(n), at.astype(np.int64)), 1.0)
    return out


def fit_scorer(x: np.ndarray, target: np.ndarray, l2: float = 3e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated gradient steps."""
    if not len(x):
        return np.zeros(DIMENSIONS), -10.0
    n, d = x.shape
    v = np.ones(d + 1)
    for _ in range(20):  # the largest eigenvalue gives the step
        u = x @ v[:-1] + v[-1]
        v = np.append(x.T @ u, u.sum()) / n
        top = np.linalg.norm(v)
        v /= top
    step = 1 / (0.25 * top + l2)
    w = np.zeros(d + 1)
    w[-1] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    y, old = w.copy(), w.copy()
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ y[:-1] + y[-1], -50, 50)))
        g = np.append(x.T @ (p - target) / n + l2 * y[:-1], (p - target).mean())
        w = y - step * g
        y = w + k / (k + 3) * (w - old)
        old = w
    return w[:-1], float(w[-1])


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[LabelModel, np.ndarray, float]:
    d = texts(docs)

    def patterns(batches):
        count = np.zeros(1 << VOTERS, np.int64)
        for b in T.blocks(batches):
            count += np.bincount(votes_of(rates_of(stats_of(*T.utf8(T.column(b, "text"))))), minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["pattern", "n"])

    got = d.mapInArrow(patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas().sort_values("pattern")
    model = fit_label_model(got["pattern"].to_numpy(np.int64), got["n"].to_numpy(float))

    def rows(batches):
        for b in T.blocks(batches):
            data, off = T.utf8(T.column(b, "text"))
            r = rates_of(stats_of(data, off))
            x = features_of(data, off, r).astype(np.float16)
            yield pa.RecordBatch.from_arrays([T.column(b, "doc_id"), pa.array(votes_of(r)), pa.array([q.tobytes() for q in x], pa.binary())], names=["doc_id", "pattern", "x"])

    # repeated rows go each by its own place, so that they are thinned like all others
    every = -(-int(got["n"].sum()) // fit_rows) or 1
    d = d.withColumn("place", F.monotonically_increasing_id())
    s = d.where(F.pmod(F.xxhash64("doc_id", "place"), F.lit(every)) == 0).drop("place").mapInArrow(rows, "doc_id long, pattern long, x binary").toPandas().sort_values(["doc_id", "pattern"], kind="stable")
    x = np.frombuffer(b"".join(s["x"]), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
    w, bias = fit_scorer(x, model.posterior(s["pattern"].to_numpy(np.int64)))
    return model, w, bias


def _probabilities(data: np.ndarray, off: np.ndarray, r: np.ndarray, w: np.ndarray, bias: float) -> np.ndarray:
    n = len(off) - 1
    p = np.empty(n)
    for lo in range(0, n, 512):
        hi = min(lo + 512, n)
        x = features_of(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], r[lo:hi])
        p[lo:hi] = 1 / (1 + np.exp(-np.clip(x @ w + bias, -50, 50)))
    return p


def score(docs: DataFrame, model: LabelModel, w: np.ndarray, bias: float) -> DataFrame:
    """``doc_id``, ``weak_bad`` (posterior of the votes), ``bad_score`` (the scorer's
    probability that the text is bad) and ``kept`` (below one half)."""

    def run(batches):
        for b in T.blocks(batches):
            data, off = T.utf8(T.column(b, "text"))
            r = rates_of(stats_of(data, off))
            p = _probabilities(data, off, r, w, bias)
            yield pa.RecordBatch.from_arrays([T.column(b, "doc_id"), pa.array(model.posterior(votes_of(r))), pa.array(p), pa.array(p < 0.5)], names=["doc_id", "weak_bad", "bad_score", "kept"])

    return texts(docs).mapInArrow(run, "doc_id long, weak_bad double, bad_score double, kept boolean")


def classify(docs: DataFrame) -> DataFrame:
    return score(docs, *train(docs))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows, all columns, whose ``text`` the scorer keeps."""
    model, w, bias = train(docs)

    def run(batches):
        for b in T.blocks(batches):
            data, off = T.utf8(T.column(b, "text"))
            yield b.filter(pa.array(_probabilities(data, off, rates_of(stats_of(data, off)), w, bias) < 0.5))

    return docs.mapInArrow(run, docs.schema)
