"""Hidden Markov language model: Baum-Welch over the corpus, exact forward scores.

A text is its words (A-Z lowered) and one end token.  Hidden states emit
classes: each of the most frequent words is a class of its own, the other
words share classes by their endings, and a class gives its words by their
add-one counts, one share kept for words never seen.  State parameters thus
have a fixed size, while the counts under them are those of every training
token and grow with the corpus.

Baum-Welch starts from a fit to a bounded sample (a starting point only);
then every training text takes part in each round, its expected counts summed
across partitions.  A score is the exact likelihood of the sequence by the
scaled forward recursion, in log10.

Null and empty texts are the end token alone.  Without any training text all
counts are zero and the score equals that of a model that knows no word.
Rows with a null or repeated id are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import small_batches, written

#: The end token's hash: that of no bytes.
END = T.hash_spans(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))[0]
STATES = 12
#: Words whose counts every task holds, at most (12 bytes each); the counts of all others are joined.
HEAD = 1 << 18
#: Of these, words with a class of their own; and classes of the other words.
OWN, SHARED = 61_000, 4_000
#: Full rounds of Baum-Welch over all training texts; texts of the starting fit, and its rounds.
ROUNDS, START_TEXTS, START_ROUNDS = 2, 2_000, 8
SEGMENT = 128


def tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with ends, each one's shared class, and the texts' offsets."""
    data, off = T.utf8(T.column(b, "text"))
    data = T.LOWER[data]
    h, doc, s, e = T.words(data, off)
    ending = T.hash_spans(data, np.maximum(s, e - 3), e)
    cls = (ending % np.uint64(SHARED)).astype(np.int64)
    n = b.num_rows
    count = np.bincount(doc, minlength=n)
    at = np.concatenate([[0], np.cumsum(count + 1)])
    tok, c = np.full(at[-1], END, np.uint64), np.zeros(at[-1], np.int64)
    place = np.arange(len(h)) + doc
    tok[place], c[place] = h, cls
    return tok, c, at


def count_tokens(docs: DataFrame) -> DataFrame:
    """``token, cls, n`` over all rows; each task adds up what it can before it sends."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def merged():
            t, c, n = (np.concatenate(x) for x in zip(*held, strict=True))
            u, first, inv = np.unique(t, return_index=True, return_inverse=True)
            return u, c[first], np.bincount(inv, n, len(u)).astype(np.int64)

        def out():
            u, c, n = merged()
            for lo in range(0, len(u), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(u[lo:lo + 100_000].view(np.int64)), pa.array(c[lo:lo + 100_000]), pa.array(n[lo:lo + 100_000])], names=["token", "cls", "n"])

        for b in T.blocks(batches):
            tok, cls, _ = tokens(b)
            u, first, n = np.unique(tok, return_index=True, return_counts=True)
            held.append((u, cls[first], n))
            rows += len(u)
            if rows > 2_000_000:
                held = [merged()]
                rows = len(held[0][0])
                if rows > 1_000_000:
                    yield from out()
                    held, rows = [], 0
        if held:
            yield from out()

    return docs.mapInArrow(run, "token long, cls long, n long").groupBy("token", "cls").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the head words, and the sums over shared classes."""
    head: np.ndarray      # sorted hashes
    count: np.ndarray     # their counts
    own: np.ndarray       # their class, or -1: a shared one
    n_own: int
    tokens: int           # N
    words: int            # V
    shared_tokens: np.ndarray
    shared_words: np.ndarray
    class_counts: np.ndarray

    @property
    def classes(self) -> int:
        return self.n_own + SHARED

    def look_up(self, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the head (or 0) and whether it is there."""
        if not len(self.head):
            return np.zeros(len(tok), np.int64), np.zeros(len(tok), bool)
        i = np.minimum(np.searchsorted(self.head, tok), len(self.head) - 1)
        return i, self.head[i] == tok

    def encode(self, tok: np.ndarray, cls: np.ndarray) -> np.ndarray:
        i, there = self.look_up(tok)
        own = np.where(there, self.own[i], -1) if len(self.head) else np.full(len(tok), -1)
        return np.where(own >= 0, own, self.n_own + cls)


def _level() -> Column:
    return F.floor(F.log2("n") * 32).cast("int")


def vocabulary(counts: DataFrame, head: int = HEAD, own: int = OWN) -> Vocabulary:
    """Built from the counts: the driver gets the head (at most ``head`` rows) and sums only."""
    levels = counts.groupBy(_level().alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).toPandas().sort_values("level", ascending=False)  # at most 32 rows for each power of 2
    fits = levels["words"].cumsum()
    least = levels.loc[fits <= head, "level"].min() if (fits <= head).any() else np.inf
    top = counts.where(_level() >= F.lit(int(least))).select("token", "cls", "n").toPandas() if np.isfinite(least) else pd.DataFrame({"token": [], "cls": [], "n": []}, dtype=np.int64)
    least_own = levels.loc[fits <= own, "level"].min() if (fits <= own).any() else np.inf
    hashes = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    n = top["n"].to_numpy(np.int64)[order]
    is_own = np.floor(np.log2(np.maximum(n, 1)) * 32) >= least_own
    own_cls = np.where(is_own, np.cumsum(is_own) - 1, -1)
    shared = counts.where(_level() < F.lit(int(least_own))) if np.isfinite(least_own) else counts
    s = shared.groupBy("cls").agg(F.count("*").alias("words"), F.sum("n").alias("n")).toPandas()  # SHARED rows at most
    st, sw = np.zeros(SHARED, np.int64), np.zeros(SHARED, np.int64)
    st[s["cls"].to_numpy(np.int64)], sw[s["cls"].to_numpy(np.int64)] = s["n"], s["words"]
    n_own = int(is_own.sum())
    return Vocabulary(hashes[order], n, own_cls, n_own, int(levels["n"].sum()), int(levels["words"].sum()), st, sw, np.concatenate([n[is_own], st]))


@dataclass
class Model:
    start: np.ndarray     # K
    step: np.ndarray      # K x K
    emit: np.ndarray      # classes x K

    @property
    def states(self) -> int:
        return len(self.start)


def _pieces(off: np.ndarray, size: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and whether it opens a text, of the runs that are stepped through
    side by side; the longest first."""
    lens = np.diff(off)
    if size is None:
        s, e, first = off[:-1], off[1:], np.ones(len(lens), bool)
    else:
        k = -(-lens // size)
        pos, local = T.gather(np.zeros(len(lens), np.int64), k)
        s = np.repeat(off[:-1], k) + local * size
        e = np.minimum(s + size, np.repeat(off[1:], k))
        first = local == 0
    order = np.argsort(s - e, kind="stable")
    return s[order], e[order], first[order]


def forward_log10(m: Model, cls: np.ndarray, off: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence of classes, by the scaled forward recursion."""
    s, e, _ = _pieces(off, None)
    lens = e - s
    total = np.zeros(len(s))
    alpha = np.tile(m.start, (len(s), 1))
    active = np.searchsorted(-lens, -np.arange(1, (lens[0] if len(lens) else 0) + 1), "right")
    for t, a in enumerate(active):
        alpha = alpha[:a] if t == 0 else alpha[:a] @ m.step
        alpha = alpha * m.emit[cls[s[:a] + t]]
        c = alpha.sum(axis=1)
        total[:a] += np.log10(c)
        alpha /= c[:, None]
    out = np.zeros(len(s))
    out[np.argsort(off[:-1] - off[1:], kind="stable")] = total
    return out


def expected_counts(m: Model, cls: np.ndarray, off: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Forward-backward over runs of at most ``size`` tokens: expected starts, steps,
    and the state shares of every token; and the log-likelihood of the runs."""
    s, e, first = _pieces(off, size)
    k, lens = m.states, e - s
    alpha = np.zeros((len(cls), k), np.float32)
    scale = np.ones(len(cls), np.float32)
    rest = np.linalg.matrix_power(m.step, 64)[0]  # a run inside a text starts in the long-run mix
    a = np.where(first[:, None], m.start, rest)
    active = np.searchsorted(-lens, -np.arange(1, (lens[0] if len(lens) else 0) + 1), "right")
    for t, n in enumerate(active):
        at = s[:n] + t
        a = (a[:n] if t == 0 else a[:n] @ m.step) * m.emit[cls[at]]
        c = a.sum(axis=1)
        a = a / c[:, None]
        alpha[at], scale[at] = a, c
    steps = np.zeros((k, k))
    beta = np.ones((len(s), k))
    for t in range(len(active) - 1, 0, -1):
        n = active[t]
        at = s[:n] + t
        back = m.emit[cls[at]] * beta[:n] / scale[at][:, None]
        alpha[at] *= beta[:n]
        steps += alpha[at - 1].T @ back
        beta[:n] = back @ m.step.T
    at = s
    alpha[at] *= beta
    return alpha[s[first]].sum(axis=0), steps * m.step, alpha, float(np.log(scale).sum())


def estimate(start: np.ndarray, steps: np.ndarray, emit: np.ndarray, prior: np.ndarray) -> Model:
    """Parameters from expected counts, smoothed to the class shares ``prior``."""
    k = len(start)
    step = steps + 0.1
    weight = 200.0
    e = emit + weight * prior[:, None]
    return Model((start + 0.1) / (start + 0.1).sum(), step / step.sum(axis=1, keepdims=True), e / (emit.sum(axis=0) + weight))


def _by_class(cls: np.ndarray, share: np.ndarray, classes: int) -> np.ndarray:
    return np.stack([np.bincount(cls, share[:, j], classes) for j in range(share.shape[1])], axis=1)


def starting_model(texts_cls: list[np.ndarray], prior: np.ndarray, states: int, rounds: int, seed: int = 5) -> Model:
    """A first model from a few texts: grouped by a mixture of word shares, one state
    a group, then Baum-Welch on these texts."""
    classes = len(prior)
    rng = np.random.default_rng(seed)
    if not texts_cls:
        return Model(np.full(states, 1 / states), np.full((states, states), 1 / states), np.tile(prior[:, None], (1, states)))
    cls = np.concatenate(texts_cls)
    off = np.concatenate([[0], np.cumsum([len(x) for x in texts_cls])])
    doc = np.repeat(np.arange(len(texts_cls)), np.diff(off))
    share = rng.dirichlet(np.full(states, 0.3), len(texts_cls))
    for _ in range(12):
        e = _by_class(cls, share[doc], classes) + 50.0 * prior[:, None]
        lp = np.log(e / e.sum(axis=0))
        at = np.add.reduceat(lp[cls], off[:-1], axis=0) * 0.2 + np.log(share.sum(axis=0) + 1)
        share = np.exp(at - at.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
    stay = np.full((states, states), 0.2 / max(1, states - 1))
    np.fill_diagonal(stay, 0.8)
    m = estimate(share.sum(axis=0), stay * 1e6, _by_class(cls, share[doc], classes), prior)
    for _ in range(rounds):
        start, steps, gamma, _ = expected_counts(m, cls, off)
        m = estimate(start, steps, _by_class(cls, gamma, classes), prior)
    return m


def encode(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """Each row's classes, sums over its head words, and the words whose counts are to be joined."""

    def run(batches):
        for b in T.blocks(batches):
            tok, cls, at = tokens(b)
            i, there = v.look_up(tok)
            ids = v.encode(tok, cls)
            n = np.where(there, v.count[i], 0) if len(v.head) else np.zeros(len(tok), np.int64)
            doc = np.repeat(np.arange(b.num_rows), np.diff(at))
            known = np.bincount(doc, there, b.num_rows).astype(np.int64)
            logs = np.bincount(doc, np.log10(n + 1.0), b.num_rows)
            far = ~there
            order = np.lexsort((tok[far], doc[far]))
            ft, fd = tok[far][order], doc[far][order]
            new = np.ones(len(ft), bool)
            new[1:] = (ft[1:] != ft[:-1]) | (fd[1:] != fd[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(ft)))
            cut = np.searchsorted(fd[first], np.arange(b.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(ft[first].view(np.int64)), pa.array(times.astype(np.int32))], ["token", "times"]))
            u16 = ids.astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [T.column(b, "doc_id"), T.column(b, "held_out"), pa.array([u16[at[k]:at[k + 1]].tobytes() for k in range(b.num_rows)], pa.binary()), pa.array(known), pa.array(logs), lists],
                names=["doc_id", "held_out", "classes", "known", "logs", "far"])

    if v.classes > 1 << 16:
        raise ValueError("classes are held in 16 bits")
    out = docs.mapInArrow(run, "doc_id long, held_out boolean, classes binary, known long, logs double, far array<struct<token: long, times: int>>")
    return written(out.withColumn("row", F.monotonically_increasing_id()), "hmm-encoded")


def _sequences(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in (c.as_buffer() for c in col)], np.int64) // 2
    off = np.concatenate([[0], np.cumsum(size)])
    return np.frombuffer(b"".join(c.as_py() for c in col), "<u2").astype(np.int64), off


def _gathered(batches, name: str, most: int):
    """Rows gathered until a column holds ``most`` bytes."""
    held, size = [], 0
    for b in T.blocks(batches, name, most):
        held.append(b)
        size += T.column(b, name).nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def baum_welch_round(encoded: DataFrame, m: Model, prior: np.ndarray) -> Model:
    """One round over all training rows; expected counts add up across partitions."""
    k, classes = m.states, len(prior)
    fields = ", ".join(f"x{j} float" for j in range(k))

    def run(batches):
        start, steps, emit = np.zeros(k), np.zeros((k, k)), np.zeros((classes, k))
        for b in _gathered(batches, "classes", 1 << 20):
            cls, off = _sequences(T.column(b, "classes"))
            a, s, gamma, _ = expected_counts(m, cls, off)
            start, steps = start + a, steps + s
            emit += _by_class(cls, gamma, classes)
        # rows: -1 the starts, -2-i the steps from state i, else a class
        seen = np.flatnonzero(emit.any(axis=1))
        key = np.concatenate([[-1], -2 - np.arange(k), seen])
        val = np.concatenate([start[None], steps, emit[seen]]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(val[:, j]) for j in range(k))], names=["key", *(f"x{j}" for j in range(k))])

    sums = encoded.where("not held_out").select("classes").mapInArrow(run, f"key long, {fields}").groupBy("key").agg(*(F.sum(f"x{j}").alias(f"x{j}") for j in range(k)))
    got = sums.toPandas()  # at most `classes` + K + 1 rows
    key, val = got["key"].to_numpy(np.int64), got.drop(columns="key").to_numpy(float)
    start, steps, emit = np.zeros(k), np.zeros((k, k)), np.zeros((classes, k))
    start[:] = val[key == -1].sum(axis=0)
    neg = key < -1
    steps[-2 - key[neg]] = val[neg]
    emit[key[key >= 0]] = val[key >= 0]
    return estimate(start, steps, emit, prior)


def train(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[Vocabulary, Model, DataFrame, DataFrame]:
    """Vocabulary, model, counts and encoded rows of ``docs`` (``doc_id, text, held_out``)."""
    with small_batches(docs.sparkSession):  # whole texts
        counts = written(count_tokens(docs.where("not held_out")), "hmm-counts")
    v = vocabulary(counts)
    prior = (v.class_counts + 1.0) / (v.class_counts.sum() + v.classes)
    with small_batches(docs.sparkSession):
        enc = encode(docs, v)
    n_texts = counts.where(F.col("token") == F.lit(int(END.astype(np.int64)))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    few = enc.where("not held_out").where(F.pmod(F.xxhash64("row"), F.lit(-(-n_texts // START_TEXTS) or 1)) == 0).select("classes").orderBy("classes")
    first = [np.frombuffer(r, "<u2").astype(np.int64) for r in few.toPandas()["classes"]]
    m = starting_model(first, prior, states, START_ROUNDS)
    for _ in range(rounds if first else 0):
        m = baum_welch_round(enc, m, prior)
    return v, m, counts, enc


def score(docs: DataFrame, held_out: Column, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("held_out", held_out)
    v, m, counts, enc = train(d, states, rounds)
    n_own, st, sw = v.n_own, v.shared_tokens, v.shared_words
    class_log = np.concatenate([np.log10(v.class_counts[:n_own] + 1.0), np.log10(st + sw + 1.0)])

    def run(batches):
        for b in _gathered(batches, "classes", 8 << 20):
            cls, off = _sequences(T.column(b, "classes"))
            doc = np.repeat(np.arange(b.num_rows), np.diff(off))
            # a word within its class: its count and one, over those of the class
            inside = -np.bincount(doc, class_log[cls], b.num_rows)
            yield pa.RecordBatch.from_arrays([*(T.column(b, c) for c in ("row", "doc_id", "held_out")), pa.array(np.diff(off)), T.column(b, "known"), T.column(b, "logs"),
                                              pa.array(forward_log10(m, cls, off) + inside)], names=["row", "doc_id", "held_out", "n_tokens", "known", "logs", "path"])

    near = enc.select("row", "doc_id", "held_out", "classes", "known", "logs").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, path double")
    # words outside the head are rare one by one, so this join has no hot key
    asked = enc.select("row", F.inline("far"))
    far = asked.join(counts.select("token", "n"), "token").groupBy("row").agg(F.sum("times").alias("far_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("far_logs"))
    r = near.join(far, "row", "left")
    logs = F.col("logs") + F.coalesce("far_logs", F.lit(0.0))
    return r.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("far_known", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
                    (logs - F.col("n_tokens") * F.lit(float(np.log10(v.tokens + v.words + 1.0)))).alias("base_score"), (F.col("path") + logs).alias("score"))
