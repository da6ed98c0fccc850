"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer reads words: insults are words, or beginnings of words,
learned from labelled texts; threats, targets, negations and verbs of reported
speech are word lists below.  Three small transducers rewrite what it emits:
negation turns an insult or threat that closely follows into its negated form,
reported speech into its reported form, a target in the clause into its aimed
form.  Their composition is one table; a clause that holds an insult or threat
is run through it, and each matched form has a weight: a belief (a negated or
reported insult and an unaimed threat say nothing) moved by the labels of the
texts in which the form occurs.  The clauses of a text add up to its score.

Null, empty and unmatched texts get the score of a text without matches.
Labels are read in training only; a text's score depends on its words alone.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import texts
from .rules import labelled_sample

#: Labelled rows that the lexicon and weights are learned from, about, if there are more.
LABELLED = 20_000
#: Candidate patterns kept for the covering step, at most.
CANDIDATES = 20_000
#: Code points of the word beginnings that may become patterns.
PREFIXES = (4, 5, 6)

# Fixed word lists.
THREATS = ("kill", "hurt", "destroy", "murder", "stab", "shoot", "töten", "umbringen", "verletzen", "tuer", "tuerai", "frapper", "détruire", "matar", "mataré", "golpear", "destruir")
TARGETS = ("you", "your", "yours", "you're", "they", "them", "he", "she", "him", "her", "du", "dich", "dir", "dein", "ihr", "sie", "tu", "toi", "te", "vous", "ton", "votre", "ils", "usted", "ustedes", "tú", "ti", "ellos")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "wasn't", "don't", "won't", "nicht", "kein", "keine", "nie", "pas", "jamais", "aucun", "nunca", "jamás", "ningún")
REPORTS = ("said", "says", "wrote", "writes", "called", "quoted", "reported", "claimed", "sagte", "sagt", "schrieb", "nannte", "berichtete", "dit", "écrit", "déclaré", "dijo", "dice", "escribió", "llamó")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Marks that transducers set on an insult or threat.
NEGATED, REPORTED, AIMED = 8, 16, 32


class Transducer:
    """Deterministic, with an output symbol on each step: ``steps[state][symbol] = (state, output)``;
    a symbol without a step is passed on and the state falls back to ``idle[state]``."""

    def __init__(self, steps: dict, idle: dict):
        self.steps, self.idle = steps, idle

    def step(self, state, symbol):
        return self.steps[state].get(symbol, (self.idle[state], symbol))

    def then(self, other: Transducer, symbols) -> Transducer:
        """The composition: what this one emits, the other reads."""
        steps: dict = defaultdict(dict)
        todo, seen = [(0, 0)], {(0, 0): 0}
        while todo:
            a, b = todo.pop()
            for s in symbols:
                na, mid = self.step(a, s)
                nb, out = other.step(b, mid)
                if (na, nb) not in seen:
                    seen[na, nb] = len(seen)
                    todo.append((na, nb))
                steps[seen[a, b]][s] = (seen[na, nb], out)
        return Transducer(dict(steps), dict.fromkeys(steps, 0))


def _marks(symbols, mark: int) -> dict:
    return {s: s | mark for s in symbols}


def grammar() -> Transducer:
    """Negation (which reaches four words on), reported speech and target (which reach
    to the clause's end; a threat also takes a target up to four words later), composed."""
    base = [OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT]
    hits = [INSULT, THREAT]
    reach = 4
    neg: dict = {0: {NEGATION: (reach, NEGATION)}}
    for k in range(1, reach + 1):
        neg[k] = {NEGATION: (reach, NEGATION), **{h: (k - 1, h | NEGATED) for h in hits}}
    negation = Transducer(neg, {k: max(0, k - 1) for k in neg})
    some = [h | m for h in hits for m in (0, NEGATED)]
    report = Transducer({0: {REPORT: (1, REPORT)}, 1: {h: (1, h | REPORTED) for h in some}}, {0: 0, 1: 1})
    some = [h | r for h in some for r in (0, REPORTED)]
    # before any target, a threat waits up to four words for the one it is aimed at ("kill you")
    wait = {(f, k): 1 + i for i, (f, k) in enumerate((f, k) for f in some if f & 7 == THREAT for k in range(1, reach + 1))}
    aimed = 1 + len(wait)
    after = {f: (wait[f, reach], f) for f in some if f & 7 == THREAT}
    steps: dict = {0: {TARGET: (aimed, TARGET), **after}, aimed: {h: (aimed, h | AIMED) for h in some}}
    idle = {0: 0, aimed: aimed}
    for (f, k), state in wait.items():
        steps[state] = {TARGET: (aimed, f | AIMED), **after}
        idle[state] = wait.get((f, k - 1), 0)
    target = Transducer(steps, idle)
    return negation.then(report, base).then(target, base)


FORMS = [h | n | r | a for h in (INSULT, THREAT) for n in (0, NEGATED) for r in (0, REPORTED) for a in (0, AIMED)]
PLACE = {f: i for i, f in enumerate(FORMS)}


@dataclass
class Grammar:
    """What training yields: weights of words, beginnings and matched forms, and a logistic on their sum."""
    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    forms: dict[int, float] = field(default_factory=dict)
    slope: float = 1.0
    bias: float = -3.0

    def lexicon(self) -> tuple[np.ndarray, dict[str, int]]:
        """Hashes of all words and beginnings that open a clause's analysis, sorted."""
        hits = [*self.words, *self.prefixes, *THREATS]
        col = pa.array(hits, pa.string())
        data, off = T.utf8(col)
        return np.unique(T.hash_spans(data, off[:-1], off[1:])) if hits else np.zeros(0, np.uint64), {w: c for c, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in ws}


_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), 39, *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?;:\n")] = True


def letter_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters (and apostrophes) of lower-cased texts: start, end, document."""
    return _runs(_LETTER[data], off)


def _runs(on: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(on)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first, last = on.copy(), on.copy()
    first[1:] &= ~on[:-1] | edge[1:n]
    last[:-1] &= ~on[1:] | edge[1:n]
    s = np.flatnonzero(first)
    return s, np.flatnonzero(last) + 1, np.searchsorted(off, s, "right") - 1


def prefix_ends(data: np.ndarray, s: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """End of the first ``k`` code points of each word, or -1 where it has no more than ``k``."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(lead, s) + k
    end = lead[np.minimum(at, len(lead) - 1)] if len(lead) else s
    return np.where((at < len(lead)) & (end < e), end, -1)


def lowered(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return T.utf8(pc.utf8_lower(pc.fill_null(T.column(b, "text").cast(pa.large_string()), "")))


def _is_in(h: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(h), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, h), len(sorted_set) - 1)] == h


class Reader:
    """Finds the clauses that hold a hit, and runs them through the grammar."""

    def __init__(self, g: Grammar):
        self.g, self.table = g, grammar()
        self.hits, self.lists = g.lexicon()

    def symbol(self, word: str) -> tuple[int, float]:
        if word in self.g.words:
            return INSULT, self.g.words[word]
        for k in PREFIXES:
            if len(word) > k and word[:k] in self.g.prefixes:
                return INSULT, self.g.prefixes[word[:k]]
        return self.lists.get(word, OTHER), 0.0

    def clauses(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, list[tuple[int, float]]]]:
        """``(document, matches)`` of each clause with a hit; a match is a form and a word's weight."""
        s, e, doc = letter_words(data, off)
        if not len(s) or not len(self.hits):
            return []
        hit = _is_in(T.hash_spans(data, s, e), self.hits)
        if self.g.prefixes:
            for k in PREFIXES:
                pe = prefix_ends(data, s, e, k)
                some = np.flatnonzero(pe >= 0)
                hit[some] |= _is_in(T.hash_spans(data, s[some], pe[some]), self.hits)
        stops = np.flatnonzero(_STOP[data])
        clause = np.searchsorted(stops, s[hit])
        d = doc[hit]
        new = np.ones(len(d), bool)
        new[1:] = (clause[1:] != clause[:-1]) | (d[1:] != d[:-1])
        out = []
        for c, i in zip(clause[new], d[new], strict=True):
            lo = max(int(off[i]), int(stops[c - 1]) + 1 if c else 0)
            hi = min(int(off[i + 1]), int(stops[c]) if c < len(stops) else len(data))
            a, z = np.searchsorted(s, [lo, hi])
            state, found = 0, []
            for k in range(a, z):
                sym, weight = self.symbol(data[s[k]:e[k]].tobytes().decode("utf-8", "replace"))
                state, form = self.table.step(state, sym)
                if form & 7 in (INSULT, THREAT):
                    found.append((form, weight))
            if found:
                out.append((int(i), found))
        return out

    def sums(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Each document's sum over clauses of its strongest match."""
        out = np.zeros(len(off) - 1)
        for i, found in self.clauses(data, off):
            out[i] += self.worth(found)
        return out

    def strongest(self, found: list[tuple[int, float]]) -> tuple[int, float]:
        """The match of largest weight in a clause, ties by form."""
        return max(found, key=lambda m: (m[1] + self.g.forms.get(m[0], 0.0), m))

    def worth(self, found: list[tuple[int, float]]) -> float:
        f, w = self.strongest(found)
        return max(0.0, w + self.g.forms.get(f, 0.0))

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.g.slope * self.sums(data, off) + self.g.bias, -50, 50)))


def _candidates(sample: DataFrame) -> tuple[list[tuple[str, str, int, int]], int, int]:
    """Words and beginnings by the number of distinct toxic and other texts that hold them."""

    def run(batches):
        held: dict[tuple[str, str], list[int]] = {}
        for b in T.blocks(batches):
            label = T.column(b, "label").to_pylist()
            for text, y in zip(T.column(b, "text").to_pylist(), label, strict=True):
                words = _text_words(text)
                keys = {("w", w) for w in words if len(w) > 1} | {("p", w[:k]) for w in words for k in PREFIXES if len(w) > k}
                for key in keys:
                    held.setdefault(key, [0, 0])[y] += 1
            if len(held) > 300_000:
                yield _counts(held)
                held = {}
        yield _counts(held)

    def _counts(held):
        k = list(held)
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in k], pa.string()), pa.array([x[1] for x in k], pa.string()), pa.array([held[x][1] for x in k], pa.int64()), pa.array([held[x][0] for x in k], pa.int64())],
                                          names=["kind", "pattern", "toxic", "clean"])

    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    t, c = n.get(1, 0), n.get(0, 0)
    if not t or not c:
        return [], t, c
    got = sample.mapInArrow(run, "kind string, pattern string, toxic long, clean long").groupBy("kind", "pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # far commoner among toxic texts than among others
    got = got.where((F.col("toxic") >= 2) & ((F.col("toxic") + 0.5) / (t + 1) >= 8 * (F.col("clean") + 0.5) / (c + 1)))
    top = got.orderBy(F.col("toxic").desc(), "clean", "kind", "pattern").limit(CANDIDATES).collect()
    return [(r["kind"], r["pattern"], r["toxic"], r["clean"]) for r in top], t, c


def _weight(toxic: int, clean: int, t: int, c: int) -> float:
    return float(np.log((toxic + 0.5) / (t + 1)) - np.log((clean + 0.5) / (c + 1)))


def _unlike(sample: DataFrame) -> DataFrame:
    """One text of each group of near copies with the same label, else the words of one
    much-copied text look like patterns.  Texts that share a MinHash minimum are compared
    with the one of least hash among them, on their full sets of five-word shingles; those
    at 0.8 or more go.  Three minima in turn leave few copies; texts that only share a
    passage stay."""

    def run(batches):
        mh = T.MinHash(3)
        for b in T.blocks(batches):
            h, doc, _, _ = T.words(*T.utf8(T.column(b, "text")))
            sh, d = T.shingles(h, doc, 5, b.num_rows)
            sig = mh.signatures(sh, d, b.num_rows).astype(np.int64)
            sets = [s.astype(np.int64) for s in T.sets(sh, d, b.num_rows)]
            yield pa.RecordBatch.from_arrays([T.column(b, "text"), T.column(b, "label"), *(pa.array(sig[:, i]) for i in range(3)), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["text", "label", "m0", "m1", "m2", "shingles"])

    out = sample.mapInArrow(run, "text string, label int, m0 long, m1 long, m2 long, shingles array<long>").withColumn("h", F.xxhash64("text"))
    for m in ("m0", "m1", "m2"):
        w = Window.partitionBy("label", m).orderBy("h", "text")
        first, both = F.col("first"), F.size(F.array_intersect("shingles", "first"))
        near = 5 * both >= 4 * (F.size("shingles") + F.size(first) - both)  # texts without words are all alike
        out = out.withColumns({"first": F.first("shingles").over(w), "place": F.row_number().over(w)}).where((F.col("place") == 1) | ~near).drop("first", "place")
    return out.select("text", "label")


def _text_words(text: str) -> set[str]:
    data, off = T.utf8(pa.array([text.lower()], pa.string()))
    s, e, _ = letter_words(data, off)
    return {data[a:z].tobytes().decode("utf-8", "replace") for a, z in zip(s, e, strict=True)}


def _held(sample: DataFrame, cand: list[tuple[str, str, int, int]]) -> dict[tuple[str, str], set[int]]:
    """The toxic texts of the sample that hold each candidate, by number; texts stay in the tasks."""
    number = {(k, p): i for i, (k, p, _, _) in enumerate(cand)}

    def run(batches):
        for b in T.blocks(batches):
            found = []
            for text in T.column(b, "text").to_pylist():
                words = _text_words(text)
                keys = {("w", w) for w in words} | {("p", w[:k]) for w in words for k in PREFIXES if len(w) > k}
                found.append(sorted(number[k] for k in keys if k in number))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["held"])

    where: dict[tuple[str, str], set[int]] = {(k, p): set() for k, p, _, _ in cand}
    for i, row in enumerate(sample.where("label = 1").mapInArrow(run, "held array<int>").collect()):
        for j in row["held"]:
            where[cand[j][:2]].add(i)
    return where


def train(docs: DataFrame, labels: DataFrame, fold: Column | None = None, most: int = LABELLED) -> Grammar:
    """Learn the lexicon and weights from a bounded sample of labelled texts (``labels.toxic``);
    ``fold`` says which labels may be used, by ``l_id``."""
    from .common import written

    sample = written(_unlike(labelled_sample(docs, labels, "toxic", most, fold)), "toxic-sample")
    cand, t, c = _candidates(sample)
    g = Grammar()
    if not cand:
        g.bias = float(np.log((t + 0.5) / (c + 0.5))) if t + c else -3.0
        return g

    # greedy covering of the toxic texts of the sample, a bounded number
    where = _held(sample, cand)
    info = {(k, p): (x, y, _weight(x, y, t, c)) for k, p, x, y in cand}
    live = dict(where)
    covered: set[int] = set()
    while live:
        # gain: texts newly covered, less what clean texts would be caught for them
        def gain(key):
            x, y, w = info[key]
            return (len(live[key]) - 5.0 * y * t / max(c, 1), w, x, key[0] == "w", key[1])  # noqa: B023

        best = max(live, key=gain)
        if gain(best)[0] < 2:
            break
        (g.words if best[0] == "w" else g.prefixes)[best[1]] = info[best][2]
        covered |= live[best]
        live = {k: r for k, v in live.items() if (r := v - covered)}

    # patterns that covering had no need of, as texts often hold several, but that stand on their own
    enough = max(4, 0.015 * t)
    for kind, p, x, y in sorted(cand, key=lambda r: (-r[2], r[0] == "p", r[1])):
        known = any(p.startswith(q) and len(p) > len(q) or p == q for q in g.prefixes) or p in g.words or (kind == "p" and any(q.startswith(p) for q in (*g.words, *g.prefixes)))
        if x >= enough and info[kind, p][2] >= 3.0 and y <= 0.02 * x and not known:
            (g.words if kind == "w" else g.prefixes)[p] = info[kind, p][2]

    g.forms = beliefs(g)

    # per text: how many clauses have their strongest match in each form, and the words' weights in those
    def matched(batches):
        reader = Reader(g)
        for b in T.blocks(batches):
            count, weight = np.zeros((b.num_rows, len(FORMS))), np.zeros((b.num_rows, len(FORMS)))
            for i, found in reader.clauses(*lowered(b)):
                f, w = reader.strongest(found)
                count[i, PLACE[f]] += 1
                weight[i, PLACE[f]] += w
            yield pa.RecordBatch.from_arrays([T.column(b, "label"), pa.array(list(count), pa.list_(pa.float64())), pa.array(list(weight), pa.list_(pa.float64()))], names=["y", "count", "weight"])

    got = sample.mapInArrow(matched, "y int, count array<double>, weight array<double>").toPandas()
    got = got.iloc[np.lexsort([got["weight"].map(sum), got["count"].map(sum), got["y"]])]  # not the partitions' order
    fit_forms(g, got["y"].to_numpy(float), np.stack(got["count"].to_list()), np.stack(got["weight"].to_list()))
    return g


def beliefs(g: Grammar) -> dict[int, float]:
    """Form weights before any data.  A word's weight stands for an insult: its negated form
    is worth nothing, its reported form little, an aimed one more.  A threat word alone says
    nothing ("kill a process"); aimed at someone, it is worth a typical insult."""
    known = [*g.words.values(), *g.prefixes.values()]
    typical, heaviest = (float(np.median(known)), max(known)) if known else (0.0, 0.0)
    out = {}
    for f in FORMS:
        v = 0.5 if f & AIMED else 0.0
        if f & 7 == THREAT:
            v = typical if f & AIMED else 0.0
        out[f] = v + (-heaviest if f & NEGATED else 0.0) + (-0.9 * heaviest if f & REPORTED else 0.0)
    return out


def fit_forms(g: Grammar, y: np.ndarray, count: np.ndarray, weight: np.ndarray, spread: float = 1.0, rounds: int = 4) -> None:
    """Form weights, slope and bias by penalised likelihood of the labels, in turn.

    A text's evidence is the sum over forms of its clauses' word weights and form weights, a
    clause at least 0.  All forms of a text share in explaining its label, so a form that
    only accompanies others learns little; one that never occurs keeps its belief, and one
    that occurs moves as far as the labels say, up or down (``spread``: deviation of the belief).
    """
    prior = np.array([g.forms[f] for f in FORMS])
    v = prior.copy()

    def evidence(v):
        return np.maximum(weight + count * v, 0.0)

    for _ in range(rounds):
        x = evidence(v).sum(axis=1)
        g.slope, g.bias = _logistic(x, y)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(g.slope * evidence(v).sum(axis=1) + g.bias, -30, 30)))
            moves = g.slope * count * (weight + count * v > 0)
            grad = moves.T @ (p - y) + (v - prior) / spread**2
            hess = (moves * (p * (1 - p))[:, None]).T @ moves + np.eye(len(v)) / spread**2
            step = np.clip(np.linalg.solve(hess, grad), -1, 1)
            v = v - step
            if np.abs(step).max() < 1e-8:
                break
    g.forms = dict(zip(FORMS, map(float, v), strict=True))
    g.slope, g.bias = _logistic(evidence(v).sum(axis=1), y)


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.05, rounds: int = 50) -> tuple[float, float]:
    """A slope (not below a small one) and bias by damped Newton steps."""
    w = np.array([0.5, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))])
    z = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + l2 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + l2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.05)), float(w[1])


def score(docs: DataFrame, g: Grammar) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` and ``n_clauses`` (matched clauses)."""

    def run(batches):
        reader = Reader(g)
        for b in T.blocks(batches):
            data, off = lowered(b)
            found = reader.clauses(data, off)
            total, n = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            for i, m in found:
                total[i] += reader.worth(m)
                n[i] += 1
            p = 1 / (1 + np.exp(-np.clip(g.slope * total + g.bias, -50, 50)))
            yield pa.RecordBatch.from_arrays([T.column(b, "doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(n)], names=["doc_id", "score", "predicted", "n_clauses"])

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int, n_clauses long")


def keep_clean(docs: DataFrame, g: Grammar) -> DataFrame:
    """The rows, all columns, whose ``text`` scores below one half."""

    def run(batches):
        reader = Reader(g)
        for b in T.blocks(batches):
            yield b.filter(pa.array(reader.scores(*lowered(b)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
