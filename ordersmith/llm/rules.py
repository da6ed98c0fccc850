"""Text statistics, and quality rules as a learned decision list.

``text_stats`` measures whole texts.  ``learn`` grows and prunes threshold
conjunctions by sequential covering on labelled statistics; ``as_column``
turns the ordered rules into one Spark conditional expression.

Null and empty texts have all statistics 0.  Without labelled rows, or with
one class alone, the list is empty and its verdict is to keep.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import texts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "n_upper", "n_marks", "n_bars", "n_lines", "n_long")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True


def stats_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each document of a block."""
    n = len(offsets) - 1

    def per_doc(flag: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return c[offsets[1:]] - c[offsets[:-1]]

    h, doc, starts, ends = T.words(data, offsets)
    out = {"n_words": np.bincount(doc, minlength=n)}
    out["word_chars"] = per_doc(((data & 0xC0) != 0x80) & ~T.SPACE[data])
    out["n_symbols"] = per_doc(_SYMBOL[data])
    # lines: split at \n; a line counts if it has a word and equals an earlier one of its text
    nl = np.flatnonzero(data == 10)
    ls = np.sort(np.concatenate([offsets[:-1], nl + 1]), kind="stable") if n else np.zeros(0, np.int64)
    ldoc = np.sort(np.concatenate([np.arange(n), np.searchsorted(offsets, nl, "right") - 1])) if n else np.zeros(0, np.int64)
    stop = np.where(np.append(ldoc[1:] != ldoc[:-1], True), offsets[1:][ldoc], np.append(ls[1:], 0) - 1) if len(ls) else ls
    has = np.searchsorted(starts, stop) > np.searchsorted(starts, ls)
    ls, stop, ldoc = ls[has], stop[has], ldoc[has]
    lh = T.mix(T.hash_spans(data, ls, stop) + ldoc.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    _, first = np.unique(lh, return_index=True)
    dup = np.ones(len(lh), bool)
    dup[first] = False
    out["n_dup_lines"] = np.bincount(ldoc[dup], minlength=n)
    out["n_lines"] = np.bincount(ldoc, minlength=n)
    # words inside a five-word window that its text holds twice or more
    wh, at = T.windows(h, doc, 5)
    key = T.mix(wh + doc[at].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[cnt[inv] > 1]
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, np.minimum(twice + 5, len(h)), -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    out["n_bytes"] = np.diff(offsets)
    out["n_upper"] = per_doc(_UPPER[data])
    out["n_marks"] = per_doc(_MARK[data])
    out["n_bars"] = per_doc(data == ord("|"))
    out["n_long"] = np.bincount(doc[(ends - starts) > 20], minlength=n)
    return out


def text_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts, over whole texts."""

    def run(batches):
        for b in T.blocks(batches):
            s = stats_of(*T.utf8(T.column(b, "text")))
            yield pa.RecordBatch.from_arrays([T.column(b, "doc_id"), *(pa.array(s[c].astype(np.int64)) for c in COUNTS)], names=["doc_id", *COUNTS])

    return texts(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


#: Rates that rules may test: name, numerator, denominator.
RATES = (("symbols_per_word", "n_symbols", "n_words"), ("dup_line_rate", "n_dup_lines", "n_lines"), ("repeat_rate", "n_repeat_words", "n_words"),
         ("chars_per_word", "word_chars", "n_words"), ("upper_rate", "n_upper", "n_bytes"), ("marks_per_word", "n_marks", "n_words"),
         ("bars_per_word", "n_bars", "n_words"), ("long_rate", "n_long", "n_words"))
FEATURES = ("n_words", *(r[0] for r in RATES))


def feature_columns() -> dict[str, Column]:
    rate = {name: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)) for name, a, b in RATES}
    return {"n_words": F.col("n_words").cast("double"), **rate}


@dataclass
class Rule:
    """A conjunction of ``(feature, '>' or '<=', threshold)`` and its verdict."""
    verdict: int
    tests: list[tuple[str, str, float]] = field(default_factory=list)
    support: int = 0
    precision: float = 0.0

    def covers(self, x: np.ndarray) -> np.ndarray:
        m = np.ones(len(x), bool)
        for f, op, t in self.tests:
            v = x[:, FEATURES.index(f)]
            m &= v > t if op == ">" else v <= t
        return m


def _grow(x: np.ndarray, y: np.ndarray, most: int) -> list[tuple[str, str, float]]:
    """Add the test of largest information gain until no other class is covered."""
    tests, m = [], np.ones(len(x), bool)
    for _ in range(most):
        p0, n0 = int(y[m].sum()), int((1 - y[m]).sum())
        if not n0 or not p0:
            break
        best = (1e-9, None, None)
        for j, name in enumerate(FEATURES):
            v, t = x[m, j], y[m]
            order = np.argsort(v, kind="stable")
            vs, cp = v[order], np.cumsum(t[order])
            cut = np.flatnonzero(vs[1:] > vs[:-1])
            if not len(cut):
                continue
            mid = (vs[cut] + vs[cut + 1]) / 2
            for op, p, n in (("<=", cp[cut], cut + 1 - cp[cut]), (">", p0 - cp[cut], n0 - (cut + 1 - cp[cut]))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (name, op, float(mid[k])), None)
        if best[1] is None:
            break
        tests.append(best[1])
        m &= Rule(1, [best[1]]).covers(x)
    return tests


def learn(x: np.ndarray, y: np.ndarray, least_precision: float = 0.9, most_rules: int = 24, most_tests: int = 4, seed: int = 11) -> list[Rule]:
    """Ordered rules for class 1 of ``y``, then a default of 0, by sequential covering.

    Each round grows a rule on two thirds of the rows left and prunes it (its
    last tests first) on the other third; a rule stays if it is precise there.
    """
    rules: list[Rule] = []
    rng = np.random.default_rng(seed)
    left = np.arange(len(y))
    while len(rules) < most_rules and y[left].sum() >= 3 and (1 - y[left]).sum() >= 1:
        order = rng.permutation(left)
        cut = max(1, 2 * len(order) // 3)
        g, p = order[:cut], order[cut:] if len(order) - cut >= 1 else order
        tests = _grow(x[g], y[g], most_tests)
        if not tests:
            break

        def worth(k: int) -> tuple[float, int]:
            m = Rule(1, tests[:k]).covers(x[p])  # noqa: B023
            pos, neg = int(y[p][m].sum()), int(m.sum() - y[p][m].sum())  # noqa: B023
            return ((pos - neg) / max(1, pos + neg), -k)

        k = max(range(1, len(tests) + 1), key=worth)
        rule = Rule(1, tests[:k])
        m = rule.covers(x[left])
        rule.support, rule.precision = int(m.sum()), float(y[left][m].mean()) if m.any() else 0.0
        if rule.precision < least_precision or rule.support < 3:
            rule = Rule(1, tests)
            m = rule.covers(x[left])
            rule.support, rule.precision = int(m.sum()), float(y[left][m].mean()) if m.any() else 0.0
            if rule.precision < least_precision or rule.support < 3:
                break
        rules.append(rule)
        left = left[~m]
    return rules


def as_column(rules: list[Rule], features: dict[str, Column], default: int = 0) -> Column:
    """The first rule that covers a row gives its verdict."""
    out = None
    for r in rules:
        cond = F.lit(True)
        for f, op, t in r.tests:
            cond = cond & ((features[f] > F.lit(t)) if op == ">" else (features[f] <= F.lit(t)))
        out = F.when(cond, F.lit(r.verdict)) if out is None else out.when(cond, F.lit(r.verdict))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


#: Labelled rows that a list is learned from, about, if there are more.
LABELLED = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int = LABELLED, keep: Column | None = None) -> DataFrame:
    """Distinct texts with a label of 0 or 1: of all labelled ids, or of every k-th by hash
    so that about ``most`` are left.  An id labelled twice counts with its larger label.
    Repeated rows count once, and where one id stands on many texts the rows are thinned
    again by a hash of id and text, so that no table's repeats pass the bound."""
    lab = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col(label).cast("int").alias("label")).where("l_id is not null and label in (0, 1)")
    if keep is not None:
        lab = lab.where(keep)
    lab = lab.groupBy("l_id").agg(F.max("label").alias("label"))
    lab = lab.where(F.pmod(F.xxhash64("l_id"), F.lit(-(-lab.count() // most) or 1)) == 0)
    d = texts(docs)
    # about `most` ids of 12 bytes: small enough to send to every task
    rows = d.join(F.broadcast(lab), d["doc_id"] == lab["l_id"]).select("doc_id", "text", "label")
    rows = rows.withColumns({"h1": F.xxhash64("doc_id", "text"), "h2": F.xxhash64("text", "doc_id")})
    # only keys are shuffled to be counted; the texts of those that stay are then told apart
    n = rows.groupBy("h1", "h2").agg(F.lit(1).alias("one")).count()
    thin = rows.where(F.pmod(F.xxhash64("h1", "h2"), F.lit(-(-n // (2 * most)) or 1)) == 0) if n > 2 * most else rows
    return thin.groupBy("doc_id", "h1", "h2").agg(F.first("text").alias("text"), F.first("label").alias("label")).select("doc_id", "text", "label")


def learn_rules(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> list[Rule]:
    """Rules that reject (verdict 1), learned from ``labels.quality``."""
    s = labelled_sample(docs, labels, "quality", most)

    def run(batches):
        for b in T.blocks(batches):
            st = stats_of(*T.utf8(T.column(b, "text")))
            yield pa.RecordBatch.from_arrays([T.column(b, "doc_id"), T.column(b, "label"), *(pa.array(st[c].astype(np.int64)) for c in COUNTS)], names=["doc_id", "label", *COUNTS])

    st = s.mapInArrow(run, "doc_id long, label int, " + ", ".join(f"{c} long" for c in COUNTS))
    rows = st.select("doc_id", "label", *(c.alias(k) for k, c in feature_columns().items())).toPandas()
    if rows.empty:
        return []
    rows = rows.sort_values(["doc_id", *FEATURES], kind="stable")  # so that the split does not follow the partitions
    return learn(rows[list(FEATURES)].to_numpy(float), (rows["label"].to_numpy() == 0).astype(int))


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` (the base rules, then the list)."""
    st = text_stats(docs)
    return st.withColumns({"base_failed": base_failed(), "rejected": as_column(rules, feature_columns()) == 1}).withColumn("kept", ~F.col("base_failed") & ~F.col("rejected"))
