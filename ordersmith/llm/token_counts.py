"""Edit-aware token counts from segment trees over pre-tokens.

The tokenizer encodes each pre-token (contraction, letters, digit, signs)
alone, so a text's count is a sum over pre-tokens.  ``SegmentTree`` keeps these
sums in a binary tree over segments of pre-tokens.  An edit re-encodes only
the segments that it touches, plus one on each side for boundaries that may
move, and updates the sums on their paths to the root.

``keep`` writes every document's segments (lengths and counts, not texts) as a
table; ``edit`` joins a table of edits to it and re-encodes from there, and
``settled`` keeps the result for the next batch, so that no batch encodes more
than its edits touch.

Null and empty texts count 0; edits are clipped to the text.  Repeated rows share
a tree, rows of one id with other texts have their own.  A stretch without white
space is one segment, however long.  An empty table gives empty tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import texts, written

#: Characters of a segment, at least; it ends with the pre-token that reaches them.
SEGMENT = 512


class SegmentTree:
    """Segments of a text with their token counts, and sums over them by levels."""

    def __init__(self, parts: list[str], counts: np.ndarray, count: Callable[[list[str]], np.ndarray]):
        self.parts, self.count, self.encoded = parts, count, 0
        self._sum(np.asarray(counts, np.int64))

    def _sum(self, leaves: np.ndarray) -> None:
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            x = self.levels[-1]
            self.levels.append(np.add.reduceat(x, np.arange(0, len(x), 2)))

    @property
    def total(self) -> int:
        return int(self.levels[-1].sum())

    def _update(self, lo: int, counts: np.ndarray) -> None:
        """Leaves ``lo...`` get these counts; only the sums above them change."""
        self.levels[0][lo:lo + len(counts)] = counts
        hi = lo + len(counts)
        for below, level in zip(self.levels, self.levels[1:], strict=False):
            lo, hi = lo // 2, (hi + 1) // 2
            level[lo:hi] = np.add.reduceat(below[2 * lo:2 * hi], np.arange(0, len(below[2 * lo:2 * hi]), 2))

    def splice(self, start: int, stop: int, new: str) -> tuple[int, int, list[str]]:
        """Replace code points ``start`` to ``stop`` by ``new`` in the segments;
        which leaves the new segments stand for, still to be counted."""
        ends = np.cumsum([len(p) for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        size = int(ends[-1]) if len(ends) else 0
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        # one segment more on each side: a pre-token at the edge may grow into it, but not past it
        lo = max(0, int(np.searchsorted(ends, start, "left")) - 1)
        hi = min(len(self.parts), int(np.searchsorted(ends, stop, "right")) + 2)
        base = int(ends[lo - 1]) if lo else 0
        old = "".join(self.parts[lo:hi])
        fresh = segments(old[:start - base] + new + old[stop - base:])
        self.encoded += len(fresh)
        self.parts[lo:hi] = fresh
        return lo, hi, fresh

    def settle(self, lo: int, hi: int, counts: np.ndarray) -> None:
        """The counts of the segments that replaced leaves ``lo`` to ``hi``."""
        if len(counts) == hi - lo and len(counts):
            self._update(lo, counts)
        else:
            self._sum(np.concatenate([self.levels[0][:lo], counts, self.levels[0][hi:]]))

    def edit(self, start: int, stop: int, new: str) -> None:
        lo, hi, fresh = self.splice(start, stop, new)
        self.settle(lo, hi, self.count(fresh))

    @property
    def text(self) -> str:
        return "".join(self.parts)


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """The text in pieces of at least ``size`` characters (but for the last), cut
    just before white space.  No pre-token spans white space, so pieces are
    split and encoded alike whether alone or in the text."""
    out, lo = [], 0
    while len(text) - lo > size:
        hi = lo + size
        while hi < len(text) and text[hi] not in " \n\t\r\x0b\x0c":
            hi += 1
        if hi >= len(text):
            break
        out.append(text[lo:hi])
        lo = hi
    if lo < len(text):
        out.append(text[lo:])
    return out


KEY = ["k1", "k2"]
#: Bytes of trees and edits that may be sent to every task, at most (Spark's own default for broadcasts).
SENT_BYTES = 10 << 20

_TREES = "doc_id long, k1 long, k2 long, lengths array<int>, counts array<int>"
_ROWS = "doc_id long, k1 long, k2 long, text string, lengths array<int>, counts array<int>, n_tokens long, segments long, segments_encoded long"


@dataclass
class Kept:
    """Texts as they stand (``doc_id, k1, k2, text``) and one tree for each key: its segments'
    lengths and token counts in order, and on how many rows (``copies``) it stands.

    The key, hashes of the first id and text, stays through all edits; rows equal in
    both are one tree.
    """
    texts: DataFrame
    trees: DataFrame


def _counter(tokenizer: str) -> Callable[[list[str]], np.ndarray]:
    wp = T.word_pieces(tokenizer)
    return lambda parts: np.array([len(x) for x in wp.ids(parts)], np.int64) if parts else np.zeros(0, np.int64)


def keep(docs: DataFrame, tokenizer: str) -> Kept:
    """Encode every text once; its tree is written, without the text."""
    d = texts(docs).withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64("text", F.lit(1), "doc_id")})

    def run(batches):
        count = _counter(tokenizer)
        for b in T.blocks(batches):
            cut = [segments(x) for x in T.column(b, "text").to_pylist()]
            n = count([p for c in cut for p in c])  # the whole block's segments in one call
            at = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(int)
            yield pa.RecordBatch.from_arrays([T.column(b, "doc_id"), T.column(b, "k1"), T.column(b, "k2"), pa.array([[len(p) for p in c] for c in cut], pa.list_(pa.int32())),
                                              pa.array([n[a:z].tolist() for a, z in zip(at, at[1:], strict=False)], pa.list_(pa.int32()))], names=["doc_id", "k1", "k2", "lengths", "counts"])

    made = d.mapInArrow(run, _TREES)
    one = made.groupBy(*KEY).agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("lengths").alias("lengths"), F.first("counts").alias("counts"))
    return Kept(d, written(one, "token-trees"))


def by_id(kept: Kept, edits: DataFrame) -> DataFrame:
    """Edits given by ``doc_id`` (``doc_id, seq, start, stop, new``), by the keys of all trees of that id."""
    e = edits.select(F.col("doc_id").cast("long").alias("e_id"), "seq", "start", "stop", "new")
    return kept.trees.join(e, F.col("doc_id").eqNullSafe(F.col("e_id"))).select(*KEY, "seq", "start", "stop", "new")


def by_rule(kept: Kept, rule: Callable[[int | None, str], list[tuple[int, int, str]]]) -> DataFrame:
    """The edits table that ``rule(doc_id, text)`` lists for every text."""

    def run(batches):
        for b in T.blocks(batches):
            rows = [(k1, k2, i, *e) for doc, k1, k2, text in zip(*(T.column(b, c).to_pylist() for c in ("doc_id", "k1", "k2", "text")), strict=True) for i, e in enumerate(rule(doc, text))]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=[*KEY, "seq", "start", "stop", "new"])

    # rows of one key list the same edits
    return kept.texts.mapInArrow(run, "k1 long, k2 long, seq int, start long, stop long, new string").dropDuplicates([*KEY, "seq"])


def edit(kept: Kept, edits: DataFrame, tokenizer: str) -> DataFrame:
    """The rows that a table of edits (``k1, k2, seq, start, stop, new``) touches, one per row
    of their texts: new text, new tree, tokens before, segments before and re-encoded.

    A document's edits apply in order of ``seq``, each to what the ones before it left;
    their offsets are code points, clipped to the text.  Only segments that an edit touches
    and their neighbours are encoded.  Texts that no edit names are not read by Python.
    """
    listed = edits.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("seq", "start", "stop", "new"))).alias("edits"))
    work = written(kept.trees.join(listed, KEY).select(*KEY, "lengths", "counts", "edits"), "token-edits")
    size = work.agg(F.sum(F.size("lengths") * 8 + F.size("edits") * 48 + F.aggregate("edits", F.lit(64), lambda t, e: t + F.coalesce(F.octet_length(e["new"]), F.lit(0))))).first()[0]
    if (size or 0) <= SENT_BYTES:  # to every task; texts stay where they are
        met = kept.texts.join(F.broadcast(work), KEY).select("doc_id", *KEY, F.encode("text", "UTF-8").alias("packed"), F.lit(False).alias("z"), "lengths", "counts", "edits")
    else:  # both sides are dealt out by key, texts compressed, and the trees of a partition hashed
        met = _packed(kept.texts).join(work.hint("shuffle_hash"), KEY).select("doc_id", *KEY, "packed", F.lit(True).alias("z"), "lengths", "counts", "edits")

    def run(batches):
        count, unpack = _counter(tokenizer), zstandard.ZstdDecompressor().decompress
        for b in T.blocks(batches, "packed"):
            z, packed, lengths, counts = (T.column(b, c).to_pylist() for c in ("z", "packed", "lengths", "counts"))
            body = [(unpack(x) if y else x).decode("utf-8") for x, y in zip(packed, z, strict=True)]
            trees = []
            for text, size, n in zip(body, lengths, counts, strict=True):
                at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)]).astype(int)
                trees.append(SegmentTree([text[a:z] for a, z in zip(at, at[1:], strict=False)], np.array(n, np.int64), count))
            todo = [[(e["start"] or 0, e["stop"] or 0, e["new"] or "") for e in es] for es in T.column(b, "edits").to_pylist()]
            before, leaves = [t.total for t in trees], [len(t.parts) for t in trees]
            _edit_all(trees, todo, count)
            yield pa.RecordBatch.from_arrays(
                [*(T.column(b, c) for c in ("doc_id", *KEY)), pa.array([t.text for t in trees], pa.string()), pa.array([[len(p) for p in t.parts] for t in trees], pa.list_(pa.int32())),
                 pa.array([t.levels[0].tolist() for t in trees], pa.list_(pa.int32())), pa.array(before, pa.int64()), pa.array(leaves, pa.int64()), pa.array([t.encoded for t in trees], pa.int64())],
                names=["doc_id", *KEY, "text", "lengths", "counts", "n_tokens", "segments", "segments_encoded"])

    return met.mapInArrow(run, _ROWS)


def _packed(rows: DataFrame) -> DataFrame:
    """``doc_id, k1, k2`` and the text compressed."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in T.blocks(batches):
            z = [pack(x.encode("utf-8")) for x in T.column(b, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(T.column(b, c) for c in ("doc_id", *KEY)), pa.array(z, pa.binary())], names=["doc_id", *KEY, "packed"])

    return rows.select("doc_id", *KEY, "text").mapInArrow(run, "doc_id long, k1 long, k2 long, packed binary")


def _tokens(counts: str) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda t, n: t + n)


def settled(kept: Kept, rows: DataFrame) -> Kept:
    """What is kept after ``edit`` gave ``rows``: new texts and trees of those, the rest as it was."""
    done = written(rows.select("doc_id", *KEY, "text", "lengths", "counts"), "token-edited")
    new = written(done.groupBy(*KEY).agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("lengths").alias("lengths"), F.first("counts").alias("counts")), "token-trees")
    keys = new.select(*KEY)
    return Kept(kept.texts.join(keys, KEY, "left_anti").select("doc_id", *KEY, "text").unionByName(done.select("doc_id", *KEY, "text")),
                kept.trees.join(keys, KEY, "left_anti").unionByName(new, allowMissingColumns=False))


def totals(kept: Kept) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row, from the trees alone."""
    t = kept.trees.select("doc_id", _tokens("counts").alias("n_tokens"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return t.drop("copy")


def counts_after_edits(docs: DataFrame, tokenizer: str, edits: Callable[[int | None, str], list[tuple[int, int, str]]]) -> DataFrame:
    """``doc_id``, tokens of the whole text, tokens after the edits (from the kept trees,
    re-encoding only what they touch), and segments in all and re-encoded.

    ``edits(doc_id, text)`` lists ``(start, stop, new text)``, each against the
    text that the ones before it have left; a text without edits keeps its count.
    """
    kept = keep(docs, tokenizer)
    listed = written(by_rule(kept, edits), "token-edit-list")
    rows = edit(kept, listed, tokenizer).select("doc_id", "n_tokens", _tokens("counts").alias("n_tokens_edited"), "segments", "segments_encoded")
    rest = kept.trees.join(listed.select(*KEY).distinct(), KEY, "left_anti")
    rest = rest.select("doc_id", _tokens("counts").alias("n_tokens"), F.size("counts").cast("long").alias("segments"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return rows.unionByName(rest.select("doc_id", "n_tokens", F.col("n_tokens").alias("n_tokens_edited"), "segments", F.lit(0).cast("long").alias("segments_encoded")))


def _edit_all(trees: list[SegmentTree], edits: list[list[tuple[int, int, str]]], count) -> None:
    """The k-th edit of every tree together, so that the touched segments of a
    block are encoded in one call."""
    for k in range(max((len(e) for e in edits), default=0)):
        turn = [(t, *t.splice(*e[k])) for t, e in zip(trees, edits, strict=True) if len(e) > k]
        got = count([p for *_, fresh in turn for p in fresh])
        at = 0
        for t, lo, hi, fresh in turn:
            t.settle(lo, hi, got[at:at + len(fresh)])
            at += len(fresh)


def sample_edits(doc_id: int | None, text: str) -> list[tuple[int, int, str]]:
    """Three edits by rule for any text: its first tenth's end is overwritten by its
    opening words, its middle loses forty characters, and a line is inserted at two thirds."""
    n = len(text)
    return [(n // 10, n // 10 + 25, text[:31]), (n // 2, n // 2 + 40, ""), (2 * n // 3, 2 * n // 3, f"\nNote {0 if doc_id is None else doc_id}: it's revised.\n")]
