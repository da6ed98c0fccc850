"""Ranked lexical search by branch and bound over document FP-trees.

Terms are the maximal runs of characters other than ASCII signs, white space
and controls, with A-Z lowered.  A document's score for an item adds, over the
item's terms with repeats, ``w * ((10**9 * tf) div (1000 * tf + 12 * m))`` in
64-bit integers: ``w`` falls with the documents that hold the term, ``m``
grows with the document's length.

One scan of the texts keeps each document's length and its term vector
restricted to the items' terms.  The vectors' terms are put in order of
falling frequency and the documents are dealt out by ranges of these vectors,
so documents that share a path of the FP-tree lie side by side.  Tasks take
runs of them, build the tree over a run, and note for each subtree the largest
``tf`` of every term and the least ``m``: no document below can score more
than a document with these.  Each item then searches depth first, the most
promising child first, and leaves out subtrees bound below its ``top``-th
score so far.  A task sends its ``top`` rows for each item.

Items are searched in blocks of at most ``ITEMS`` items or about ``ITEM_TERMS``
terms, whatever their number; a block goes to every task.

Null and empty texts have no term; they count in neither N nor L and are never
found.  An item without a term has no rows.  Equal scores rank by ascending
``doc_id`` (null first).  Repeated rows are documents of their own, and so are
repeated items.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import texts, written

TOP = 20
ITEMS, ITEM_TERMS = 1024, 1 << 18
#: Documents of a tree, of a leaf, and tf maxima of a tree, at most.
RUN, LEAF, MAXIMA = 8192, 32, 1 << 23
#: Lets each task sort its own share of an item's rows before one task sorts the rest.
SALTS = 64

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_LOWER))


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every term in the bytes of a block of texts."""
    inside = np.concatenate([[False], _IN_TERM[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


@dataclass
class Items:
    """A block of items: distinct terms (sorted hashes) and how often each item asks for each."""
    rows: list[int]
    hashes: np.ndarray
    times: np.ndarray      # items x terms


def read_items(rows: list[tuple[int, list[str]]]) -> Items:
    words = sorted({t for _, ts in rows for t in ts})
    data = [t.encode() for t in words]
    cut = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    h = T.hash_spans(np.frombuffer(b"".join(data), np.uint8), cut[:-1], cut[1:])
    order = np.argsort(h)
    place = {words[k]: i for i, k in enumerate(order)}
    times = np.zeros((len(rows), len(words)), np.int64)
    for i, (_, ts) in enumerate(rows):
        for t in ts:
            times[i, place[t]] += 1
    return Items([r for r, _ in rows], h[order], times)


def item_blocks(items: DataFrame) -> Iterator[Items]:
    held, size = [], 0
    for r in items.select("item_row", "text").toLocalIterator():
        ts = terms_of(r["text"])
        if not ts:
            continue
        held.append((r["item_row"], ts))
        size += len(ts)
        if len(held) >= ITEMS or size >= ITEM_TERMS:
            yield read_items(held)
            held, size = [], 0
    if held:
        yield read_items(held)


_VECTOR = "doc_id long, n long, terms array<int>, tfs array<long>"


def vectors(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Each document's number of terms, and its vector over the given terms."""

    def run(batches):
        for b in T.blocks(batches):
            data, off = T.utf8(T.column(b, "text"))
            s, e, doc = term_spans(data, off)
            h = T.hash_spans(T.LOWER[data], s, e)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            code, tf = np.unique(doc[hit] * len(hashes) + at[hit], return_counts=True)
            cut = pa.array(np.searchsorted(code, np.arange(b.num_rows + 1) * len(hashes)), pa.int32())
            yield pa.RecordBatch.from_arrays([T.column(b, "doc_id"), pa.array(np.bincount(doc, minlength=b.num_rows)), pa.ListArray.from_arrays(cut, pa.array((code % len(hashes)).astype(np.int32))),
                                              pa.ListArray.from_arrays(cut, pa.array(tf.astype(np.int64)))], names=["doc_id", "n", "terms", "tfs"])

    return texts(docs).mapInArrow(run, _VECTOR)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass
class Node:
    lo: int
    hi: int
    children: list[int]


def _depth_first(off: np.ndarray, terms: np.ndarray, leaf: int) -> list[Node]:
    """The tree over documents in order of their vectors; a node's number is smaller
    than its children's.  Shared paths are one node, and neighbouring children of
    few documents one leaf."""
    nodes = [Node(0, len(off) - 1, [])]
    todo = [(0, 0)]
    while todo:
        number, depth = todo.pop()
        lo, hi = nodes[number].lo, nodes[number].hi
        if hi - lo <= leaf:
            continue
        while True:  # down the path that all documents share
            at = off[lo:hi] + depth
            here = np.where(at < off[lo + 1:hi + 1], terms[np.minimum(at, len(terms) - 1)], -1)
            if here[0] < 0 or here[0] != here[-1]:
                break
            depth += 1
        if here[-1] < 0:  # equal vectors: any cut will do
            cuts = list(range(lo, hi, max(leaf, -(-(hi - lo) // 2)))) + [hi]
        else:
            cuts = (np.flatnonzero(np.diff(here)) + lo + 1).tolist()
            packed, begin = [], lo
            for c, after in zip([*cuts, hi], [*cuts[1:], hi, hi], strict=True):
                if after - begin > leaf or c == hi:
                    packed.append(c)
                    begin = c
            cuts = [lo, *packed]
        for a, b in zip(cuts, cuts[1:], strict=False):
            nodes[number].children.append(len(nodes))
            todo.append((len(nodes), depth))
            nodes.append(Node(a, b, []))
    return nodes


class Tree:
    """The FP-tree of some documents: ids, lengths ``m`` and vectors in order of the vectors."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, m: np.ndarray, off: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, leaf: int = LEAF):
        self.ids, self.null, self.off, self.terms = ids, null, off, terms
        self.nodes = _depth_first(off, terms, leaf)
        size = np.diff(off)
        self.value = weights[terms] * parts(tfs, np.repeat(m, size))
        tf_max = np.zeros((len(self.nodes), len(weights)), np.int64)
        m_min = np.zeros(len(self.nodes), np.int64)
        for k in range(len(self.nodes) - 1, -1, -1):
            x = self.nodes[k]
            if x.children:
                tf_max[k], m_min[k] = tf_max[x.children].max(axis=0), m_min[x.children].min()
            else:
                a, b = off[x.lo], off[x.hi]
                np.maximum.at(tf_max[k], terms[a:b], tfs[a:b])
                m_min[k] = m[x.lo:x.hi].min()
        self.most = weights[None, :] * parts(tf_max, m_min[:, None])

    def bounds(self, times: np.ndarray) -> np.ndarray:
        """No document below a node scores more for an item: items x nodes."""
        high = times.astype(float) @ self.most.T.astype(float)
        return np.ceil(high * (1 + 1e-9))

    def scores(self, k: int, times: np.ndarray) -> np.ndarray:
        """The exact scores of a leaf's documents."""
        x = self.nodes[k]
        a, b = self.off[x.lo], self.off[x.hi]
        return np.add.reduceat(self.value[a:b] * times[self.terms[a:b]], self.off[x.lo:x.hi] - a)

    def search(self, bounds: np.ndarray, times: np.ndarray, best: list[tuple], top: int) -> tuple[list[tuple], int]:
        """Depth first for one item, from the ``best`` rows so far (score falling, then
        id); the best rows after it, and the leaves looked at."""
        todo, seen = [0], 0
        while todo:
            k = todo.pop()
            least = -best[-1][0] if len(best) >= top else 1
            if bounds[k] < least:
                continue
            x = self.nodes[k]
            if x.children:
                todo += sorted(x.children, key=lambda c: bounds[c])
                continue
            seen += 1
            s = self.scores(k, times)
            ok = np.flatnonzero(s >= least)
            if len(ok):
                best = sorted(best + [(-int(s[i]), not self.null[x.lo + i], int(self.ids[x.lo + i])) for i in ok])[:top]
        return best, seen


def _runs(batches, limit: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows in runs of ``limit``."""
    held, n = [], 0
    for b in batches:
        while b.num_rows:
            held.append(b.slice(0, limit - n))
            n += held[-1].num_rows
            b = b.slice(held[-1].num_rows)
            if n == limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def search_block(vec: DataFrame, items: Items, top: int) -> DataFrame:
    """``item_row, doc_id, score``: for each item and task the ``top`` rows at most."""
    total = vec.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, length = total["docs"], total["terms"]
    df = np.zeros(len(items.hashes), np.int64)
    for r in vec.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # a number for each term of the block
        df[r["t"]] = r["count"]
    order = np.argsort(-df, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    weights = np.array([weight(n_docs, int(x)) for x in df[order]], np.int64)
    # columns are terms in order of falling frequency; as many items as their bounds allow
    sent = vec.sparkSession.sparkContext.broadcast((rank, weights, items.times[:, order], items.rows))
    run_docs = max(4 * LEAF, min(RUN, MAXIMA * LEAF // (2 * max(1, len(weights)))))

    def by_frequency(batches):
        rank = sent.value[0]
        for b in batches:
            off, t = _list(b, "terms")
            tf = _list(b, "tfs")[1]
            doc = np.repeat(np.arange(b.num_rows), np.diff(off))
            at = np.lexsort((rank[t], doc))
            cut = pa.array(off.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n"), pa.ListArray.from_arrays(cut, pa.array(rank[t][at].astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(tf[at]))], names=["doc_id", "n", "terms", "tfs"])

    def run(batches):
        _, weights, times, rows = sent.value
        best: list[list[tuple]] = [[] for _ in rows]
        for b in _runs(batches, run_docs):
            off, t = _list(b, "terms")
            n = T.column(b, "n").to_numpy()
            tree = Tree(T.column(b, "doc_id").fill_null(0).to_numpy(), T.column(b, "doc_id").is_null().to_numpy(zero_copy_only=False), 75 + (25 * n * n_docs) // length, off, t, _list(b, "tfs")[1], weights)
            bounds = tree.bounds(times)
            for i in range(len(rows)):
                best[i], _ = tree.search(bounds[i], times[i], best[i], top)
        got = [(r, d if there else None, -s) for r, found in zip(rows, best, strict=True) for s, there, d in found]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*got, strict=True)] if got else [pa.array([], pa.int64())] * 3, names=["item_row", "doc_id", "score"])

    # a task takes documents that share paths; a path that very many share is split by id
    near = vec.where("size(terms) > 0").mapInArrow(by_frequency, _VECTOR).repartitionByRange("terms", "doc_id", "n").sortWithinPartitions("terms", "doc_id", "n")
    return near.mapInArrow(run, "item_row long, doc_id long, score long")


def _list(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column."""
    col = T.column(b, name)
    off = col.offsets.to_numpy().astype(np.int64)
    return off - off[0], col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` (``item_id, text``)
    its ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    rows = written(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).withColumn("item_row", F.monotonically_increasing_id()), "lexical-items")
    found = None
    for block in item_blocks(rows):
        part = search_block(written(vectors(docs, block.hashes), "lexical-vectors"), block, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_row", "salt").orderBy(*best))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_row").orderBy(*best))).where(F.col("rank") <= top)
    return found.join(rows.select("item_row", "item_id"), "item_row").select("item_id", "rank", "doc_id", "score")
