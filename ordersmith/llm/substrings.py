"""Substring dedup: passages of words that stand earlier in the corpus are removed.

A window is ``window`` consecutive words of one document.  A word is removed if
it stands in a window whose words also start earlier: in a document of smaller
``doc_id``, or earlier in the same one.

Repeated windows are found by level-wise doubling.  The first level has windows
of ``base`` words, and of these only anchors: the window of least hash among
those inside a ``window``, so that equal passages have equal anchors.  Anchors
that repeat let the windows around them pass; at twice the length only those
that passed are examined; and so on until ``window`` words are reached or no
candidate is left.  At each level a task first settles what repeats within its
own share: it sends one row for each hash, so a passage that very many
documents hold costs one row a task.  At the last level two independent hashes,
95 bits in all, tell the windows apart.

Texts with the same words are one text: of its documents the first alone takes
part, and in the others, if they hold a window, all words are removed.

Null and empty texts have no words.  Among rows with one ``doc_id`` the order is
that of the rows as read; a null id comes before all others.  Repeated rows are
thus copies of the first of them.  A very long text is handled alone, in memory
that grows with it.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import texts, written

U64 = np.uint64
WINDOW, BASE = 20, 10
#: Rows that a task sorts before it sends them.
HELD = 1 << 19
_SECOND = U64(0x3C79AC492BA7B653)
_LEFT, _RIGHT = np.array([0xD1342543DE82EF95]).astype(U64), np.array([0xAF251AF3B0F025B5]).astype(U64)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def levels(window: int, base: int) -> list[int]:
    """The lengths ``base``, twice that, ... up to ``window``."""
    out = [base]
    while out[-1] < window:
        out.append(2 * out[-1])
    if out[-1] != window or base > len(T._ODD):
        raise ValueError("window must be base times a power of 2")
    return out


def doubled(h: np.ndarray, doc: np.ndarray, length: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """At each word the hash of the ``length`` words from there, made from the hashes of
    its halves, and whether the document has that many."""
    out, there = np.zeros(len(h), U64), np.zeros(len(h), bool)
    w, at = T.windows(h, doc, base)
    out[at], there[at] = w, True
    size = base
    while size < length:
        right = np.zeros(len(h), U64)
        right[:-size or None] = out[size:] if size < len(h) else 0
        out = T.mix(out * _LEFT + right * _RIGHT)
        size *= 2
        there = np.zeros(len(h), bool)
        if len(h) >= size:
            there[:len(h) - size + 1] = doc[:len(h) - size + 1] == doc[size - 1:]
    return out, there


def anchors(h: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """For each window start the place of the least of the ``span`` hashes from there (the first of equal ones)."""
    best, at = h[starts], starts.copy()
    for i in range(1, span):
        x = h[starts + i]
        less = x < best
        best[less], at[less] = x[less], starts[less] + i
    return at


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their documents, and each document's first word, of packed texts."""
    import zstandard

    un = zstandard.ZstdDecompressor()
    parts = [un.decompress(x.as_buffer()) for x in T.column(batch, "z")]
    data = np.frombuffer(b"".join(parts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    h, doc, _, _ = T.words(data, off)
    return h, doc, np.searchsorted(doc, np.arange(batch.num_rows + 1))


def _listed(batch: pa.RecordBatch, name: str, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which places hold one of their document's listed hashes."""
    out = np.zeros(len(h), bool)
    col = T.column(batch, name)
    for i in range(batch.num_rows):
        known = col[i].values.to_numpy().view(U64)
        if len(known):
            out[at[i]:at[i + 1]] = np.isin(h[at[i]:at[i + 1]], known)
    return out


def candidates(batch: pa.RecordBatch, words: tuple, length: int, window: int, base: int) -> np.ndarray:
    """The starts of windows that the level before ``length`` has let pass."""
    h, doc, at = words
    starts = np.flatnonzero(doubled(h, doc, window, base)[1])
    if length == base or not len(starts):
        return starts
    before = length // 2
    x, _ = doubled(h, doc, before, base)
    good = _listed(batch, "passed", x, at)
    if before == base:
        return starts[good[anchors(x, starts, window - base + 1)]]
    bad = np.concatenate([[0], np.cumsum(~good)])
    return starts[bad[starts + window - before + 1] == bad[starts]]


def _examined(batch: pa.RecordBatch, length: int, window: int, base: int) -> tuple[np.ndarray, ...]:
    """Distinct ``document, hash`` (and second hash) of the windows of ``length`` words to
    examine, and whether the document has each more than once."""
    words = h, doc, at = _words(batch)
    starts = candidates(batch, words, length, window, base)
    x, _ = doubled(h, doc, length, base)
    if length == base:
        places = np.unique(anchors(x, starts, window - base + 1)) if len(starts) else starts
    else:
        mark = np.zeros(len(h) + 1, np.int64)
        np.add.at(mark, starts, 1)
        np.add.at(mark, starts + window - length + 1, -1)
        places = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    g = (doubled(T.mix(h ^ _SECOND), doc, length, base)[0][places] >> U64(33)).astype(np.int32) if length == window else np.zeros(len(places), np.int32)
    d, x = doc[places], x[places]
    order = np.lexsort((g, x, d))
    d, x, g = d[order], x[order], g[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1]) | (g[1:] != g[:-1])
    first = np.flatnonzero(new)
    return d[first], x[first], g[first], np.diff(np.append(first, len(d))) > 1


#: Bits of ``times``: the document holds the window more than once; it repeats within the task's share.
OFTEN, REPEATED = 1, 2


def _settled(rank: np.ndarray, x: np.ndarray, g: np.ndarray, often: np.ndarray) -> pa.RecordBatch:
    """Of rows with one hash the first (by rank) stays open, as repeated if others follow; the others are settled."""
    order = np.lexsort((rank, g, x))
    rank, x, g, often = rank[order], x[order], g[order], often[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (g[1:] != g[:-1])
    more = np.diff(np.append(np.flatnonzero(new), len(x))) > 1
    repeated = often.copy()
    repeated[new] |= more
    return pa.RecordBatch.from_arrays([pa.array(rank), pa.array(x.view(np.int64)), pa.array(g), pa.array((often + 2 * repeated).astype(np.int8)), pa.array(~new)], names=["id", "h", "g", "times", "settled"])


def examine(packed: DataFrame, length: int, window: int, base: int) -> DataFrame:
    """Rows of ``id, h, g``: the windows of a level, settled within each task's share.  The
    ids tell documents apart; in the last level they are ranks, in the order of documents."""

    def run(batches):
        held, n = [], 0
        for b in T.blocks(batches, "z", T.BLOCK_BYTES // 3):
            d, x, g, often = _examined(b, length, window, base)
            held.append((T.column(b, "id").to_numpy()[d], x, g, often))
            n += len(d)
            if n >= HELD:
                yield _settled(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield _settled(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return packed.mapInArrow(run, "id long, h long, g int, times byte, settled boolean")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``id, h, first, often``: the windows that repeat, and whether no document of smaller id holds them."""
    # settled rows are dealt out by their ids and stand alone; of the others there is one
    # for each task's share: a window of very many documents is few rows in one place
    alone = F.when(F.col("settled"), F.col("id"))
    w = Window.partitionBy("h", "g", alone).orderBy("id")
    out = rows.select("id", "h", "times", "settled", F.row_number().over(w).alias("at"), F.lead("id").over(w).alias("next"))
    out = out.where(F.col("settled") | (F.col("at") > 1) | F.col("next").isNotNull() | (F.col("times") >= REPEATED))
    return out.select("id", "h", (~F.col("settled") & (F.col("at") == 1)).alias("first"), (F.col("times") % 2 == OFTEN).alias("often"))


def pack(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n_words``, a 128-bit key of the words, the digest of the words
    joined by single spaces, and these compressed (``z``)."""

    def run(batches):
        import zstandard

        for b in T.blocks(batches):
            z = zstandard.ZstdCompressor(level=3)
            data, off = T.utf8(T.column(b, "text"))
            h, doc, s, e = T.words(data, off)
            at = np.searchsorted(doc, np.arange(b.num_rows + 1))
            pos, local = T.gather(s, e - s)
            size = np.cumsum(e - s + 1) if len(s) else np.zeros(0, np.int64)
            out = np.full(int(size[-1]) if len(s) else 0, 0x20, np.uint8)
            out[np.repeat(size - (e - s + 1), e - s) + local] = data[pos]
            cut = np.concatenate([[0], size])[at]
            body = [out[i:max(i, j - 1)].tobytes() for i, j in zip(cut, cut[1:], strict=False)]
            key = [T.hash_spans(v, at[:-1], at[1:]).view(np.int64) for v in (h, T.mix(h ^ _SECOND))]
            yield pa.RecordBatch.from_arrays(
                [T.column(b, "row"), T.column(b, "doc_id"), pa.array(np.diff(at)), pa.array(key[0]), pa.array(key[1]), pa.array([hashlib.sha256(x).hexdigest() for x in body]), pa.array([z.compress(x) for x in body], pa.binary())],
                names=["row", "doc_id", "n_words", "k1", "k2", "sha", "z"])

    return texts(docs).withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, "row long, doc_id long, n_words long, k1 long, k2 long, sha string, z binary")


def _cut(listed: DataFrame, window: int, base: int) -> DataFrame:
    """``row, n_removed, kept_sha256`` of documents with repeated windows: all places
    of those in ``gone``, all but the first place of those in ``own``."""

    def run(batches):
        import zstandard

        for b in T.blocks(batches, "z", T.BLOCK_BYTES // 3):
            h, doc, at = _words(b)
            x, there = doubled(h, doc, window, base)
            gone = _listed(b, "gone", x, at) & there
            own = np.flatnonzero(_listed(b, "own", x, at) & there)
            order = own[np.lexsort((own, x[own], doc[own]))]
            again = np.zeros(len(order), bool)
            again[1:] = (x[order[1:]] == x[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
            gone[order[again]] = True
            mark = np.zeros(len(h) + 1, np.int64)
            start = np.flatnonzero(gone)
            mark[start] += 1
            np.add.at(mark, start + window, -1)
            out = np.cumsum(mark[:-1]) > 0
            un = zstandard.ZstdDecompressor()
            sha = []
            for i, z in enumerate(T.column(b, "z")):
                keep = ~out[at[i]:at[i + 1]]
                body = un.decompress(z.as_buffer())
                sha.append(hashlib.sha256(b" ".join([w for w, k in zip(body.split(b" "), keep.tolist(), strict=True) if k])).hexdigest())
            yield pa.RecordBatch.from_arrays([T.column(b, "row"), pa.array(np.add.reduceat(out.astype(np.int64), at[:-1])), pa.array(sha)], names=["row", "n_removed", "kept_sha256"])

    return listed.mapInArrow(run, "row long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed`` and ``kept_sha256`` (of the kept words joined by one space)."""
    steps = levels(window, base)
    packed = written(pack(docs), "substrings-texts")
    # one document for each text that holds a window, ranked in the order of ids
    one = packed.where(F.col("n_words") >= window).groupBy("k1", "k2", "n_words").agg(F.min(F.struct("doc_id", "row")).alias("f")).select("f.*")
    order = [F.col("doc_id").asc_nulls_first(), F.col("row").asc()]
    ranks = written(one.repartitionByRange(*order).sortWithinPartitions(*order).select("row", F.monotonically_increasing_id().alias("rank")), "substrings-ranks")
    body = packed.select("row", "z")
    # the first of several levels needs no order, so no join: copies drop out of its result
    level = body.withColumnRenamed("row", "id") if len(steps) > 1 else body.join(ranks, "row").select(F.col("rank").alias("id"), "z")
    for i, length in enumerate(steps):
        # not written: a level's rows are shuffled once, and in one query with the cut
        # below its join and this one read one shuffle of the texts
        found = repeated_windows(examine(level, length, window, base))
        if length < window:
            passed = found.groupBy("id").agg(F.collect_list("h").alias("passed"))
            passed = passed.join(ranks, passed["id"] == ranks["rank" if i else "row"]).select("row", "rank", "passed")
            level = body.join(passed, "row").select(F.col("rank").alias("id"), "z", "passed")
    # windows of a document that is the first to hold them matter only if it repeats them
    own = F.collect_list(F.when(F.col("first"), F.col("h")))
    listed = found.where("often or not first").groupBy("id").agg(F.collect_list(F.when(~F.col("first"), F.col("h"))).alias("gone"), own.alias("own"))
    listed = listed.join(ranks, listed["id"] == ranks["rank"]).select("row", "gone", "own")
    cut = written(_cut(body.join(listed, "row"), window, base), "substrings-cut")
    out = packed.select("row", "doc_id", "n_words", "sha").join(ranks, "row", "left").join(cut, "row", "left")
    copy = (F.col("n_words") >= window) & F.col("rank").isNull()
    return out.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                      F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
