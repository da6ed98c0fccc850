"""Token alignment between two tokenizers, and corpus-wide counts of linked pairs.

A text is encoded by a byte-level BPE (A, on a space and the text) and by a
piece BPE with byte fallback (B, which puts the space before it itself).  Byte
offsets at which tokens of both end cut the tokens into groups; an A and a B
token of one group are linked.  A pair of ids counts once for each document
that holds it linked.

Both tokenizers let no token span a space that follows a visible character.
So texts are cut there into units, each distinct unit of a block is encoded
and aligned once by the tokenizers themselves, and a text's tokens are gathered
from its units (the tests compare this with whole texts).

Counting, by minimal perfect hashing: a first pass aligns all documents and
sums, task by task, the documents of each pair.  The distinct pairs are dealt
into buckets, each of which builds a minimal perfect hash (levels of bits at
which a key stands alone; a key's index is the rank of its bit).  Tasks add
their sums into dense vectors indexed by the hash, verified against the key
kept at each index, and the vectors are summed in a tree of ``FAN`` parts a
step.  A second pass aligns the documents again and looks the counts up.

Ids of A stay below 2**16 and of B below 2**15, so there are at most 2**31
pairs whatever the corpus.  Tasks hold ``SLICE`` pairs at a time (12 bytes
each); further slices take further passes.

Null and empty texts, and texts whose tokens do not give back the space and the
text, have no tokens: zeros and an empty ``groups_sha256``.  Repeated rows and
rows with a null or repeated id are documents of their own.  Very long texts are
handled alone.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import texts, written

U64 = np.uint64
#: An A id above the bits of a B id make a pair's key.
B_BITS = 15
#: Distinct pairs of a bucket, on average; of a slice, at most.
BUCKET, SLICE = 1 << 16, 1 << 23
#: Vectors that are added up in one group.
FAN = 8
#: Distinct pairs that a task of the first pass holds before it sends them.
HELD = 1 << 20


# ---- units and their alignment ----

def visible_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each place is there and not white space."""
    x, y, z = (np.where(at >= k, data[np.maximum(at - k, 0)], 0) for k in (1, 2, 3))
    wide = ((y == 0xC2) & ((x == 0x85) | (x == 0xA0))) | ((z == 0xE1) & (y == 0x9A) & (x == 0x80)) | ((z == 0xE3) & (y == 0x80) & (x == 0x80))
    wide |= (z == 0xE2) & (((y == 0x80) & ((x <= 0x8A) | (x == 0xA8) | (x == 0xA9) | (x == 0xAF))) | ((y == 0x81) & (x == 0x9F)))
    return (x > 0x20) & ~wide


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units start: at each text, and at each space after a visible character."""
    at = np.flatnonzero(data == 0x20)
    cut = np.zeros(len(data), bool)
    cut[at[visible_before(data, at)]] = True
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut)


def byte_level() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes for U+0100 upwards in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


# Fixed value: the pattern that splits a text before the merges of a byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBpe:
    """The byte-level vocabulary of a tokenizer file, with the special tokens as plain
    text.  Its merges must be in the order of their ids, as ranks are."""

    def __init__(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        to_byte = byte_level()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in model["vocab"].items() if all(c in to_byte for c in token)}
        special = {i for i in model["vocab"].values()} - set(range(256 + len(model["merges"])))
        ranks = {t: i for t, i in ranks.items() if i not in special}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        if any(model["vocab"][x + y] != 256 + i for i, (x, y) in enumerate(pairs)):
            raise ValueError("merges are not in the order of their ids")
        self.size = max(ranks.values()) + 1
        self.bytes = [b""] * self.size
        for t, i in ranks.items():
            self.bytes[i] = t
        self.encode = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Units:
    """Both encodings of distinct units with their groups and links, remembered per process."""

    KEEP = 600_000
    #: Bytes of units that are encoded in one call.
    CALL = 1 << 16

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece

        self.a = ByteBpe(byte_bpe)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece spans a space that follows a visible character")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_space = self.b.piece_to_id("▁")
        if self.a.size > 1 << 16 or len(pieces) > 1 << B_BITS:
            raise ValueError("ids do not fit a pair's key")
        self.a_len = np.array([len(x) for x in self.a.bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.clear()

    def clear(self) -> None:
        self.hashes, self.number = np.zeros(0, U64), np.zeros(0, np.int64)
        self.strings = pa.array([], pa.large_string())
        self.stats = np.zeros((0, 4), np.int64)   # ok, A tokens, B tokens, groups
        self.keys, self.times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.off = np.zeros(1, np.int64)

    def _encoded(self, part: bytes) -> tuple[list[int], list[int], bool]:
        """Ids of a run of units, and whether both give back its bytes."""
        text = part.decode()
        # B puts the first space back itself, unless nothing follows it
        a, b = self.a.encode(text), self.b.encode(text[1:]) if len(text) > 1 else [self.b_space]
        return a, b, b"".join([self.a.bytes[i] for i in a]) == part and b"".join([self.b_bytes[i] for i in b]) == part

    def encode(self, units: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both for units that stand in a row and end at ``ends``, without those
        whose bytes they do not give back, and which these are."""
        ok = np.ones(len(ends), bool)
        fa, fb = [], []
        lo = at = 0
        # a unit that ends in white space could join the next one: it ends a call
        close = np.flatnonzero(~visible_before(np.frombuffer(units, np.uint8), ends))
        while at < len(ends):
            hi = max(at + 1, int(np.searchsorted(ends, lo + self.CALL, "right")))
            k = int(np.searchsorted(close, at))
            if k < len(close):
                hi = min(hi, int(close[k]) + 1)
            a, b, good = self._encoded(units[lo:ends[hi - 1]])
            if good:
                fa.append(np.array(a, np.int64))
                fb.append(np.array(b, np.int64))
            else:  # one by one
                for i in range(at, hi):
                    a, b, ok[i] = self._encoded(units[ends[i - 1] if i else 0:ends[i]])
                    if ok[i]:
                        fa.append(np.array(a, np.int64))
                        fb.append(np.array(b, np.int64))
            at, lo = hi, int(ends[hi - 1])
        z = np.zeros(0, np.int64)
        return np.concatenate([z, *fa]), np.concatenate([z, *fb]), ok

    def add(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        size = ends - starts
        # those that end in a visible character first: they can be encoded in long calls
        order = np.argsort(~visible_before(data, ends), kind="stable")
        hashes, starts, size = hashes[order], starts[order], size[order]
        pos, _ = T.gather(starts, size)
        fa, fb, ok = self.encode(data[pos].tobytes(), np.cumsum(size))
        n = len(size)
        ea, eb = np.cumsum(self.a_len[fa]), np.cumsum(self.b_len[fb])
        end = np.intersect1d(ea, eb, assume_unique=True)  # a unit's end is one of them
        ga, gb = np.searchsorted(end, ea), np.searchsorted(end, eb)
        unit = np.flatnonzero(ok)[np.searchsorted(np.cumsum(size[ok]), end)]  # of each group
        stats = np.stack([ok.astype(np.int64), *(np.bincount(u, minlength=n) for u in (unit[ga], unit[gb], unit))], axis=1)
        group, keys, times = links(fa, ga, fb, gb, len(end))
        who, keys, times = summed(unit[group], keys, times)  # a unit's distinct pairs
        said = pc.binary_join_element_wise(_joined(fa, np.bincount(ga, minlength=len(end)), ","), _joined(fb, np.bincount(gb, minlength=len(end)), ","), pa.scalar("|", pa.large_string()))
        strings = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(stats[:, 3])])), said), pa.scalar(";", pa.large_string()))
        number = len(self.stats) + np.arange(n)
        at = np.argsort(np.concatenate([self.hashes, hashes]), kind="stable")
        self.hashes, self.number = np.concatenate([self.hashes, hashes])[at], np.concatenate([self.number, number])[at]
        self.strings = pa.concat_arrays([self.strings, strings])
        self.stats = np.concatenate([self.stats, stats])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(np.bincount(who, minlength=n))])
        self.keys, self.times = np.concatenate([self.keys, keys]), np.concatenate([self.times, times])

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each unit; new ones are encoded first."""
        u, first, inv = np.unique(T.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(u) > self.KEEP:
            self.clear()

        def find():
            at = np.minimum(np.searchsorted(self.hashes, u), max(0, len(self.hashes) - 1))
            return at, (self.hashes[at] == u) if len(self.hashes) else np.zeros(len(u), bool)

        at, there = find()
        if not there.all():
            new = first[~there]
            self.add(u[~there], data, starts[new], ends[new])
            at, _ = find()
        return self.number[at][inv]


def _joined(ids: np.ndarray, sizes: np.ndarray, by: str) -> pa.Array:
    """Decimal ids of consecutive runs, joined."""
    off = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(off, pa.array(ids).cast(pa.large_string())), pa.scalar(by, pa.large_string()))


def summed(who: np.ndarray, keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``who, key``, in order, with their times added up."""
    if not len(keys):
        return who, keys, times
    code = (who.astype(U64) << U64(32)) | keys.astype(U64)
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return (code[first] >> U64(32)).astype(np.int64), code[first].astype(np.uint32), np.add.reduceat(times[order], first)


def links(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, key and times of the linked pairs of ids.  Each group's ids are made
    distinct first, so a long group of few ids gives few rows."""
    ga, a, ta = summed(ga, a.astype(np.uint32), np.ones(len(a), np.int64))
    gb, b, tb = summed(gb, b.astype(np.uint32), np.ones(len(b), np.int64))
    at_b = np.searchsorted(gb, np.arange(n + 1))
    pos, _ = T.gather(at_b[ga], np.diff(at_b)[ga])
    left = np.repeat(np.arange(len(ga)), np.diff(at_b)[ga])
    return ga[left], (a[left] << np.uint32(B_BITS)) | b[pos], ta[left] * tb[pos]


@dataclass
class Aligned:
    """A block of texts: per document A tokens, B tokens and groups; its distinct pairs with their times."""
    stats: np.ndarray
    doc: np.ndarray
    keys: np.ndarray
    times: np.ndarray
    strings: list[str] | None


_UNITS: dict[tuple[str, str], Units] = {}


def align(batch: pa.RecordBatch, byte_bpe: str, piece_bpe: str, say: bool = False) -> Aligned:
    """Align a block's texts; with ``say`` also write their groups out."""
    path = (byte_bpe, piece_bpe)
    if path not in _UNITS:
        _UNITS[path] = Units(*path)
    u = _UNITS[path]
    col = pc.fill_null(T.column(batch, "text").cast(pa.large_string()), "")
    empty = pc.equal(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    data, off = T.utf8(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), col, pa.scalar("", pa.large_string())))
    starts = unit_starts(data, off)
    unit = u.look_up(data, starts, np.append(starts[1:], len(data)))
    at = np.searchsorted(starts, off[:-1])
    stats = u.stats[unit]
    fits = (np.minimum.reduceat(stats[:, 0], at) == 1) & ~empty
    n = np.where(fits[:, None], np.add.reduceat(stats[:, 1:], at, axis=0), 0)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(np.append(at, len(unit))))
    # distinct units of each document, then their pairs
    held = fits[doc]
    d, k, times = summed(doc[held], unit[held].astype(np.uint32), np.ones(int(held.sum()), np.int64))
    k = k.astype(np.int64)
    size = u.off[k + 1] - u.off[k]
    pos, _ = T.gather(u.off[k], size)
    who, keys, times = summed(np.repeat(d, size), u.keys[pos], np.repeat(times, size) * u.times[pos])
    strings = None
    if say:
        size = np.where(fits, np.diff(np.append(at, len(unit))), 0)
        off = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int64())
        strings = pc.binary_join(pa.LargeListArray.from_arrays(off, u.strings.take(pa.array(unit[fits[doc]]))), pa.scalar(";", pa.large_string())).to_pylist()
    return Aligned(n, who, keys, times, strings)


# ---- minimal perfect hash ----

def _salted(keys: np.ndarray, level: int) -> np.ndarray:
    return T.mix(keys.astype(U64) + U64(level + 1) * np.full(1, 0x9E3779B97F4A7C15, U64))


def build_levels(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of 64-bit words in which each key has one bit of its own, and the keys in the order of their bits."""
    levels, order = [], []
    while len(keys):
        size = 64 * max(1, math.ceil(len(keys) * 1.3 / 64))
        pos = (_salted(keys, len(levels)) % U64(size)).astype(np.int64)
        alone = np.bincount(pos, minlength=size)[pos] == 1
        bits = np.zeros(size, np.uint8)
        bits[pos[alone]] = 1
        levels.append(np.packbits(bits, bitorder="little").view("<u8"))
        order.append(keys[alone][np.argsort(pos[alone])])
        keys = keys[~alone]
    return levels, np.concatenate(order) if order else np.zeros(0, np.uint32)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys.astype(U64) * U64(0x9E3779B1) % U64(1 << 32)) * U64(buckets) >> U64(32)).astype(np.int64)


@dataclass
class PerfectHash:
    """The hashes of consecutive buckets, ``first`` onwards, of ``buckets`` in all."""
    buckets: int
    first: int
    start: np.ndarray    # bucket x level: its first word, or -1
    bits: np.ndarray     # bucket x level: its size in bits
    words: np.ndarray
    rank: np.ndarray     # bits set before each word
    keys: np.ndarray     # by index

    @staticmethod
    def join(buckets: int, first: int, parts: list[tuple[list[np.ndarray], np.ndarray]]) -> PerfectHash:
        deep = max((len(levels) for levels, _ in parts), default=0)
        start, bits = np.full((len(parts), deep), -1, np.int64), np.ones((len(parts), deep), np.int64)
        words, at = [np.zeros(0, U64)], 0
        for i, (levels, _) in enumerate(parts):
            for j, w in enumerate(levels):
                start[i, j], bits[i, j] = at, 64 * len(w)
                words.append(w.astype(U64))
                at += len(w)
        flat = np.concatenate(words)
        rank = np.cumsum(np.bitwise_count(flat).astype(np.int64))
        return PerfectHash(buckets, first, start, bits, flat, np.concatenate([[0], rank[:-1]]) if len(rank) else rank, np.concatenate([np.zeros(0, np.uint32), *(k for _, k in parts)]))

    def index(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each key's index (0 if it is none of these) and whether the key kept there is the same."""
        out = np.zeros(len(keys), np.int64)
        b = bucket_of(keys, self.buckets) - self.first
        todo = np.flatnonzero((b >= 0) & (b < len(self.start)))
        for level in range(self.start.shape[1]):
            todo = todo[self.start[b[todo], level] >= 0]
            if not len(todo):
                break
            pos = _salted(keys[todo], level) % self.bits[b[todo], level].astype(U64)
            w, bit = self.start[b[todo], level] + (pos >> U64(6)).astype(np.int64), pos & U64(63)
            word = self.words[w]
            hit = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1))).astype(np.int64)
            out[todo[hit]] = (self.rank[w] + below)[hit]
            todo = todo[~hit]
        return out, (self.keys[out] == keys) if len(self.keys) else np.zeros(len(keys), bool)


def _build_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    levels, keys = build_levels(pdf["key"].to_numpy(np.int64).astype(np.uint32))
    return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "n": [len(keys)], "sizes": [[len(x) for x in levels]], "words": [b"".join(x.tobytes() for x in levels)], "keys": [keys.tobytes()]})


def perfect_hashes(keys: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of distinct ``key``: its levels, and its keys in the order of their indices."""
    at = F.shiftright(F.pmod(F.col("key") * F.lit(0x9E3779B1), F.lit(1 << 32)) * F.lit(buckets), 32)
    return keys.select("key", at.alias("bucket")).groupBy("bucket").applyInPandas(_build_bucket, "bucket long, n long, sizes array<int>, words binary, keys binary")


def _slice(hashes: DataFrame, buckets: int, first: int, last: int) -> PerfectHash:
    """The hash of some buckets, at most ``SLICE`` pairs by count or one bucket, on the driver."""
    rows = {r["bucket"]: r for r in hashes.where(F.col("bucket").between(first, last)).toLocalIterator()}
    parts = []
    for b in range(first, last + 1):
        r = rows.get(b)
        words = np.frombuffer(r["words"], "<u8") if r else np.zeros(0, "<u8")
        cut = np.cumsum([0, *(r["sizes"] if r else [])])
        parts.append(([words[i:j] for i, j in zip(cut, cut[1:], strict=False)], np.frombuffer(r["keys"], np.uint32) if r else np.zeros(0, np.uint32)))
    return PerfectHash.join(buckets, first, parts)


# ---- counts ----

def pair_sums(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """First pass.  Rows of distinct ``keys`` and the documents ``n`` of a task's texts that hold each."""

    def run(batches: Iterator[pa.RecordBatch]):
        keys, n, held = [], [], 0

        def merged():
            u, inv = np.unique(np.concatenate(keys), return_inverse=True)
            return u, np.bincount(inv, np.concatenate(n), len(u)).astype(np.int64)

        def row(u, m):
            return pa.RecordBatch.from_arrays([pa.array([u.astype(np.int64)], pa.list_(pa.int64())), pa.array([m], pa.list_(pa.int64()))], names=["keys", "n"])

        for b in T.blocks(batches):
            u, m = np.unique(align(b, byte_bpe, piece_bpe).keys, return_counts=True)
            keys.append(u)
            n.append(m)
            held += len(u)
            if held > 2 * HELD:
                u, m = merged()
                keys, n, held = [u], [m], len(u)
                if held > HELD:
                    yield row(u, m)
                    keys, n, held = [], [], 0
        if held:
            yield row(*merged())

    return docs.mapInArrow(run, "keys array<long>, n array<long>")


def _add_vectors(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(v, np.int64) for v in pdf["v"]], axis=0)
    return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "part": [pdf["above"].iloc[0]], "v": [total.tobytes()]})


def tree_sum(parts: DataFrame) -> DataFrame:
    """``bucket, part, v`` (vectors of one length within a bucket) summed to one row a bucket, ``FAN`` a step."""
    most = parts.agg(F.max("part")).first()[0] or 0
    while most:
        parts = parts.withColumn("above", F.floor(F.col("part") / FAN)).groupBy("bucket", "above").applyInPandas(_add_vectors, "bucket long, part long, v binary")
        most //= FAN
    return parts


def count_vectors(sums: DataFrame, ph: PerfectHash, sizes: np.ndarray) -> DataFrame:
    """``bucket, part, v``: the document counts of a slice's pairs by index, summed over all tasks."""
    cut = np.concatenate([[0], np.cumsum(sizes)])
    sent = sums.sparkSession.sparkContext.broadcast(ph)

    def run(batches):
        ph, total, some = sent.value, None, False
        for b in batches:
            total = np.zeros(len(ph.keys), np.int64) if total is None else total
            kc, nc = T.column(b, "keys"), T.column(b, "n")
            for i in range(b.num_rows):
                at, same = ph.index(kc[i].values.to_numpy().astype(np.uint32))
                total[at[same]] += nc[i].values.to_numpy()[same]  # a row's keys are distinct
                some = True
        part = TaskContext.get().partitionId()
        for i in range(len(sizes) if some else 0):
            if sizes[i]:
                yield pa.RecordBatch.from_arrays([pa.array([ph.first + i], pa.int64()), pa.array([part], pa.int64()), pa.array([total[cut[i]:cut[i + 1]].tobytes()], pa.binary())], names=["bucket", "part", "v"])

    parts = written(sums.mapInArrow(run, "bucket long, part long, v binary"), "alignment-parts")
    return tree_sum(parts)


def _best(pdf: pd.DataFrame) -> pd.DataFrame:
    a, v = (np.frombuffer(pdf["keys"].iloc[0], np.uint32) >> np.uint32(B_BITS)).astype(np.int64), np.frombuffer(pdf["v"].iloc[0], np.int64)
    best = np.zeros(1 << 16, np.int64)
    np.maximum.at(best, a, v)
    ids = np.flatnonzero(best)
    return pd.DataFrame({"a": ids, "best": best[ids]})


def align_documents(docs: DataFrame, byte_bpe: str, piece_bpe: str, slice_pairs: int | None = None) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links``, ``n_best`` (links whose pair
    counts the most of its A id's pairs), ``count_sum`` and ``groups_sha256``."""
    slice_pairs = slice_pairs or SLICE
    d = texts(docs)
    sums = written(pair_sums(d.select("text"), byte_bpe, piece_bpe), "alignment-sums")
    keys = written(sums.select(F.explode("keys").alias("key")).distinct(), "alignment-keys")
    total = keys.count()
    buckets = max(1, math.ceil(total / min(BUCKET, slice_pairs)))
    hashes = written(perfect_hashes(keys, buckets), "alignment-hashes")
    size = np.zeros(buckets, np.int64)
    for r in hashes.select("bucket", "n").toLocalIterator():  # a number for each bucket
        size[r["bucket"]] = r["n"]
    # consecutive buckets of at most slice_pairs pairs
    cuts, held = [0], 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > slice_pairs:
            cuts, held = [*cuts, i], 0
        held += n
    ranges = list(zip(cuts, [*cuts[1:], buckets], strict=True))
    counts = None
    for lo, hi in ranges:
        part = written(count_vectors(sums, _slice(hashes, buckets, lo, hi - 1), size[lo:hi]).select("bucket", "v"), "alignment-counts")
        counts = part if counts is None else counts.unionByName(part)
    best = np.zeros(1 << 16, np.int64)
    per_a = hashes.select("bucket", "keys").join(counts, "bucket").groupBy("bucket").applyInPandas(_best, "a long, best long").groupBy("a").agg(F.max("best").alias("best"))
    for r in per_a.toLocalIterator():  # one number for each id of A
        best[r["a"]] = r["best"]
    d = d.withColumn("row", F.monotonically_increasing_id())
    if len(ranges) > 1:
        d = written(d, "alignment-rows")
    out = None
    for lo, hi in ranges:
        ph = _slice(hashes, buckets, lo, hi - 1)
        v = {r["bucket"]: r["v"] for r in counts.where(F.col("bucket").between(lo, hi - 1)).toLocalIterator()}
        count = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(v[b], np.int64) for b in range(lo, hi) if b in v)])
        part = _looked_up(d, byte_bpe, piece_bpe, ph, count, best)
        out = part if out is None else out.unionByName(part)
    if len(ranges) > 1:  # each slice has added the links of its own pairs
        same = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        out = out.groupBy(*same).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _looked_up(docs: DataFrame, byte_bpe: str, piece_bpe: str, ph: PerfectHash, count: np.ndarray, best: np.ndarray) -> DataFrame:
    """Second pass: the documents aligned again, with the sums over links whose pair is in the slice."""
    sent = docs.sparkSession.sparkContext.broadcast((ph, count, best))

    def run(batches):
        ph, count, best = sent.value
        for b in T.blocks(batches):
            x = align(b, byte_bpe, piece_bpe, say=True)
            u, inv = np.unique(x.keys, return_inverse=True)
            at, same = ph.index(u)
            n = np.where(same, count[at], 0) if len(count) else np.zeros(len(u), np.int64)
            top = same & (n == best[(u >> np.uint32(B_BITS)).astype(np.int64)])

            def per_doc(v):
                out = np.zeros(b.num_rows, np.int64)
                np.add.at(out, x.doc, v)
                return pa.array(out)

            sha = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in x.strings]
            yield pa.RecordBatch.from_arrays(
                [T.column(b, "row"), T.column(b, "doc_id"), *(pa.array(x.stats[:, i]) for i in range(3)), per_doc(x.times), per_doc(x.times * top[inv]), per_doc(x.times * n[inv]), pa.array(sha)],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return docs.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
