"""MinHash document fingerprints and their likeness.

A fingerprint holds the minima of ``PERMUTATIONS`` universal permutations over
the five-word shingles of a whole text, as hexadecimal text; equal texts have
equal fingerprints.  Texts of fewer than five words have one shingle of all
their words.  Texts without a word (null: empty) have the empty fingerprint's
fixed value; their likeness is 1 to each other and 0 to all else.

Near duplicates are found from bands of the same minima: documents of one
shingle set (so of one fingerprint) are collapsed first, equal bands are joined
with hot buckets split into blocks, and Jaccard is verified on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import jaccard
from . import textops as T
from .common import sendable, texts, written

PERMUTATIONS = 128
SHINGLE = 5


def _signatures(col: pa.Array, mh: T.MinHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The minima of each text, and the key and size of its shingle set."""
    data, off = T.utf8(col)
    h, doc, _, _ = T.words(data, off)
    sh, sd = T.shingles(h, doc, SHINGLE, len(col))
    return mh.signatures(sh, sd, len(col)), *jaccard.set_keys(sh, sd, len(col))


def _bytes(sig: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in sig.astype(">u4")], pa.binary())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal minima; a text without words is unlike any with words."""
    void_a, void_b = (a == 0xFFFFFFFF).all(axis=1), (b == 0xFFFFFFFF).all(axis=1)
    return np.where(void_a | void_b, (void_a & void_b).astype(float), (a == b).mean(axis=1))


def near_duplicates(docs: DataFrame, threshold: float = jaccard.THRESHOLD, recall: float = jaccard.RECALL, permutations: int = PERMUTATIONS, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The documents with their class key, and the classes of documents that links
    connect (Jaccard of the five-word sets at least ``threshold``), see ``jaccard.groups``.
    As many bands as the fingerprint's minima allow, of as many rows as ``recall`` allows."""
    _, rows = jaccard.bands_for(threshold, recall, permutations)
    return jaccard.groups(docs, permutations // rows, rows, seed, permutations, threshold)


def ranges(ids: DataFrame, order: str, parts: int | None = None) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
    """How to deal rows out by ranges of ``order`` (null is smaller than any value): for
    values of it, the places of the rows to send, the range of each, and which of them
    are halo.  The first row of each range also goes to the range before it (the first
    row of all to the last), so no task sees more than a few ranges and their
    successors' first rows.  ``ids``: that column from a cheap scan; None if it is empty.
    """
    spark = ids.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(1 << 63)
    k = ids.select(F.coalesce(F.col(order), F.lit(low)).alias("k"))
    found = sorted({int(x) for x in k.approxQuantile("k", [i / parts for i in range(1, parts)], 0.1 / parts)})
    cuts = np.array(found, np.int64)

    def least(batches):
        for b in batches:
            v = np.sort(b.column("k").to_numpy(zero_copy_only=False))
            to, at = np.unique(np.searchsorted(cuts, v, "right"), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(v[at], pa.int64())], names=["b", "k"])

    # a row for each range that holds rows
    firsts = {r["b"]: r["k"] for r in k.mapInArrow(least, "b int, k long").groupBy("b").agg(F.min("k").alias("k")).collect()}
    if not firsts:
        return None
    there = sorted(firsts)
    heads = np.array([firsts[r] for r in there], np.int64)
    before = np.array([there[i - 1] for i in range(len(there))], np.int32)

    def deal(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = pc.fill_null(col, low).to_numpy(zero_copy_only=False)
        own = np.searchsorted(cuts, v, "right").astype(np.int32)
        i = np.minimum(np.searchsorted(heads, v), len(heads) - 1)
        again = np.flatnonzero(heads[i] == v)
        at = np.concatenate([np.arange(len(v)), again])
        return at, np.concatenate([own, before[i[again]]]), np.arange(len(at)) >= len(v)

    return deal


def with_next(dealt: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Each row with the given columns of the row after it in ascending ``order`` (after
    the last: of the first), as ``next_<column>``; ties are ordered by those columns.
    ``dealt``: rows with their range ``_b`` and ``_halo``, as ``ranges`` deals them out."""
    w = Window.partitionBy("_b").orderBy("_halo", F.col(order).asc_nulls_first(), *columns)
    return dealt.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in columns)).where("not _halo").drop("_b", "_halo")


def edited_text(text: str, following: str) -> str:
    """``text`` whose last half (rounded down, in code points) is replaced by as
    many code points, or all, from the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def packed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text compressed (``z``), about a third of its bytes, with its bytes
    unpacked (``z_bytes``) and its range (``_b``, ``_halo``): what is dealt out and
    sorted, so that whole texts cost less on the way."""
    d = texts(docs)
    deal = ranges(d.select("doc_id"), "doc_id")

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for b in T.blocks(batches):
            col, ids = T.column(b, "text").cast(pa.large_binary()), T.column(b, "doc_id")
            z, size = pa.array([pack(x.as_buffer()) for x in col], pa.binary()), pc.cast(pc.binary_length(col), pa.int64())
            at, to, halo = deal(ids)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in (ids, z, size)), pa.array(to), pa.array(halo)], names=["doc_id", "z", "z_bytes", "_b", "_halo"])

    return d.mapInArrow(run, "doc_id long, z binary, z_bytes long, _b int, _halo boolean")


def fingerprint_edits(docs: DataFrame, permutations: int = PERMUTATIONS, seed: int = 7) -> DataFrame:
    """Fingerprints of each text, of its edited text, their likeness, and ``class_id``:
    the smallest id of the near-duplicate group (of a group without ids: null)."""
    _, classes = near_duplicates(docs, permutations=permutations, seed=seed)
    # a document without copies or links is its own class
    grouped = written(classes.where("n_copies > 1 or not class_id <=> copy_of").select(*jaccard.KEY, "class_id", F.lit(True).alias("grouped")), "fingerprints-classes")
    # a fingerprint is as costly to send as to make again, so texts alone are dealt out
    f = with_next(packed_texts(docs), "doc_id", ["z"])

    def run(batches):
        import zstandard

        mh = T.MinHash(permutations, seed)
        for b in T.blocks(batches, "z", T.BLOCK_BYTES // 2, "z_bytes"):
            unpack = zstandard.ZstdDecompressor().decompress
            # a row's following text is mostly the next row's own: each is unpacked and signed once
            at: dict[bytes, int] = {}
            mine, theirs = ([at.setdefault(x.as_py(), len(at)) for x in T.column(b, c)] for c in ("z", "next_z"))
            each = [unpack(z).decode() for z in at]
            sig, key, size = _signatures(pa.array(each, pa.large_string()), mh)
            text = [each[i] for i in mine]
            edited = [edited_text(t, each[i]) for t, i in zip(text, theirs, strict=True)]
            ed = _signatures(pa.array(edited, pa.large_string()), mh)[0]
            own, nxt, key, size = sig[mine], sig[theirs], key[:, mine], size[mine]
            yield pa.RecordBatch.from_arrays(
                [T.column(b, "doc_id"), pa.array([len(t) for t in text], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), _bytes(own), _bytes(ed), pa.array(likeness(own, ed)), pa.array(likeness(own, nxt)),
                 pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)), pa.array(size)],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", *jaccard.KEY])

    out = f.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, k1 long, k2 long, n_shingles long")
    out = out.join(sendable(grouped), jaccard.KEY, "left").withColumn("class_id", F.when(F.col("grouped"), F.col("class_id")).otherwise(F.col("doc_id")))
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}).drop(*jaccard.KEY, "grouped")
