"""Vectorised text primitives for Arrow batches (numpy inside Spark tasks).

Every function works on the UTF-8 bytes of a whole block of texts at once:
no Python loop over words.  Hashes depend only on the bytes, never on the
process, so they may be shuffled and joined across executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text handled at a time (one longer text is handled alone).
BLOCK_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = U64(0x9E3779B97F4A7C15 | 1)
_STEP = 1 << 16


def _powers(base: np.ndarray, n: int) -> np.ndarray:
    out = np.repeat(base, n)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(np.array([_BASE]), _STEP)
_HIGH = _powers(_POW[-1:] * _BASE, _STEP)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and xor-shift rounds)."""
    x = (x ^ (x >> U64(33))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    col = batch.column(name)
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a string column; null counts as empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    at = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def blocks(batches, text: str = "text", limit: int = BLOCK_BYTES, size_in: str | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes (one row at least).
    ``size_in``: the column that holds those bytes, where ``text`` itself is compressed."""
    for b in batches:
        if not b.num_rows:
            continue
        size = column(b, size_in) if size_in else pc.binary_length(column(b, text))
        size = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every run of non-space bytes."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    tok = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = tok.copy()
    first[1:] &= ~tok[:-1] | edge[1:n]
    last = tok.copy()
    last[:-1] &= ~tok[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def gather(starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all elements of the spans, and each one's place in its span."""
    begin = np.cumsum(lens) - lens
    local = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(begin, lens)
    return np.repeat(starts, lens) + local, local


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span's elements (empty spans: of nothing)."""
    lens = ends - starts
    out = np.zeros(len(starts), U64)
    total = np.cumsum(lens)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (1 << 20), "right")))
        ln = lens[lo:hi]
        full = ln > 0
        if int(ln.max(initial=0)) <= 64:  # one pass per position over the spans that reach it
            h, who, at = np.zeros(hi - lo, U64), np.flatnonzero(full), starts[lo:hi]
            for i in range(int(ln.max(initial=0))):
                who = who[ln[who] > i] if i else who
                h[who] += (data[at[who] + i].astype(U64) + U64(1)) * _POW[i]
            out[lo:hi] = h
        elif full.any():
            pos, local = gather(starts[lo:hi], ln)
            w = _POW[local & (_STEP - 1)]
            if ln.max() > _STEP:
                w = w * _HIGH[(local >> 16) & (_STEP - 1)]
            v = (data[pos].astype(U64) + U64(1)) * w
            out[lo:hi][full] = np.add.reduceat(v, (np.cumsum(ln) - ln)[full])
        lo = hi
    return mix(out + lens.astype(U64) * U64(0xA24BAED4963EE407))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document, start and end of every word ``[^\\x20\\x09-\\x0D]+``."""
    starts, ends, doc = spans(data, offsets)
    return hash_spans(data, starts, ends), doc, starts, ends


_ODD = mix(np.arange(1, 65, dtype=U64)) | U64(1)


def windows(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``size``-word window within a document, and its first word's index."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    s = np.zeros(n, U64)
    for i in range(size):
        s += h[i:i + n] * _ODD[i]
    at = np.flatnonzero(doc[:n] == doc[size - 1:])
    return mix(s[at]), at


def shingles(h: np.ndarray, doc: np.ndarray, size: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and their documents, in document order.  A document of
    fewer than ``size`` words has one shingle of all its words; none without words."""
    wh, at = windows(h, doc, size)
    wd = doc[at]
    count = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(doc, short)
        s = np.full(len(short), 0x51ED270B, U64)
        for i in range(size - 1):
            has = count[short] > i
            s[has] += h[first[has] + i] * _ODD[i + size]
        wh, wd = np.concatenate([wh, mix(s)]), np.concatenate([wd, short])
        order = np.argsort(wd, kind="stable")
        wh, wd = wh[order], wd[order]
    return wh, wd


def sets(sh: np.ndarray, doc: np.ndarray, n_docs: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each document."""
    at = np.searchsorted(doc, np.arange(n_docs + 1))
    return [np.unique(sh[at[i]:at[i + 1]]) for i in range(n_docs)]


class MinHash:
    """Universal permutations ``x -> a*x + b (mod 2**32)``, a odd, over mixed shingles."""

    def __init__(self, n: int, seed: int = 7):
        v = mix(np.arange(1, 2 * n + 1, dtype=U64) + np.array([seed], U64) * U64(0x632BE59BD9B4E019))
        self.a = ((v[:n] >> U64(32)).astype(np.uint32) | np.uint32(1))[:, None]
        self.b = (v[n:] >> U64(32)).astype(np.uint32)[:, None]
        self.n = n

    def signatures(self, sh: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """One row of minima per document; all ones for a document without shingles."""
        out = np.full((n_docs, self.n), 0xFFFFFFFF, np.uint32)
        x = (sh >> U64(32)).astype(np.uint32)
        at = np.searchsorted(doc, np.arange(n_docs + 1))
        step = 2048
        for i in range(n_docs):
            for lo in range(int(at[i]), int(at[i + 1]), step):
                part = x[None, lo:min(lo + step, int(at[i + 1]))] * self.a
                part += self.b
                np.minimum(out[i], part.min(axis=1), out=out[i])
        return out


# ---- sub-word tokens, counted from cached pre-tokens ----

_LETTER, _DIGIT, _OTHER = 1, 2, 3


def _classes(limit: int) -> np.ndarray:
    import unicodedata

    kind = {"L": _LETTER, "N": _DIGIT}
    out = np.array([kind.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(limit)], np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = 0
    return out


class WordPieces:
    """Token ids of whole texts under a lower-casing BPE with word ends.

    Such a tokenizer splits a text into pre-tokens (contraction, letters, one
    digit, other signs) and encodes each one alone.  So the distinct pre-tokens
    of a block are encoded by the tokenizer itself and remembered; a text's
    ids are gathered from them.  Texts with characters outside the plain range
    below go to the tokenizer whole.
    """

    #: Outside these, normalisation may change more than case.
    UNSAFE = r"[^\t\n\r\x20-\x7eÀ-į]|<\|"
    KEEP = 400_000

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.unsafe = re.compile(self.UNSAFE)
        self.cls = _classes(0x130)
        vocab = self.tok.get_vocab()
        #: A pre-token's last id is one whose token bears the word-end mark.
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        from array import array

        self.known: dict[int, int] = {}
        self.flat = array("I")
        self.off = array("q", [0])

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def pretokens(self, text: str) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The lower-cased text, its code points, and each pre-token's start and end."""
        low = text.lower()
        cp = np.frombuffer(low.encode("utf-32-le"), np.uint32)
        if not len(cp):
            z = np.zeros(0, np.int64)
            return low, cp, z, z
        c = self.cls[cp]
        start = c > 0
        start[1:] &= (c[1:] != c[:-1]) | (c[1:] == _DIGIT)
        q = np.flatnonzero(start & (cp == 39))
        if len(q):
            pad = np.concatenate([cp, np.zeros(3, np.uint32)])
            n1, n2 = pad[q + 1], pad[q + 2]
            two = ((n1 == ord("r")) & (n2 == ord("e"))) | ((n1 == ord("v")) & (n2 == ord("e"))) | ((n1 == ord("l")) & (n2 == ord("l")))
            one = np.isin(n1, [ord(x) for x in "stmd"])
            q, size = q[one | two], np.where(two, 3, 2)[one | two]
            start[q + 1] = False
            after = q + size
            ok = after < len(cp)
            start[after[ok]] |= c[after[ok]] == _LETTER
        s = np.flatnonzero(start)
        stop = np.append(s[1:], len(cp))
        gap = np.flatnonzero(c == 0)
        if len(gap):
            k = np.searchsorted(gap, s)
            stop = np.minimum(stop, np.where(k < len(gap), gap[np.minimum(k, len(gap) - 1)], len(cp)))
        return low, cp, s, stop

    def _ids_at(self, low: str, cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start in ``flat`` and number of ids of each pre-token."""
        uniq, first, inv = np.unique(hash_spans(cp, s, e), return_index=True, return_inverse=True)
        if len(self.known) + len(uniq) > self.KEEP:
            self.clear()
        keys = uniq.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        for part in range(0, len(new), 20_000):
            some = new[part:part + 20_000]
            ids = np.array(self.encode_whole([" ".join([low[s[first[i]]:e[first[i]]] for i in some])])[0], np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                raise ValueError("the tokenizer does not mark the end of each pre-token")
            self.known.update(zip((keys[i] for i in some), range(len(self.off) - 1, len(self.off) - 1 + len(some)), strict=True))
            self.off.extend((stops + len(self.flat)).tolist())
            self.flat.frombytes(ids.tobytes())
        k = np.fromiter((self.known[x] for x in keys), np.int64, len(keys))
        off = np.frombuffer(self.off, np.int64)
        at, size = off[k], off[k + 1] - off[k]
        del off
        return at[inv], size[inv]

    def _plain(self, texts: list[str]) -> tuple[list[int], list[int]]:
        plain, odd = [], []
        for i, t in enumerate(texts):
            (odd if ("<|" in t if t.isascii() else self.unsafe.search(t)) else plain).append(i)
        return plain, odd

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain, odd = self._plain(texts)
        if plain:
            low, cp, s, e = self.pretokens("\n".join(texts[i] for i in plain))
            at, size = self._ids_at(low, cp, s, e)
            pos, _ = gather(at, size)
            flat = np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.zeros(0, np.uint32)
            all_ids = flat[pos]
            del flat
            # lower() keeps the length within the plain range, so line breaks stay in place
            cut = np.cumsum([len(texts[i]) + 1 for i in plain])
            total = np.concatenate([[0], np.cumsum(size)])
            ends = total[np.searchsorted(s, cut)]
            for i, a, b in zip(plain, np.append(0, ends[:-1]), ends, strict=True):
                out[i] = all_ids[a:b]
        for i, ids in zip(odd, self.encode_whole([texts[i] for i in odd]), strict=True):
            out[i] = np.array(ids, np.uint32)
        return out


_PIECES: dict[str, WordPieces] = {}


def word_pieces(path: str) -> WordPieces:
    """One tokenizer per worker process and file."""
    if path not in _PIECES:
        _PIECES[path] = WordPieces(path)
    return _PIECES[path]
