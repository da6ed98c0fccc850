import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest

from ordersmith.llm import alignment
from ordersmith.llm.common import table
from tests.conftest import SMALL


def paths():
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole():
    """Encodes whole texts: ids and bytes of both tokenizers, or nothing."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths()[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths()[1])
    level = alignment.byte_level()
    assert len(set(level.values())) == 256

    def run(text):
        want = (" " + (text or "")).encode()
        ia, ib = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        ta = [bytes(level[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in ia]
        tb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        return (ia, ta, ib, tb) if text and b"".join(ta) == want == b"".join(tb) else None

    return run


def brute(rows, whole):
    """The query's columns from whole texts, pair by pair."""
    seen, pairs = [], Counter()
    for i, t in rows:
        got = whole(t)
        groups = []
        if got:
            ia, ta, ib, tb = got
            ea, eb = list(itertools.accumulate(map(len, ta))), list(itertools.accumulate(map(len, tb)))
            both = sorted(set(ea) & set(eb))
            groups = [([x for x, e in zip(ia, ea, strict=True) if lo < e <= hi], [x for x, e in zip(ib, eb, strict=True) if lo < e <= hi]) for lo, hi in zip([0, *both], both, strict=False)]
        linked = [(x, y) for p, q in groups for x in p for y in q]
        pairs.update(set(linked))
        seen.append((i, groups, linked))
    best = Counter()
    for (x, _), n in pairs.items():
        best[x] = max(best[x], n)
    out = []
    for i, groups, linked in seen:
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((i, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(linked), sum(pairs[z] == best[z[0]] for z in linked), sum(pairs[z] for z in linked),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return Counter(out)


ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a\n b\n  c \n  d\t e"), (6, "x   y   z　 w\u0085 v"), (7, "it's ▁ marked"), (8, "<|endoftext|> is plain<|endoftext|>"),
       (9, "=" * 700 + " " * 300 + "z"), (10, "naïve café ólé 東京 データ 🙂 x"), (11, "é \x00 \x1f a"), (12, "\n"), (13, "a b "), (13, "a b "), (None, "who am I"), (14, "tail\n"), (15, "1234 5.6e7 &amp;"),
       (16, "word " * 3000), (17, "x" * 5000), (18, "​ zero​ width"), (19, "<s> </s> <unk> <0x41>"), (20, "\r\nwin\r\n dows ")]


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_same_as_whole_texts(llm, whole):
    d = table(llm, SMALL, "documents")
    assert got(alignment.align_documents(d, *paths())) == brute([tuple(r) for r in d.select("doc_id", "text").collect()], whole)


@pytest.mark.parametrize("slice_pairs", [None, 40])
def test_odd_texts_and_slices(llm, docs_of, whole, monkeypatch, slice_pairs):
    monkeypatch.setattr(alignment, "FAN", 2)
    rows = docs_of(ODD, extra=True).repartition(5)
    assert got(alignment.align_documents(rows, *paths(), slice_pairs=slice_pairs)) == brute(ODD, whole)


def test_random_texts_by_units(whole):
    import pyarrow as pa

    rng = random.Random(4)
    bits = ["word", " ", "  ", "\n", "\t", "é", "東", " ", " ", "　", "'s", "12", ".", "</s>", "🙂", "▁", "the ", " of", "\r\n", "Ünï", "́", "\x00"]
    rows = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    x = alignment.align(pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"]), *paths(), say=True)
    for i, t in enumerate(rows):
        w = whole(t)
        assert x.stats[i, :2].tolist() == ([len(w[0]), len(w[2])] if w else [0, 0]), repr(t)
        if w:
            groups = [g.split("|") for g in x.strings[i].split(";")]
            assert [int(k) for p, _ in groups for k in p.split(",")] == w[0], repr(t)
            assert [int(k) for _, q in groups for k in q.split(",")] == w[2], repr(t)


def test_empty_table(llm, docs_of):
    df = alignment.align_documents(docs_of([]), *paths())
    assert df.collect() == [] and df.columns[0] == "doc_id"


@pytest.mark.parametrize("n", [0, 1, 70_000])
def test_perfect_hash_is_minimal_and_verified(n):
    keys = np.random.default_rng(1).choice(1 << 31, n + 1000, replace=False).astype(np.uint32)
    own, other = keys[:n], keys[n:]
    buckets = 3
    at = alignment.bucket_of(own, buckets)
    ph = alignment.PerfectHash.join(buckets, 0, [alignment.build_levels(own[at == b]) for b in range(buckets)])
    i, same = ph.index(own)
    assert same.all() and sorted(i.tolist()) == list(range(n))
    assert not ph.index(other)[1].any()
    part = alignment.PerfectHash.join(buckets, 1, [alignment.build_levels(own[at == 1])])  # a slice knows its own alone
    assert (part.index(own)[1] == (at == 1)).all()


def test_vectors_add_up_in_a_tree(llm):
    rows = [(b, p, np.array([b, p, 1], np.int64).tobytes()) for b in range(3) for p in range(70)]
    got = {r["bucket"]: np.frombuffer(r["v"], np.int64).tolist() for r in alignment.tree_sum(llm.createDataFrame(rows, "bucket long, part long, v binary")).collect()}
    assert got == {b: [70 * b, sum(range(70)), 70] for b in range(3)}
