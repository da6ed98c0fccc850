import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ordersmith.llm import lexical
from ordersmith.llm.common import table
from tests.conftest import MEDIUM


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=20):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(x for _, c in tf for x in c)
    out = []
    for item, text in items:
        rows = []
        for i, c in tf:
            n = sum(c.values())
            m = 75 + 25 * n * n_docs // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1000000000 * c[x] // (1000 * c[x] + 12 * m)) for x in terms(text) if c[x])
            if s > 0:
                rows.append((-s, i is not None, i or 0))
        out += [(item, k + 1, i if there else None, -s) for k, (s, there, i) in enumerate(sorted(rows)[:top])]
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 AS score", "2 AS rank", "'x' AS doc_id")


def test_same_as_brute_force_on_documents(llm):
    d, b = table(llm, MEDIUM, "documents"), table(llm, MEDIUM, "benchmark")
    want = brute([tuple(r) for r in d.select("doc_id", "text").collect()], [tuple(r) for r in b.select("item_id", "text").collect()])
    assert got(lexical.rank_documents(d, b)) == want


def rows_with_ties(seed, n=700):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.6))}" for _ in range(400)]
    rows = [(rng.randrange(n), " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))) for _ in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(200)]          # copies: ties by id
    rows += [(None, rows[7][1]), (None, None), (1, None), (2, ""), (3, "... --"), (4, "Zed ZED zed Ünïcode ünïcode 東京 a_b"), (5, "zed " * 30000)]
    return rows, [(1, rows[5][1]), (1, rows[5][1]), (2, "zed ZED"), (3, None), (4, ""), (5, "?!"), (None, "t1 t1 t1 t2"), (6, "ünïcode Ünïcode 東京"), (7, "nowhere"), (8, " ".join(vocabulary))]


@pytest.mark.parametrize("blocks", [False, True])
def test_odd_rows_ties_and_blocks(llm, docs_of, monkeypatch, blocks):
    rows, items = rows_with_ties(2)
    if blocks:
        monkeypatch.setattr(lexical, "ITEMS", 3)
        monkeypatch.setattr(lexical, "RUN", 100)
    assert got(lexical.rank_documents(docs_of(rows, extra=True).repartition(7), items_of(llm, items))) == brute(rows, items)


def test_empty_tables(llm, docs_of):
    assert lexical.rank_documents(docs_of([]), items_of(llm, [(1, "a")])).collect() == []
    assert lexical.rank_documents(docs_of([(1, "a")]), items_of(llm, [])).collect() == []
    assert lexical.rank_documents(docs_of([(1, None)]), items_of(llm, [(1, "a")])).collect() == []


def make_tree(seed, leaf=4, n=500, terms=60):
    rng = np.random.default_rng(seed)
    docs = sorted((tuple(sorted(set((rng.zipf(1.4, rng.integers(1, 12)) % terms).tolist()))), i) for i in range(n))
    off = np.concatenate([[0], np.cumsum([len(v) for v, _ in docs])])
    t = np.concatenate([np.array(v) for v, _ in docs])
    weights = rng.integers(0, 5000, terms)
    tree = lexical.Tree(np.array([i for _, i in docs]), np.zeros(n, bool), rng.integers(75, 300, n), off, t, rng.integers(1, 9, len(t)), weights, leaf)
    return tree, rng.integers(0, 2, (8, terms)) * (rng.random((8, terms)) < 0.2)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_below_every_node_and_prune(seed):
    tree, times = make_tree(seed)
    bounds = tree.bounds(times)
    doc = np.repeat(np.arange(len(tree.ids)), np.diff(tree.off))
    for i in range(len(times)):
        scores = np.bincount(doc, tree.value * times[i][tree.terms], len(tree.ids)).astype(np.int64)
        for k, x in enumerate(tree.nodes):
            assert bounds[i, k] >= scores[x.lo:x.hi].max()
            if x.children:  # children cover a node's documents in order
                c = [tree.nodes[j] for j in x.children]
                assert c[0].lo == x.lo and c[-1].hi == x.hi and all(p.hi == q.lo for p, q in zip(c, c[1:], strict=False))
        best, seen = tree.search(bounds[i], times[i], [], 5)
        want = sorted((-s, True, int(d)) for s, d in zip(scores.tolist(), tree.ids, strict=True) if s > 0)[:5]
        assert best == want
        assert seen < sum(not x.children for x in tree.nodes)


def test_shared_paths_are_shared():
    terms = np.array([0, 1, 2, 0, 1, 2, 3, 0, 1, 4, 0, 5])
    nodes = lexical._depth_first(np.array([0, 3, 7, 10, 12]), terms, 1)
    assert sorted((x.lo, x.hi) for x in nodes) == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 2), (2, 3), (3, 4)]
