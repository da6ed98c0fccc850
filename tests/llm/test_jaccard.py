import random
import re

import pytest

from ordersmith.llm import jaccard
from ordersmith.llm.common import table
from ordersmith.llm.graph import components
from tests.conftest import MEDIUM


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8):
    sets = {i: shingles(t) for i, t in rows}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    links = {i: set() for i in sets}
    for i, s in sets.items():
        both = {}
        for x in s:
            for j in where[x]:
                both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if j != i and n >= threshold * (len(s) + len(sets[j]) - n):
                links[i].add(j)
        if not s:
            links[i] = {j for j, o in sets.items() if not o and j != i}
    root = {}
    for i in sorted(sets):
        if i in root:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in root:
                root[j] = i
                todo += links[j]
    return {i: (root[i], len(links[i])) for i in sets}


def check(df, rows):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in df.collect()}
    assert len(got) == len(rows)
    want = brute(rows)
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}


def near_groups(seed, groups, size, words=60):
    rng = random.Random(seed)
    rows, n = [], 0
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(rng.randrange(1, size)):
            t = list(base)
            for _ in range(rng.randrange(0, 3)):
                t[rng.randrange(words)] = f"x{rng.randrange(9999)}"
            rows.append((n, " ".join(t)))
            n += 1
    return rows


def test_same_as_brute_force_on_documents(llm):
    d = table(llm, MEDIUM, "documents")
    rows = [(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()]
    check(jaccard.link_documents(d), rows)


@pytest.mark.parametrize("small", [2, 8])
def test_hot_groups_go_to_blocks(llm, docs_of, monkeypatch, small):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = near_groups(3, 6, 60)
    check(jaccard.link_documents(docs_of(rows)), rows)


def test_odd_rows(llm, docs_of):
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "one  two"), (5, "two one"), (6, "a b c d e"), (7, "a b c d e f"), (8, "word " * 30000), (9, "word " * 20)]
    df = docs_of(rows, extra=True)
    check(jaccard.link_documents(df), rows)
    assert jaccard.link_documents(df.limit(0)).count() == 0
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 5, 6, 7, 8]
    twice = df.unionByName(df).unionByName(docs_of([(None, "one two"), (None, None)], extra=True))
    assert sorted((r["doc_id"] for r in jaccard.one_of_each(twice).collect()), key=lambda x: (x is None, x)) == [0, 3, 5, 6, 7, 8, None, None]


def test_ids_that_stand_on_several_texts(docs_of):
    """Against brute force over row numbers: classes, links and survivors do not depend on ids being unique."""
    near = lambda base, k: " ".join([*[f"{base}{i}" for i in range(60)], f"end{k}"])
    rows = [(7, near("a", 0)), (3, near("a", 1)), (7, "a clean text that stands alone here"), (9, near("b", 0)), (9, near("c", 0)), (11, near("b", 1)), (12, near("c", 1)),
            (20, near("d", 1)), (20, near("d", 0)), (None, near("e", 0)), (None, near("e", 1)), (30, near("e", 2))]
    want = brute(list(enumerate((t for _, t in rows))))
    low = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            low[want[n][0]] = min(i, low.get(want[n][0], i))
    df = docs_of(rows, extra=True)
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.link_documents(df).collect()), key=str)
    assert got == sorted(((i, low[want[n][0]], want[n][1]) for n, (i, _) in enumerate(rows)), key=str)
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(3, near("a", 1)), (7, rows[2][1]), (9, near("b", 0)), (9, near("c", 0)), (20, near("d", 0)), (None, near("e", 0)), (None, near("e", 1)), (30, near("e", 2))], key=str)


def test_bands_reach_the_recall():
    bands, rows = jaccard.bands_for(0.8, 0.9999)
    assert bands * rows <= 128 and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


def test_components_on_random_graphs(llm):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 430)] + [(500, 501 + i) for i in range(50)]
    root = {i: i for e in edges for i in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(llm.createDataFrame(edges, "a long, b long")).collect()
    linked = {i for a, b in edges if a != b for i in (a, b)}
    assert {r["node"]: r["root"] for r in got} == {i: find(i) for i in linked} and len(got) == len(linked)
