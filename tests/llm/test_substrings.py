import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ordersmith.llm import substrings
from ordersmith.llm.common import table
from tests.conftest import MEDIUM


def brute(rows, window=20):
    """Windows as tuples of words, in the order of ids (null first)."""
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    seen, out = set(), Counter()
    for i, w in docs:
        gone = set()
        for p in range(len(w) - window + 1):
            x = tuple(w[p:p + window])
            if x in seen:
                gone.update(range(p, p + window))
            seen.add(x)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_same_as_brute_force_on_documents(llm):
    d = table(llm, MEDIUM, "documents")
    assert got(substrings.remove_repeats(d)) == brute([tuple(r) for r in d.select("doc_id", "text").collect()])


def passages(seed, n=150, few=False):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3 if few else 500)]
    shared = [[rng.choice(words) for _ in range(rng.randrange(15, 90))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = []
        for _ in range(rng.randrange(0, 5)):
            t += [rng.choice(words) for _ in range(rng.randrange(0, 30))]
            p = rng.choice(shared)
            lo = rng.randrange(0, 8)
            t += p[lo:len(p) - rng.randrange(0, 8)]
        rows.append((3 * ((i * 37) % n), rng.choice([" ", "\n", "\t  "]).join(t)))
    return rows


@pytest.mark.parametrize("window,base,few", [(20, 10, False), (20, 5, False), (40, 10, False), (20, 10, True), (8, 8, True)])
def test_passages_by_levels(llm, docs_of, monkeypatch, window, base, few):
    monkeypatch.setattr(substrings, "HELD", 300)
    rows = passages(window + base, few=few)
    assert got(substrings.remove_repeats(docs_of(rows).repartition(5), window, base)) == brute(rows, window)


def test_odd_rows(llm, docs_of):
    long = " ".join(f"x{i}" for i in range(30000))
    fifty = " ".join(f"p{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \n\t"), (5, fifty), (4, "start " + fifty + " end"), (6, fifty.replace(" ", "\n ")), (7, " ".join(["same"] * 60)), (8, "same " * 19), (9, "same " * 19),
            (None, fifty[:120]), (10, long), (11, long + " tail"), (12, "a \x0b b\x0cc é 東京"), (13, "  ".join(["p1", "p2"] * 12)), (-5, "neg " + fifty)]
    assert got(substrings.remove_repeats(docs_of(rows, extra=True))) == brute(rows)
    # repeated ids and rows: some order among them, and the first keeps its words
    twice = got(substrings.remove_repeats(docs_of([(1, fifty), (1, fifty), (1, fifty + " more"), (None, fifty + " x"), (None, fifty + " x")])))
    assert sorted((i or 0, n, r) for (i, n, r, _), k in twice.items() for _ in range(k)) in ([(0, 51, 0), (0, 51, 51), (1, 50, 50), (1, 50, 50), (1, 51, 50)],)


def test_empty_table(llm, docs_of):
    assert substrings.remove_repeats(docs_of([])).collect() == []


def test_hot_passage_is_one_row_a_share(llm, docs_of):
    rows = docs_of([(i, f"u{i} " + " ".join(f"p{k}" for k in range(40))) for i in range(400)]).coalesce(2)
    packed = substrings.pack(rows).selectExpr("row as id", "z")
    found = substrings.examine(packed, 20, 20, 20)
    per = found.groupBy("h", "g").agg({"*": "count"}).where("`count(1)` > 1").join(found.where("not settled"), ["h", "g"]).groupBy("h", "g").count()
    assert max(r["count"] for r in per.collect()) <= 2
    first = substrings.repeated_windows(found).where("first").select("id").distinct().collect()
    assert len(first) == 1


def test_doubled_hashes_tell_windows_apart():
    rng = np.random.default_rng(3)
    h, doc = rng.integers(1, 4, 400).astype(np.uint64), np.sort(rng.integers(0, 5, 400))
    for length in (3, 6, 12, 24):
        x, there = substrings.doubled(h, doc, length, 3)
        by = {}
        for p in np.flatnonzero(there):
            assert doc[p] == doc[p + length - 1]
            by.setdefault(int(x[p]), set()).add(tuple(h[p:p + length].tolist()))
        assert all(len(v) == 1 for v in by.values())
        assert len(by) == len(set().union(*by.values()))
        assert there.sum() == sum(max(0, int((doc == d).sum()) - length + 1) for d in range(5))


def test_windows_are_shuffled_without_being_written(llm, docs_of, monkeypatch):
    names, keep = [], substrings.written
    monkeypatch.setattr(substrings, "written", lambda df, name: names.append(name) or keep(df, name))
    rows = passages(5)
    assert got(substrings.remove_repeats(docs_of(rows).repartition(5))) == brute(rows)
    assert names == ["substrings-texts", "substrings-ranks", "substrings-cut"]
