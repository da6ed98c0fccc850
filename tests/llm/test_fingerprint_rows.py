"""op4 on odd rows: edited texts, the next document's likeness, equal texts."""

import hashlib
from collections import Counter

import pyarrow as pa

from ordersmith.llm import fingerprints
from ordersmith.llm import textops as T

BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [(5, BASE), (1, "héllo 東京 🙂 ab"), (3, None), (2, ""), (9, BASE), (7, "x"), (8, "a b c d e f g " * 500), (-4, BASE.replace("w7 ", "z ")), (6, " \n\t ")]


def test_values_on_odd_rows(llm, docs_of):
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs_of(ROWS, extra=True).repartition(4)).collect()}
    order = sorted((i, t or "") for i, t in ROWS)
    assert len(got) == len(ROWS)
    for (i, t), (j, n) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()
        a, b = got[i]["fingerprint"], got[j]["fingerprint"]
        same = sum(a[k:k + 8] == b[k:k + 8] for k in range(0, len(a), 8)) / (len(a) // 8)
        if t.split() and n.split():
            assert got[i]["near_next"] == same
        else:  # without words: alike to each other alone
            assert got[i]["near_next"] == float(not t.split() and not n.split())
    assert got[5]["fingerprint"] == got[9]["fingerprint"] != got[-4]["fingerprint"]
    assert {i: got[i]["class_id"] for i in (5, 9, -4, 7)} == {5: -4, 9: -4, -4: -4, 7: 7}


def test_null_and_repeated_ids_over_many_ranges(llm, docs_of):
    rows = [(None, f"n{i % 5} text") for i in range(60)] + [(4, f"r{i} of four") for i in range(40)] + [(i, f"doc {i} is here") for i in range(10, 90)]
    got = fingerprints.fingerprint_edits(docs_of(rows).repartition(6)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    # ids that stand alone have a known next document
    by = {r["doc_id"]: r for r in got}
    for i in range(10, 89):
        t, n = f"doc {i} is here", f"doc {i + 1} is here"
        assert by[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest()


def test_empty_table(llm, docs_of):
    assert fingerprints.fingerprint_edits(docs_of([])).collect() == []


def test_blocks_are_bounded_by_unpacked_bytes():
    sizes = [10, 10, 10, 90, 5, 0, 20]
    batch = pa.RecordBatch.from_arrays([pa.array([b"z"] * len(sizes), pa.binary()), pa.array(sizes, pa.int64())], names=["z", "n"])
    got = [b.column("n").to_pylist() for b in T.blocks([batch], "z", 30, "n")]
    assert got == [[10, 10, 10], [90], [5, 0, 20]]
