"""Kept segment trees: batches of edits against plain re-encoding, and what they encode."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordersmith.llm import token_counts as C
from ordersmith.llm.common import table
from tests.conftest import SMALL
from tests.llm.test_operators import ODD

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
EDITS = "doc_id long, seq int, start long, stop long, new string"


@pytest.fixture(scope="module")
def count():
    tok = Tokenizer.from_file(TOKENIZER)
    return lambda t: len(tok.encode(t, add_special_tokens=False).ids)


def plain(text, edits):
    for _, a, z, new in sorted(edits):
        a = min(max(a, 0), len(text))
        z = min(max(z, a), len(text))
        text = text[:a] + (new or "") + text[z:]
    return text


def batch(rng, ids, times):
    return [(i, k, (a := rng.randrange(3000)), a + rng.randrange(60), rng.choice(["", " word", "it's\n", "日本 x", "a" * 700, None])) for i in ids for k in range(times)]


@pytest.mark.parametrize("sent", [C.SENT_BYTES, 0])
def test_batches_on_kept_trees(llm, docs_of, count, monkeypatch, sent):
    monkeypatch.setattr(C, "SENT_BYTES", sent)
    rng = random.Random(4)
    some = [(r["doc_id"] + 100, r["text"]) for r in table(llm, SMALL, "documents").orderBy("doc_id").limit(40).collect()]
    rows = [*ODD, *ODD[:2], (6, ODD[6][1]), *some]
    now = [(i, t or "") for i, t in rows]
    kept = C.keep(docs_of(rows, extra=True), TOKENIZER)
    assert Counter(map(tuple, C.totals(kept).collect())) == Counter((i, count(t)) for i, t in now)
    for _ in range(2):
        e = batch(rng, [None, 1, 6, 7, 101, 105, 999], 3)
        got = C.edit(kept, C.by_id(kept, llm.createDataFrame(e, EDITS)), TOKENIZER)
        kept = C.settled(kept, got)
        now = [(i, plain(t, [x[1:] for x in e if x[0] == i])) for i, t in now]
        assert Counter(map(tuple, C.totals(kept).collect())) == Counter((i, count(t)) for i, t in now)
        assert Counter(map(tuple, kept.texts.select("doc_id", "text").collect())) == Counter(now)


def test_second_batch_encodes_only_what_it_touches(llm, docs_of):
    rows = [(i, f"some words of text {i} " * 5000) for i in range(6)]
    kept = C.keep(docs_of(rows), TOKENIZER)
    leaves = kept.trees.agg(F.sum(F.size("counts"))).first()[0]
    assert leaves > 900
    for k in range(2):
        e = llm.createDataFrame([(2, 0, 50_000 + k, 50_010, "changed"), (4, 0, 10, 12, "")], EDITS)
        got = C.edit(kept, C.by_id(kept, e), TOKENIZER)
        seen = got.agg(F.count("*"), F.sum("segments_encoded")).first()
        assert seen[0] == 2 and seen[1] <= 10
        kept = C.settled(kept, got)


def test_no_edits_and_empty_table(llm, docs_of):
    kept = C.keep(docs_of(ODD), TOKENIZER)
    none = llm.createDataFrame([], EDITS)
    assert C.edit(kept, C.by_id(kept, none), TOKENIZER).count() == 0
    got = C.counts_after_edits(docs_of(ODD), TOKENIZER, lambda i, t: [])
    assert got.where("n_tokens <> n_tokens_edited or segments_encoded <> 0").count() == 0 and got.count() == len(ODD)
    empty = docs_of(ODD).limit(0)
    assert C.totals(C.keep(empty, TOKENIZER)).count() == 0
    assert C.counts_after_edits(empty, TOKENIZER, C.sample_edits).count() == 0
