"""Every stage of the pipeline on its predecessor's rows, against plain versions; odd rows and repeats included."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from ordersmith.llm import mixing, toxicity, weak_labels
from ordersmith.llm.common import table, written
from tests.conftest import SMALL
from tests.llm.test_jaccard import brute
from tests.llm.test_operators import ODD, TOKENIZER


@pytest.fixture(scope="module")
def stages(llm, docs_of):
    """Rows that each stage was given and gave, from a small table with odd rows beside it."""
    docs = table(llm, SMALL, "documents")
    odd = docs_of([(None if i is None else i + 10**6, t) for i, t in ODD]).select(*docs.columns)
    docs = written(docs.unionByName(odd), "test-pipeline")
    out, now = {}, docs
    for name, stage in P.STAGES:
        got = written(stage(llm, now, SMALL), "test-pipeline")
        out[name] = (now, got)
        now = got
    return out


def rows(df):
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect())


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "toxicity", "near_duplicates", "mixture", "packing"]
    for name, (given, got) in stages.items():
        if name != "packing":
            assert got.columns == given.columns
            assert not rows(got) - rows(given)  # whole rows, none made or changed
            assert got.count() > 0


def test_filters_follow_their_scores(llm, stages):
    """What the stage keeps is what the operator's own scores keep, row by row."""
    given, got = stages["quality"]
    kept = Counter(r["doc_id"] for r in weak_labels.classify(given).where("kept").collect())
    assert Counter(r["doc_id"] for r in got.collect()) == kept
    given, got = stages["toxicity"]
    g = toxicity.train(given, table(llm, SMALL, "labels"))
    kept = Counter(r["doc_id"] for r in toxicity.score(given, g).where("predicted = 0").collect())
    assert Counter(r["doc_id"] for r in got.collect()) == kept


def test_good_and_clean_documents_stay(llm, stages):
    lab = table(llm, SMALL, "labels")
    for name, clean in (("quality", "quality = 1"), ("toxicity", "toxic = 0")):
        given, got = (x.join(lab.where(clean), "doc_id").count() for x in stages[name])
        assert got >= 0.97 * given


def test_one_of_each_group_stays(stages):
    given, got = stages["near_duplicates"]
    have = [(r["doc_id"], r["text"]) for r in given.where("doc_id is not null").collect()]
    once = [(i, t) for i, t in have if Counter(x for x, _ in have)[i] == 1]
    group = {i: root for i, (root, _) in brute(once).items()}
    kept = {r["doc_id"] for r in got.collect()}
    members = defaultdict(list)
    for i, root in group.items():
        members[root].append(i)
    for ids in members.values():
        assert [i for i in sorted(ids) if i in kept] == [min(ids)]
    assert got.where("doc_id is null").count() == given.where("doc_id is null").count()


def test_mixture_takes_its_share(stages):
    given, got = stages["mixture"]
    taken = mixing.keep_mixed(given, P.MIX)
    assert rows(taken) == rows(got)
    assert Counter(r["doc_id"] for r in got.collect()).most_common(1)[0][1] <= max(Counter(r["doc_id"] for r in given.collect()).values())


def test_packs_all_that_is_left(stages):
    given, got = stages["packing"]
    tok = Tokenizer.from_file(TOKENIZER)
    want = Counter((r["doc_id"], len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in given.collect())
    length, bins = defaultdict(list), defaultdict(list)
    for r in got.collect():
        length[r["doc_id"]].append((r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sum(n for _, n in v) for k, v in length.items()} == {k: sum(n * m for (i, n), m in want.items() if i == k) for k in {i for i, _ in want}}
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 4096


def test_run_is_the_stages_in_order(llm):
    docs = table(llm, SMALL, "documents")
    for _, stage in P.STAGES[:-1]:
        docs = written(stage(llm, docs, SMALL), "test-pipeline")
    last = P.STAGES[-1][1](llm, docs, SMALL)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, P.run(llm, SMALL).select(*cols).collect())) == Counter(map(tuple, last.select(*cols).collect()))
