"""Samples stay bounded, and useful, where one row or one id is repeated many times."""

import pytest
from pyspark.sql import functions as F

from ordersmith.llm import rules, toxicity, weak_labels
from ordersmith.llm.common import table
from tests.conftest import MEDIUM

TIMES = 50_000
JUNK = "BUY NOW!!! $$$ ### | | | BUY NOW!!! $$$ ### | | | BUY NOW!!! $$$ ### | | |"


def repeated(llm, text="'" + JUNK + "'", doc_id="7"):
    return llm.range(TIMES).selectExpr(f"cast({doc_id} as long) doc_id", f"{text} AS text", "'en' lang", "'s1' source", "10L n_chars")


@pytest.mark.parametrize("text", ["'same words in every row'", "concat('row ', id)"])
def test_labelled_sample_is_bounded(llm, text):
    lab = llm.createDataFrame([(7, 0, 1)], "doc_id long, quality int, toxic int")
    got = rules.labelled_sample(repeated(llm, text), lab, "quality", most=2000)
    n = got.count()
    assert n == (1 if text.startswith("'") else n) and n <= 5000
    assert n >= 1 and got.distinct().count() == n


def test_one_bad_row_repeated(llm):
    s = weak_labels.classify(repeated(llm)).agg(F.min("weak_bad"), F.min("bad_score"), F.max("kept"), F.count("*")).first()
    assert s[0] > 0.5 and s[1] >= 0.5 and s[2] is False and s[3] == TIMES


def test_repeats_beside_real_texts(llm):
    """Half a table of one junk row: the scorer still tells good from bad, and toxic from clean."""
    d, lab = table(llm, MEDIUM, "documents"), table(llm, MEDIUM, "labels")
    cols = d.columns
    both = d.unionByName(repeated(llm, doc_id="-1").limit(TIMES).selectExpr(*cols))
    good = lab.where("quality = 1").select("doc_id")
    kept = weak_labels.keep_good(both)
    assert kept.where("doc_id = -1").count() == 0
    left, had = (x.join(good, "doc_id").count() for x in (kept, d))
    assert left >= 0.98 * had
    more = lab.unionByName(llm.createDataFrame([(-1, 0, 0)], "doc_id long, quality int, toxic int").selectExpr(*lab.columns))
    learned = rules.learn_rules(both, more)
    assert learned and rules.apply_rules(both, learned).where("doc_id = -1 and kept").count() == 0
    g = toxicity.train(both, more)
    clean = toxicity.keep_clean(both, g)
    assert clean.where("doc_id = -1").count() == TIMES
    assert clean.join(lab.where("toxic = 0"), "doc_id").count() >= 0.99 * d.join(lab.where("toxic = 0"), "doc_id").count()
