"""The toxicity grammar: forms change verdicts, labels change forms, copies and repeats are bounded."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from ordersmith.llm import textops as T
from ordersmith.llm import toxicity as X
from ordersmith.llm.common import table
from tests.conftest import MEDIUM


@pytest.fixture(scope="module")
def trained(llm):
    return X.train(table(llm, MEDIUM, "documents"), table(llm, MEDIUM, "labels"))


def scores(g, some):
    return X.Reader(g).scores(*T.utf8(pc.utf8_lower(pa.array(some, pa.large_string()))))


PLAIN = ("you are a {}", "du bist ein {}", "tu es un {}", "tú eres un {}")
WEAKER = ("you are not a {}", "she said he is a {}", "du bist kein {}", "er sagte du bist ein {}", "tu n'es pas un {}", "il dit: elle; il a dit que tu es un {}",
          "tú no eres nunca un {}", "dijo que tú eres un {}", "she said he is not a {}")


def test_negated_and_reported_insults_lose(trained):
    words = sorted(trained.words, key=lambda w: -trained.words[w])[:5]
    assert words
    for w in words:
        assert (scores(trained, [p.format(w) for p in PLAIN]) >= 0.5).all()
        assert (scores(trained, [p.format(w) for p in WEAKER]) < 0.5).all()


def test_threats_need_a_target(trained):
    alone = ["hurt", "how to kill a process in linux", "destroy", "kill the lights, please", "umbringen", "he will not kill you", "they said he will kill you"]
    assert (scores(trained, alone) < 0.5).all()
    assert (scores(trained, ["I will kill you", "i will hurt them all", "ich werde dich töten", "te tuer", "you: no. i'll stab him"]) >= 0.5).all()


def test_clauses_stand_alone(trained):
    w = max(trained.words, key=trained.words.get)
    assert scores(trained, [f"that is not so. you {w}"])[0] >= 0.5  # a stop ends the reach of a negation
    assert scores(trained, [""])[0] < 0.5


def test_labels_move_the_forms():
    """A form that the labels call toxic, or harmless, leaves its belief both ways."""
    g = X.Grammar(words={"w": 4.0})
    g.forms = X.beliefs(g)
    rng = np.random.default_rng(5)
    y = np.zeros(2000)
    y[:600] = 1
    for form, toxic in ((X.INSULT | X.NEGATED, True), (X.INSULT | X.AIMED, False)):
        h = X.Grammar(words=dict(g.words), forms=dict(g.forms))
        count, weight = np.zeros((2000, len(X.FORMS))), np.zeros((2000, len(X.FORMS)))
        plain = rng.permutation(600)[:300]
        count[plain, X.PLACE[X.INSULT]] = 1
        rest = np.setdiff1d(np.arange(600), plain) if toxic else np.arange(600, 900)
        count[rest, X.PLACE[form]] = 1
        weight += 4.0 * count
        before = h.forms[form]
        if toxic:
            h.forms[form] = before = -3.0
        X.fit_forms(h, y, count, weight)
        assert h.forms[form] > before + 0.5 if toxic else h.forms[form] < before - 0.5
        unseen = X.THREAT | X.NEGATED
        assert h.forms[unseen] == pytest.approx(g.forms[unseen])


def test_only_verified_copies_of_one_label_are_dropped(llm):
    words = [f"w{i}" for i in range(400)]
    base = " ".join(words[:100])
    near = " ".join([*words[:99], "other"])  # Jaccard 95 of 97
    part = " ".join([*words[:50], *words[200:250]])  # shares half of its words
    rows = [(base, 1), (base, 1), (near, 1), (part, 1), (base, 0), ("", 0), (" ", 0)]
    got = sorted((r["text"].strip(), r["label"]) for r in X._unlike(llm.createDataFrame(rows, "text string, label int")).collect())
    assert ("", 0) in got and (base, 0) in got and (part, 1) in got and len(got) in (4, 5)
    assert len(got) - sum(t in (base, near) and y == 1 for t, y in got) == 3
