"""Restoring, training and scoring."""

import numpy as np
import pytest

from rosterworks.llm import toxicity as T
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return T.train(table(spark, ROOT, "documents"), table(spark, ROOT, "labels"))


def test_held_out_rows(spark, model):
    """Whatever is decided by a listed word is decided rightly; labels without any such word stay below 0.5."""
    rows = QUERIES["op4_toxicity"](spark, ROOT).join(table(spark, ROOT, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.toxic == 1 for r in held if r.predicted == 1)
    assert not [r for r in rows if r.predicted == 1 and r.toxic == 0]
    assert sum(r.predicted for r in held) >= 0.5 * sum(r.toxic for r in held)
    assert len(rows) == table(spark, ROOT, "labels").count()


@pytest.mark.parametrize(
    ("seen", "word"),
    [("1d1ot", "idiot"), ("m0r0n!", "moron"), ("sc.u.m", "scum"), ("s c u m of", "scum"), ("l 0 s e r", "loser"), ("st00pid", None), ("stuuupid", "stupid"), ("tr@$h", "trash"), ("w0rthl3ss", "worthless"), ("m-o-r-o-n", "moron"), ("st*pid", "stupid"), ("Idiot.", "idiot"), ("TRA5H", "trash")],
)
def test_disguises(model, seen, word):
    found = T.Restorer(model.chars, frozenset(model.weights)).words_in(f"the {seen} was")
    assert found == ({word} if word else found)
    if word:
        assert model.scorer()(f"the {seen} was") > 0.5


@pytest.mark.parametrize("text", ["", None, "the that was of 1d1", "call 4348649190265535 or 22.249.23.55", "thhe lloserish idiots clowning", "a b c d e f g"])
def test_clean_texts(model, text):
    assert model.scorer()(text) < 0.5


def test_decoding_prefers_likely_letters():
    counts = np.zeros(T.SIZE**T.GRAM)
    word = [0, 0, 0, *(ord(c) - 96 for c in "hello"), 0]
    for k in range(len(word) - 3):
        a, b, c, d = word[k : k + 4]
        counts[((a * 27 + b) * 27 + c) * 27 + d] += 1000
    chars = T.CharModel.of(counts)
    assert chars.decode("h3llo") == "hello" and chars.decode("h e l l o") == "hello" and chars.decode("hell0") == "hello"


def test_odd_rows(spark, odd, empty, model):
    rows = T.score_toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert T.score_toxicity(empty, model).count() == 0
    assert T.drop_toxic(odd, model).columns == odd.columns and T.drop_toxic(odd, model).count() == odd.count()
    blank = T.train(empty, table(spark, ROOT, "labels").where("false"))
    assert {r.score for r in T.score_toxicity(odd, blank).collect()} == {0.5}


@pytest.mark.parametrize(("seen", "word"), [("(lown", "clown"), ("(l0wn", "clown"), ("<lown!", "clown"), ("\"(lown\",", "clown"), ("( l o w n", "clown"), ("£ o s e r", "loser"), ("(clown)", "clown"), ("(clowns", None), ("(lawn)", None), ("(own)", None), ("(lown and such)", None), ("(l0wn)", "clown")])
def test_signs_at_the_edges(model, seen, word):
    found = T.Restorer(model.chars, frozenset({*model.weights, "clown"})).words_in(f"the {seen} was")
    assert found == ({word} if word else set())
