"""Base scores and likelihoods against plain versions; Baum-Welch; odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rosterworks.llm import hmm
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def test_base_scores(spark):
    docs = {r.doc_id: tokens(r.text) for r in table(spark, ROOT, "documents").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(t for i, ts in docs.items() if not held[i] for t in ts)
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op10_hidden_markov_lm"](spark, ROOT).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ts = docs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ts), sum(counts[t] > 0 for t in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts), abs=1e-6)
    new = [r for r in rows if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new) - 0.02 * sum(r.n_tokens for r in new)


@pytest.fixture
def model():
    random = np.random.default_rng(4)
    normal = lambda *s: hmm._normal(random.uniform(0.1, 1, s))
    return hmm.Model(np.zeros(0, np.uint64), np.zeros(0), 1, 1, np.ones(16), np.ones(16), normal(2, 3), normal(3, 3), normal(3, 5))


def plain_likelihood(model, symbols, start=0):
    total = 0.0
    paths = [()]
    for _ in symbols:
        paths = [(*p, k) for p in paths for k in range(3)]
    for p in paths:
        weight = model.start[start][p[0]]
        for t, k in enumerate(p):
            weight *= model.emit[k, symbols[t]] * (model.move[p[t - 1], k] if t else 1)
        total += weight
    return total


def test_forward_is_exact(model):
    random = np.random.default_rng(5)
    lengths = np.array([3, 1, 6, 4, 6])
    symbols = random.integers(0, 5, lengths.sum())
    got = hmm.log_likelihoods(model, lengths, symbols)
    ends = np.cumsum(lengths)
    assert np.allclose(got, [math.log(plain_likelihood(model, symbols[e - n : e])) for n, e in zip(lengths, ends, strict=True)])


def test_expected_counts(model):
    """Counts add up to the tokens, and a step by them never lowers the likelihood."""
    random = np.random.default_rng(6)
    lengths, first = np.array([5, 9, 1, 7]), np.array([True, True, True, False])
    symbols = random.integers(0, 5, lengths.sum())
    starts, moves, emissions = hmm.expected_counts(model, lengths, symbols, first)
    assert np.allclose((starts.sum(1)[0], starts.sum(1)[1], moves.sum(), emissions.sum()), (3, 1, lengths.sum() - 4, lengths.sum()))
    better = hmm.Model(model.heavy, model.heavy_counts, 1, 1, model.rare_tokens, model.rare_words, hmm._normal(starts + 1e-9), hmm._normal(moves), hmm._normal(emissions))
    take = np.repeat(first, lengths)
    assert hmm.log_likelihoods(better, lengths[first], symbols[take]).sum() > hmm.log_likelihoods(model, lengths[first], symbols[take]).sum()


def test_odd_rows(odd, empty):
    rows = hmm.hmm_scores(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].n_tokens == by[3].n_tokens == by[4].n_tokens == 1 and by[2].score == by[3].score and by[5].n_tokens == 30_002
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert hmm.hmm_scores(empty).count() == 0
    alone = hmm.hmm_scores(odd, held_out_modulus=1, held_out_remainder=0).collect()
    assert {r.train_tokens for r in alone} == {0} and all(math.isfinite(r.score) for r in alone)


def test_scores_by_hand(spark, monkeypatch):
    """Whole scores from the trained model by a plain forward recursion: frequent words, classes, unknown words and copies."""
    kept, original = [], hmm._trained
    monkeypatch.setattr(hmm, "_trained", lambda *a: kept.append(original(*a)) or kept[-1])
    rng = np.random.default_rng(8)
    common, rare = ["the", "of", "And"], [f"w{'x' * int(k % 20)}{k}" for k in range(60)]
    texts = [" ".join(rng.choice(common, 6)) + " " + " ".join(rng.choice(rare, 4)) for _ in range(40)]
    texts += [texts[0], texts[0], None, "the new" + "y" * 40, "of \t the\nof"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in hmm.hmm_scores(frame, rare_below=20).collect()}
    model, docs = kept[0], {k: tokens(t) for k, t in enumerate(texts)}
    counts = Counter(w for k, ws in docs.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in ws)
    number = lambda w: int(hmm.END) if w == "\n" else int(next(hmm.batch_tokens(hmm.pa.array([w])))[0])
    place = {int(h): k for k, h in enumerate(model.heavy)}
    assert {w for w in counts if number(w) in place} >= {"the", "of", "and", "\n"}
    kind = lambda w: min(len(w.encode()), 15)
    others = [(w, c) for w, c in counts.items() if number(w) not in place]
    room = {k: sum(c + 1 for w, c in others if kind(w) == k) + 1 for k in range(16)}
    for k, ws in docs.items():
        total, alpha = 0.0, None
        for w in ws:
            symbol, share = (place[number(w)], 1.0) if number(w) in place else (len(place) + kind(w), (counts[w] + 1) / room[kind(w)])
            alpha = model.start[0] * model.emit[:, symbol] if alpha is None else (alpha @ model.move) * model.emit[:, symbol]
            total += math.log10(alpha.sum() * share)
            alpha = alpha / alpha.sum()
        assert rows[k].score == pytest.approx(total, abs=1e-6)
        assert rows[k].n_known == sum(counts[w] > 0 for w in ws)
