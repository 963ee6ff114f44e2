"""Measures against a plain version, accuracies against made votes, and what the labels say of the verdicts."""

import math
import re

import pytest
from pyspark.sql import functions as F

from rosterworks.llm import quality as Q
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    letters = re.sub(r"[^\W_]+|[\x20\x09-\x0D]+", "", text)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_ended": sum(x.rstrip(" \t\n\x0b\f\r")[-1] in '.!?"' for x in lines), "n_marks": len(letters), "n_distinct": len(set(words)), "n_capitals": len(re.findall("[A-Z]", text)),
    }


def measured(docs):
    return sorted(((r.doc_id is None, r.doc_id), tuple(r[c] for c in Q.MEASURES)) for r in Q.measures(docs).collect())


def expected(rows):
    return sorted(((k is None, k), tuple(plain(t)[c] for c in Q.MEASURES)) for k, t in rows)


def test_measures_of_the_table(spark):
    docs = table(spark, ROOT, "documents")
    assert measured(docs) == expected((r.doc_id, r.text) for r in docs.collect())


def test_measures_of_odd_rows(spark, odd):
    assert measured(odd) == expected((r.doc_id, r.text) for r in odd.collect())


@pytest.mark.parametrize(
    ("text", "repeated"),
    [("a b c", 0), ("a a a a", 4), ("a b c a b c", 6), ("a b c x a b c", 6), ("a b a b a", 5), ("w " * 1000, 1000), ("a b c d e f", 0), ("x y z q x y w q", 0), ("a b c\n\ta b c d", 6)],
)
def test_repeated_windows(spark, text, repeated):
    assert Q.measures(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().n_repeat_words == repeated


def test_accuracies_are_found(spark):
    """Votes made at known rates: the estimates come close, and the posterior sides with the maker."""
    import random

    draw = random.Random(5)
    names = list(Q.RULES)
    good = {n: draw.uniform(0.9, 0.99) for n in names}
    bad = {n: draw.uniform(0.35, 0.8) for n in names}
    rows, truth = [], []
    for _ in range(6000):
        quality = draw.random() < 0.75
        truth.append(quality)
        rows.append(([0 if draw.random() < 0.1 else (1 if draw.random() < good[n] else -1) if quality else (-1 if draw.random() < bad[n] else 1) for n in names], 1))
    votes = spark.createDataFrame(rows, "votes array<int>, n long")
    model = Q.fit(votes.groupBy("votes").agg(F.sum("n").alias("n")))
    assert model["prior"] == pytest.approx(0.75, abs=0.03)
    assert all(model["good"][n] == pytest.approx(good[n], abs=0.03) and model["bad"][n] == pytest.approx(bad[n], abs=0.06) for n in names)
    guess = [r.p >= 0.5 for r in votes.select(Q.posterior(model).alias("p")).collect()]
    assert sum(a == b for a, b in zip(guess, truth, strict=True)) > 0.97 * len(truth)


def test_fit_against_a_plain_version(spark):
    """The same rounds over plain numbers give the same model."""
    docs = table(spark, ROOT, "documents")
    patterns = Q.votes(Q.measures(docs)).groupBy("votes").agg(F.count("*").alias("n"))
    rows = [(r.votes, r.n) for r in patterns.collect()]
    names = list(Q.RULES)
    prior, good, bad = Q.PRIOR, [Q.GOOD] * len(names), [Q.BAD] * len(names)
    for _ in range(Q.ROUNDS):
        sums = [[0.0] * 4 for _ in names]
        total = [0.0, 0.0]
        for votes, n in rows:
            odds = math.log(prior / (1 - prior)) + sum(math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0.0 for v, g, b in zip(votes, good, bad, strict=True))
            p = 1 / (1 + math.exp(-odds))
            total[0] += n * p
            total[1] += n
            for k, v in enumerate(votes):
                if v:
                    sums[k][v > 0] += n * p
                    sums[k][2 + (v > 0)] += n * (1 - p)
        share = lambda yes, no, first: (yes + Q.BEFORE * first) / (yes + no + Q.BEFORE)
        prior = share(total[0], total[1] - total[0], Q.PRIOR)
        bad = [share(s[2], s[3], Q.BAD) for s in sums]
        good = [max(1 - b, share(s[1], s[0], Q.GOOD)) for s, b in zip(sums, bad, strict=True)]
    model = Q.fit(patterns)
    assert model["prior"] == pytest.approx(prior)
    assert list(model["good"].values()) == pytest.approx(good) and list(model["bad"].values()) == pytest.approx(bad)


def test_labels_agree(spark):
    """Of labelled texts that pass the base rules nearly all good ones stay and nearly all bad ones go; labels are no input."""
    root = "/root/testdata/sf0.01"
    both = QUERIES["op11_quality_rules"](spark, root).withColumnRenamed("quality", "p").join(table(spark, root, "labels"), "doc_id").where("NOT base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in both.groupBy("quality", "kept").count().collect()}
    assert counts[1, True] >= 0.98 * (counts[1, True] + counts.get((1, False), 0))
    assert counts[0, False] >= 0.9 * (counts[0, False] + counts.get((0, True), 0))


def test_odd_tables(spark, odd, empty):
    rows = Q.judge(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.quality <= 1 for r in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in rows)
    assert len({(r.quality, r.kept) for r in rows if r.doc_id == 1}) == 1
    assert Q.judge(empty).count() == 0
    assert Q.fit(empty.select(F.array().cast("array<int>").alias("votes"), F.lit(1).cast("long").alias("n")))["prior"] == Q.PRIOR


def test_no_python_and_no_shuffled_text(spark):
    plan = Q.measures(table(spark, ROOT, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert plan.count("split(") == 2, "words and lines are each split once"
