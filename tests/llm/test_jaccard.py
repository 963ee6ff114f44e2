"""Components against all pairs; near copies; odd rows."""

import random
import re

import pytest

from rosterworks.llm import jaccard as J
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def plain(rows):
    sets, root = [(i, shingles(t)) for i, t in rows], {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(x), least[find(k)]) for k, (i, x) in enumerate(sets))


def got(frame, **options):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(frame, **options).collect())


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, ROOT, "documents").collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op7_ngram_jaccard"](spark, ROOT).collect()) == plain(rows)


@pytest.mark.parametrize("home", [3, 2000])
def test_chains_of_near_copies(spark, monkeypatch, home):
    """Texts drift apart by a few words each, share passages and come in copies; home blocks of 3 leave most to the lists."""
    monkeypatch.setattr(J, "HOME", home)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcde") for _ in range(3))
    passage, rows = [word() for _ in range(25)], []
    for _ in range(12):
        text = [word() for _ in range(rng.randint(1, 60))] + passage * rng.randint(0, 1)
        for _ in range(rng.randint(1, 9)):
            rows.append((len(rows) * 3 % 997, " ".join(text)))
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = word()
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_odd_rows(odd, empty):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(odd).collect()}
    assert {(1, 5, 1), (8, 5, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (7, 1, 7), (None, 1, None)} <= rows
    assert J.jaccard_components(odd).count() == odd.count() and J.jaccard_components(empty).count() == 0
    kept = J.keep_first(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7]


def test_one_row_of_repeated_ids(spark):
    """A repeated doc_id keeps one row of its component, and a row that links elsewhere goes alone."""
    a, b = "one two three four five six seven", "red green blue white black grey brown"
    rows = [(5, a), (5, a), (3, b), (5, b), (4, ""), (4, None), (4, "solo words are in this one"), (None, a), (None, a)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in J.keep_first(frame).collect()), key=str)
    blank = [t for i, t in kept if i == 4 and not t]
    assert len(blank) == 1 and [x for x in kept if x[1]] == sorted([(5, a), (3, b), (4, "solo words are in this one"), (None, a), (None, a)], key=str)


def test_long_text_without_spaces(spark):
    frame = spark.range(1).selectExpr("id AS doc_id", "repeat('x', 50000000) AS text").union(spark.createDataFrame([(2, "x")], "doc_id long, text string"))
    assert sorted(got(frame)) == [(0, 1, 0), (2, 1, 2)]


def test_home_blocks_against_all_pairs():
    """Derived overlaps connect what plain comparison connects."""
    rng = random.Random(2)
    sets, tokens = [], list(range(400))
    for _ in range(12):
        base = rng.sample(tokens, rng.randint(5, 60))
        for _ in range(rng.randint(1, 8)):
            own = set(base)
            for _ in range(rng.randint(0, 8)):
                own ^= {rng.choice(tokens)}
            sets.append(sorted(own or {0}))
    rng.shuffle(sets)
    root = list(range(len(sets)))
    for _ in sets:
        for k, x in enumerate(sets):
            for m, y in enumerate(sets):
                if 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y)):
                    root[k] = root[m] = min(root[k], root[m])
    assert J.home_links([J.np.array(s, J.np.uint64) for s in sets], 80).tolist() == root
