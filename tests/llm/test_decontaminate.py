"""Tiling against a plain version; the join; odd rows."""

import random
import re

import numpy as np

from rosterworks.llm import decontaminate as D
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.01"


def plain(a, b, least):
    free_a, free_b, covered, tiles = [True] * len(a), [x != 0 for x in b], 0, 0
    where = {x: [j for j, y in enumerate(b) if y == x] for x in set(a) - {0}}
    while True:
        best, found = least - 1, []
        for i in range(len(a)):
            for j in where.get(a[i], ()):
                k = 0
                while i + k < len(a) and j + k < len(b) and free_a[i + k] and free_b[j + k] and a[i + k] == b[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if best < least:
            return covered, tiles
        for i, j in found:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = free_b[j : j + best] = [False] * best
                covered, tiles = covered + best, tiles + 1


def test_tiles():
    rng = random.Random(3)
    for _ in range(1500):
        a, b = [rng.randint(1, 3) for _ in range(rng.randint(1, 25))], [rng.randint(0, 3) for _ in range(rng.randint(1, 30))]
        assert D.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3) == plain(a, b, 3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_whole_table(spark):
    items = {r.item_id: words(r.text) for r in table(spark, ROOT, "benchmark").collect()}
    want = set()
    for d in table(spark, ROOT, "documents").collect():
        w = words(d.text)
        runs = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        for i, item in items.items():
            if any(tuple(item[k : k + 5]) in runs for k in range(len(item) - 4)):
                number = {x: n for n, x in enumerate(dict.fromkeys(item + w), 1)}
                covered, tiles = plain([number[x] for x in item], [number[x] for x in w], 5)
                if covered >= 0.6 * len(item):
                    want.add((d.doc_id, i, covered, tiles))
    got = {(r.doc_id, r.item_id, r.covered_words, r.tiles) for r in QUERIES["op6_decontaminate"](spark, ROOT).collect()}
    assert want == got and want


def test_reordered_passage(spark):
    passage = "one two three four five six. seven eight nine ten eleven twelve. red green blue white black grey"
    moved = "intro words here red green blue white black grey and then seven eight nine ten eleven twelve. one two three four five six. end"
    docs = spark.createDataFrame([(1, moved, "k"), (2, "one two three four five six. other text altogether", "k"), (3, "nothing of it", None)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(9, passage), (10, "too short"), (11, None)], "item_id long, text string")
    pairs = {r.doc_id: r for r in D.tiled_pairs(docs, bench).collect()}
    assert pairs.keys() == {1, 2} and pairs[1].coverage == 1.0 and pairs[1].tiles == 3 and pairs[2].coverage < 0.6
    assert sorted(r.doc_id for r in D.drop_leaks(docs, bench).collect()) == [2, 3]


def test_items_with_odd_ids(spark):
    """Repeated rows give one pair; items of one id or of none are told apart by their words."""
    text = "alpha beta gamma delta epsilon zeta"
    docs = spark.createDataFrame([(1, text + " more"), (1, text + " more"), (2, "one two three four five six seven")], "doc_id long, text string")
    items = [("", text), (None, "one two three four five six"), ("a", text), ("a", text), ("a", "one two three four five"), (None, "too short")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = sorted(((r.doc_id, r.item_id, r.item_words) for r in D.leaked_pairs(docs, bench).collect()), key=str)
    assert got == sorted([(1, "", 6), (1, "a", 6), (2, None, 6), (2, "a", 5)], key=str)


def test_clashing_columns(spark):
    text = "alpha beta gamma delta epsilon zeta"
    docs = spark.createDataFrame([(1, text, 5, 6), (2, "clean", 7, 8)], "doc_id long, text string, _KEY int, _salt int")
    kept = D.drop_leaks(docs, spark.createDataFrame([(1, text)], "item_id long, text string"))
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", 7, 8)]


def test_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy"), (None, "wort wort wort wort wort wort"), (2, "")], "item_id long, text string")
    rows = D.tiled_pairs(odd, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (8, 1), (5, None)} and len(rows) == 3
    assert D.drop_leaks(odd, bench).columns == odd.columns and D.drop_leaks(odd, bench).count() == odd.count() - 4
    assert D.tiled_pairs(empty, bench).count() == 0 and D.tiled_pairs(odd, bench.where("false")).count() == 0
