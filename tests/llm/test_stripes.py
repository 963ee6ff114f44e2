"""Merged stripes, source divergences and collocations against plain versions."""

import re
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from rosterworks.llm import collocations as C
from rosterworks.llm import divergence as D
from rosterworks.llm import stripes as S
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"


def plain_divergences(docs, least=10, top=10):
    pattern = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    frequency, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        words = pattern.findall((text or "").translate(lower))
        groups.add((lang or "", source or ""))
        frequency[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in frequency[lang].items() if n >= least]
        mine = [s for k, s in groups if k == lang]
        whole = Counter()
        for s in mine:
            whole.update({t: counts[lang, s][t] for t in kept})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}  # noqa: B023, E731
        p, q = {s: share(counts[lang, s]) for s in mine}, share(whole)
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pairs = sorted((-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode()) for o in mine if o != s)
            terms = sorted((-apart(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            for part, rows in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(rows, 1)}
    return out


def plain_collocations(docs, least=10, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f = defaultdict(Counter)
    for text, lang, _ in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f[lang if lang is not None else "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        n = sum(c for w, c in count.items() if len(w) == 1)
        cand = {w: a for w, a in count.items() if len(w) > 1 and a >= least}
        inside = Counter()
        for w, a in cand.items():
            if len(w) == 3:
                for part in (w[:2], w[1:]):
                    inside[part] = max(inside[part], a)
        rows = []
        for w, a in cand.items():
            if 100 * inside[w] >= 50 * a:
                continue
            score, k = min((10**6 * a * a // (count[w[:k]] * count[w[k:]]), k) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w).encode(), count[w[:k]], count[w[k:]]))
        out += [(lang, k, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def of(df):
    return [(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()]


def divergences(df, **options):
    return {tuple(r) for r in D.source_divergences(df, **options).collect()}


def phrases(df, **options):
    return sorted(tuple(r) for r in C.collocations(df, **options).collect())


def test_divergences_of_the_table(spark):
    docs = table(spark, ROOT, "documents")
    got = {tuple(r) for r in QUERIES["op12_source_divergence"](spark, ROOT).collect()}
    assert got == plain_divergences(of(docs)) and len(got) > 1000


def test_collocations_of_the_table(spark):
    docs = table(spark, ROOT, "documents")
    got = sorted(tuple(r) for r in QUERIES["op13_collocations"](spark, ROOT).collect())
    assert got == plain_collocations(of(docs)) and len(got) > 50


def test_odd_rows(spark, odd, empty):
    """Nulls anywhere, empty and long texts, repeated rows and clashing columns; low thresholds, so that all have a part."""
    assert divergences(odd, min_docs=1) == plain_divergences(of(odd), least=1)
    assert divergences(odd) == plain_divergences(of(odd))
    assert phrases(odd, min_count=1) == plain_collocations(of(odd), least=1)
    assert divergences(empty) == set() and phrases(empty) == []


def test_ties_marks_and_unicode(spark):
    texts = ["Ünder the Brücke, THE brücke! the brücke\tgeht über", "zwei zwei zwei zwei", "a b c a b c a b c", "x\x00y [z] x\x00y [z]", "日本 語 日本 語", "same words here", "same words here"] * 6
    docs = spark.createDataFrame([(k, t, ("de", None, "ja")[k % 3], f"s{k % 4}" if k % 5 else None) for k, t in enumerate(texts)], SCHEMA)
    assert divergences(docs, min_docs=2, top=3) == plain_divergences(of(docs), 2, 3)
    assert phrases(docs, min_count=2, top=5) == plain_collocations(of(docs), 2, 5)


def test_blocks_buckets_and_pieces_do_not_show(spark, monkeypatch):
    """Tiny blocks, pieces, buckets and chunks give the same rows."""
    docs = table(spark, ROOT, "documents").limit(60)
    want = plain_divergences(of(docs), 3), plain_collocations(of(docs), 4)
    words = [w for t, _, _ in of(docs)[:8] for w in [t or ""]]
    monkeypatch.setattr(D, "BLOCK", 200)
    monkeypatch.setattr(C, "BLOCK", 200)
    monkeypatch.setattr(S, "PIECE", 32)
    monkeypatch.setattr(S, "GATHER", 64)
    monkeypatch.setattr(S, "EMIT", 16)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(words)), pa.array(words)], ["lang", "text"])
    packed = list(C._fold([batch], 3))
    assert len(packed) > 3
    held = defaultdict(list)
    for b in packed:
        for r in b.to_pylist():
            held[r["bucket"]].append(r)
    rows = [r for k in sorted(held) for r in held[k]]
    merged = [r for b in S._merge([pa.RecordBatch.from_pylist(rows, schema=packed[0].schema)], 4, 4) for r in b.to_pylist()]
    f = Counter()
    for text in words:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.encode().lower().decode()):
            w = piece.split()
            for k in (1, 2, 3):
                f.update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    single = {k: n for k, n in f.items() if " " not in k}
    assert {r["key"]: r["total"] for r in merged} == {"": sum(single.values())} | {k: n for k, n in f.items() if n >= 4 and k.count(" ") < 2}
    triples = {f"{r['key']} {w}": n for r in merged for w, n in zip(r["names"], r["counts"], strict=True)}
    assert triples == {k: n for k, n in f.items() if n >= 4 and k.count(" ") == 2}
    monkeypatch.setattr(D, "BUCKET", 50)
    monkeypatch.setattr(D, "CELLS", 64)
    assert divergences(docs, min_docs=3) == want[0] and phrases(docs, min_count=4) == want[1]


@pytest.mark.parametrize("count", [0, 1, 10**6, 3 * 10**12])
def test_shares_are_exact(count):
    """Long division in steps of 1000 where a plain product would pass 64 bits."""
    total = np.array([count + 1, 7 * count + 3, 8 * 10**15])
    got = D._share(np.array([count]), total)
    assert got.tolist() == [1 + 10**9 * count // int(t) for t in total]


def test_scores_pass_64_bits(spark):
    big = 9 * 10**11
    frame = spark.createDataFrame([(big, big + 7, 3 * big)], "a long, l long, r long")
    assert frame.select(C._score("a", "l", "r")).first()[0] == 10**6 * big * big // ((big + 7) * 3 * big)


def test_stripes_merge_in_any_order(spark):
    """Merging rows of many blocks equals counting at once, whatever the order and the number of tasks."""
    docs = table(spark, ROOT, "documents").select("lang", "text")
    packed = docs.repartition(7).mapInArrow(partial(C._fold, buckets=5), S.PACKED)
    flat = lambda df: sorted((r.part, r.key, r.total, tuple(sorted(zip(r.names, r.counts, strict=True)))) for r in df.collect())
    assert flat(S.merged(packed, 5, 3)) == flat(S.merged(docs.coalesce(1).mapInArrow(partial(C._fold, buckets=5), S.PACKED), 5, 3))
