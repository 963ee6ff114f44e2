"""Held-out accuracy; filters; odd rows."""

import numpy as np
import pytest

from rosterworks.llm import langid
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op9_language_id"](spark, ROOT).join(table(spark, ROOT, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_filters_hold_all_and_little_else():
    random = np.random.default_rng(1)
    values = random.integers(0, 1 << 32, 70 * 300, dtype=np.uint32)
    lang = np.repeat(np.arange(70), 300)
    filters = langid.build([f"l{k:02}" for k in range(70)], lang, values)
    masks = filters.masks(values)
    assert masks.shape[1] == 2 and all(int(m[k >> 6]) >> (k & 63) & 1 for m, k in zip(masks, lang.tolist(), strict=True))
    other = filters.masks(random.integers(0, 1 << 32, 5000, dtype=np.uint32))
    share = np.mean([[int(m[k >> 6]) >> (k & 63) & 1 for k in range(70)] for m in other], axis=0)
    assert np.allclose(share, filters.fill**filters.hashes, atol=0.02)


def test_pieces_join_up(monkeypatch):
    text = np.frombuffer("Ünder the  brïdge, 12 and so on; ".encode() * 50, np.uint8)
    whole = np.concatenate(list(langid.grams(text)))
    assert set(whole.tolist()) >= {int.from_bytes(b"the ", "big"), int.from_bytes(" ün".encode(), "big")}
    monkeypatch.setattr(langid, "CHUNK", 64)
    assert set(np.concatenate(list(langid.grams(text))).tolist()) == set(whole.tolist())


def test_odd_rows(odd, empty):
    filters = langid.train(odd)
    rows = langid.identify(odd, filters).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 7)} == {2: "und", 3: "und", 4: "und", 7: "und"}
    assert all(r.lang_pred in ("en", "de") for r in rows if r.doc_id in (1, 5, 8))
    assert langid.identify(empty, filters).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.train(empty)).collect()} == {"und"}


def plain_grams(text):
    """All runs of four bytes of the folded text, by a loop."""
    kept = [" "]
    for c in text:
        c = c.lower() if c.isalpha() else " "
        if c != " " or kept[-1] != " ":
            kept.append(c)
    if kept[-1] != " ":
        kept.append(" ")
    data = "".join(kept).encode()
    return [data[k : k + 4] for k in range(len(data) - 3)]


def test_predictions_by_plain_sets(spark):
    """The share of n-grams in plain sets of frequent n-grams decides as the filters do, and is the score within the filters' chance hits."""
    import zlib
    from collections import Counter

    words = {"en": "the a house stands near river and many people walk there", "de": "das ein haus steht nahe fluss und viele leute gehen dort", "fr": "la une maison reste près rivière et beaucoup gens marchent là"}
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(words[lang].split(), 8)), lang) for k, lang in enumerate(rng.choice(list(words), 300).tolist())]
    rows += [(900, "zzz qqq xxx", "en"), (901, "the haus walk walk there house", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    counts = {lang: Counter() for lang in words}
    for k, text, lang in rows:
        if lang and zlib.crc32(str(k).encode()) % 5:
            counts[lang].update(plain_grams(text))
    sets = {lang: {g for g, n in c.items() if n >= 2e-5 * sum(c.values())} for lang, c in counts.items()}
    got = {r.doc_id: r for r in langid.identify(frame, langid.train(frame)).collect()}
    for k, text, _ in rows:
        found = plain_grams(text)
        shares = {lang: sum(g in s for g in found) / len(found) for lang, s in sets.items()}
        assert got[k].score == pytest.approx(max(shares.values()), abs=0.05)
        best, second = sorted(shares.values())[-1:-3:-1]
        if best - second > 0.05:
            assert got[k].lang_pred == max(shares, key=shares.get)
