"""Base spans against plain patterns; discovery; odd rows."""

import hashlib
import random
import re

import pytest

from rosterworks.llm import pii
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.01"


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
)


def plain(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, pattern, good in PLAIN for m in re.finditer(pattern, text) if good(m[0])]


@pytest.mark.parametrize("signs", ["1234 .-+@ab()\n", "0@.a-", "9 +()-.", "4 5-"])
def test_base_spans(signs):
    rng = random.Random(signs)
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 50)))
        assert pii.written(pii.base_spans(text)) == ",".join(plain(text))


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "-" * 300_000, "@" * 100_000, "4 " * 150_000):
        pii.base_spans(text)
        pii.candidates(text, [])


def test_whole_table(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, ROOT, "documents").collect()}
    rows = QUERIES["op5_pii"](spark, ROOT).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in base) for k in pii.KINDS]
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_contexts_discover(spark):
    rows = [(k, f"word{k % 3} contact me at user{k}@mail.com now please") for k in range(12)] + [(50 + k, f"well contact me at user{k} [at] mail.com now please") for k in range(2)]
    rows += [(100 + k, f"room {1000 + k} in house") for k in range(5)]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)[50]
    kind, start, end = got[50].spans.split(":")
    assert kind == "email" and text[int(start) : int(end)] == "user0 [at] mail.com" and got[50].n_email == 0
    assert got[100].spans == "" and got[3].spans == pii.written(pii.base_spans(rows[3][1]))
    cleaned = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert cleaned[50] == "well contact me at [EMAIL] now please" and cleaned[3] == "word0 contact me at [EMAIL] now please" and cleaned[100] == "room 1000 in house"


def test_finds_seed_further_finds(spark):
    """What the first pass finds also stands in a context without base matches: it is found there, and the second pass learns the context."""
    rows = [f"word{k % 3} contact me at user{k}@mail.com now please" for k in range(12)]
    rows += [f"well contact me at found{k} [at] mail.com now please" for k in range(8)]
    rows += [f"deliver parcels to found{k} [at] mail.com every single day" for k in range(8)]
    rows += [f"deliver parcels to unseen{k} [at] mail.com every single day" for k in range(8)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    once = {r.doc_id for r in pii.find_pii(frame, passes=1).collect() if r.doc_id >= 12 and r.spans}
    more = {r.doc_id for r in pii.find_pii(frame).collect() if r.doc_id >= 12 and r.spans}
    assert once == set(range(12, 28)) and more == set(range(12, 36))


@pytest.mark.parametrize(("text", "found"), [("call 020 7946 0958 today", "020 7946 0958"), ("call (0207) 946-0958.", "(0207) 946-0958"), ("write john at mail dot com now", "john at mail dot com"), ("code A1234.", "A1234"), ("see 12 of 30", None)])
def test_candidates(text, found):
    assert [text[s:e] for s, e in pii.candidates(text, [])] == ([found] if found else [])


def test_contexts_are_whole_words():
    long = "x" * 500
    text = f"{long} a@b.cc, {long}d@e.ff"
    spans = [(s, e) for _, s, e in pii.base_spans(text)]
    assert pii.contexts(text, spans) == [(long, ""), ("", "")] or pii.contexts(text, spans)[0][0] == long
    started = "a@b.cc," * 50_000
    assert len(pii.contexts(started, [(s, e) for _, s, e in pii.base_spans(started)])) == 50_000


def test_clashing_columns(spark):
    rows = [(1, "mail a@b.cc", "k", "m")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _pii_key string, _MORE string")
    assert [tuple(r) for r in pii.redact(frame).collect()] == [(1, "mail [EMAIL]", "k", "m")]


def test_odd_rows(odd, empty):
    assert pii.find_pii(odd).count() == odd.count() and pii.find_pii(empty).count() == 0
    assert pii.redact(odd).columns == odd.columns and sorted(map(str, pii.redact(odd).collect())) == sorted(map(str, odd.collect()))
    assert pii.redact(empty).count() == 0


def plain_discoveries(rows, rounds=4, min_seeds=5, threshold=0.8):
    """The same graph in plain loops: rows of (key, sights); returns (key, kind, start, end)."""
    sights = {(key, s.kind, s.instance, s.left, s.right, s.start, s.end) for key, found in rows for s in found}
    weight = {}
    for _, kind, instance, left, right, _, _ in sights:
        for pattern in {(left, right), (left, None), (None, right)}:
            if pattern[0] or pattern[1]:
                weight[pattern, instance, kind] = weight.get((pattern, instance, kind), 0) + 1
    accepted = {}
    while True:
        edges = {(p, i, k or accepted.get(i, "")): 0 for p, i, k in weight}
        for (p, i, k), n in weight.items():
            edges[p, i, k or accepted.get(i, "")] += n
        seeds, mass, whole = {}, {}, {}
        for (p, i, k), n in edges.items():
            whole[p] = whole.get(p, 0) + n
            if k:
                seeds.setdefault((p, k), set()).add(i)
                mass[p, k] = mass.get((p, k), 0) + n
        seeded = {pk for pk, s in seeds.items() if len(s) >= min_seeds}
        score = {pk: mass[pk] / (whole[pk[0]] + 1) for pk in seeded}
        live = {p for p, _ in seeded}
        free = [(p, i, n) for (p, i, k), n in edges.items() if not k and p in live]
        total = {}
        for _, i, n in free:
            total[i] = total.get(i, 0) + n
        for _ in range(rounds - 1):
            belief = {}
            for p, i, n in free:
                for (q, k), v in score.items():
                    if q == p:
                        belief[i, k] = belief.get((i, k), 0) + n * v / total[i]
            gain = {}
            for p, i, n in free:
                for (j, k), b in belief.items():
                    if j == i:
                        gain[p, k] = gain.get((p, k), 0) + n * b
            score = {pk: (mass[pk] + gain.get(pk, 0)) / (whole[pk[0]] + 1) for pk in seeded}
        best = {}
        for (p, i, k), _ in weight.items():
            for (q, kind), v in score.items():
                if not k and q == p and v >= threshold and i not in accepted:
                    best[i] = max(best.get(i, (0, "")), (v, kind))
        if not best:
            break
        accepted |= {i: kind for i, (_, kind) in best.items()}
    return {(key, accepted[i], start, end) for key, kind, i, _, _, start, end in sights if not kind and i in accepted}


def test_discoveries_against_a_plain_graph(spark):
    """Random sentences with identifiers in shared contexts: closure, kinds and places as in plain loops."""
    import random

    draw = random.Random(9)
    frames = ["contact me at {} now", "call {} today please", "server {} is down", "order {} shipped", "write to {} soon", "{} is mine"]
    things = [f"user{k}@mail.com" for k in range(12)] + [f"name{k} [at] mail.com" for k in range(8)] + [f"+44 20 7946 09{k}0" for k in range(10)] + [f"0207946{k}" for k in range(8)] + [f"10.0.0.{k}" for k in range(10)] + [f"A{1000 + k}" for k in range(20)]
    bias = {0: things[:20], 1: things[20:38], 2: things[38:], 3: things[48:]}
    rows = []
    for k in range(300):
        f = draw.randrange(len(frames))
        rows.append((k, f"w{k % 7} " + frames[f].format(draw.choice(bias.get(f, things))) + "."))
    scanned = pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    want = plain_discoveries([(r.key, r.sights) for r in scanned.select("key", "sights").collect()])
    got = {tuple(r) for r in pii.discover(scanned).collect()}
    assert got == want and len(want) > 20


def test_accepted_identifiers_go_everywhere(spark):
    """An identifier that a strong context gave away is also taken where it stands in a context that says nothing."""
    rows = [f"please call +44 20 7946 0{k:03d} before noon" for k in range(300, 312)] + ["please call 5550109999 before noon", "my locker is 5550109999 upstairs", "5550109999", "my locker is 5550108888 upstairs"]
    cleaned = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert [cleaned[k] for k in range(12, 16)] == ["please call [PHONE] before noon", "my locker is [PHONE] upstairs", "[PHONE]", "my locker is 5550108888 upstairs"]
