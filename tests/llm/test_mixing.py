"""Budgets and prefixes against a plain version; odd rows."""

import hashlib
import math
import re
from collections import defaultdict

from rosterworks.llm.mixing import mix
from rosterworks.llm.queries import MIX_WEIGHTS, QUERIES, table

ROOT = "/root/testdata/sf0.001"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def fill(nodes, budget):
    """Water filling, one node after another: {name: (limit, weight)} to {name: share}."""
    out, live = {}, dict(nodes)
    while live:
        level = budget / sum(w for _, w in live.values())
        full = [k for k, (limit, w) in live.items() if limit <= level * w]
        if not full:
            return out | {k: level * w for k, (_, w) in live.items()}
        for k in full:
            out[k] = live.pop(k)[0]
            budget -= out[k]
    return out


def plain(docs, share, weights, epochs):
    leaves = defaultdict(list)
    for d in docs:
        domain = f"domain{int(md5(d.source)[:6], 16) % 4}"
        leaves[domain, d.lang, d.source].append((d.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")), f"{d.doc_id}|{md5(d.text or '')}"))
    limit = {k: epochs * sum(n for _, n, _ in v) for k, v in leaves.items()}
    budgets = {}

    def share_out(path, budget):
        if len(path) == 3:
            budgets[path] = budget
            return
        below = {k[len(path)] for k in limit if k[: len(path)] == path}
        nodes = {n: (sum(v for k, v in limit.items() if k[: len(path) + 1] == (*path, n)), weights.get(("domain", "lang", "source")[len(path)], {}).get(n, 1.0)) for n in below}
        for n, b in fill(nodes, budget).items():
            share_out((*path, n), b)

    share_out((), sum(limit.values()) / epochs * share)
    rows = []
    for leaf, members in leaves.items():
        tokens = limit[leaf] // epochs
        whole, rest = divmod(math.floor(budgets[leaf]), tokens) if tokens else (0, 0)
        rows += [(i, e, n) for i, n, _ in members for e in range(whole)]
        for _, i, n in sorted((int(md5(f"1|{whole}|{key}")[:15], 16), i, n) for i, n, key in members):
            if rest <= 0:
                break
            rows.append((i, whole, min(n, rest)))
            rest -= n
    return sorted(rows)


def test_like_plain_version(spark):
    got = sorted((r.doc_id, r.mix_epoch, r.mix_taken) for r in QUERIES["op1_mix_sources"](spark, ROOT).collect())
    assert got == plain(table(spark, ROOT, "documents").collect(), 0.6, MIX_WEIGHTS, 2)


def test_text_is_cut(spark):
    rows = mix(table(spark, ROOT, "documents"), total_share=0.4).collect()
    assert rows and all(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == r.mix_taken for r in rows)


def test_odd_rows(odd, empty):
    assert mix(empty).count() == 0
    got = mix(odd.withColumnRenamed("key", "mix_epoch"), total_share=1.0, max_epochs=1)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "mix_domain", "mix_epoch", "mix_tokens", "mix_taken"]
    assert sum(r.mix_taken for r in got.collect()) == sum(len((r.text or "").split()) for r in odd.collect())


def test_zero_weight_gives_nothing(odd):
    assert {r.lang for r in mix(odd, weights={"lang": {"de": 0}}).collect() if r.mix_tokens} <= {"en", None}
