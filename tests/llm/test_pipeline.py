"""Every stage against a plain version on all that the stage before kept; odd rows through all stages."""

import corpus_pipeline
from pyspark.sql import functions as F

from rosterworks.llm.common import materialize
from rosterworks.llm.queries import MIX_WEIGHTS, table
from rosterworks.llm.toxicity import train

from .test_decontaminate import plain as plain_tiles
from .test_decontaminate import words
from .test_jaccard import plain as plain_components
from .test_mixing import plain as plain_mixture
from .test_pii import plain as plain_spans

ROOT = "/root/testdata/sf0.001"


def redacted(text):
    spans = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in plain_spans(text or "")))
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if text else text


def leaked(text, items):
    own = words(text)
    runs = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
    for item in items:
        if any(tuple(item[k : k + 5]) in runs for k in range(len(item) - 4)):
            number = {x: n for n, x in enumerate(dict.fromkeys(item + own), 1)}
            if plain_tiles([number[x] for x in item], [number[x] for x in own], 5)[0] >= 0.6 * len(item):
                return True
    return False


def test_stages(spark):
    docs = table(spark, ROOT, "documents")
    score = train(docs, table(spark, ROOT, "labels")).scorer()
    items = [words(r.text) for r in table(spark, ROOT, "benchmark").collect()]
    rows = [r.asDict() for r in docs.collect()]
    first = {i: c for i, _, c in plain_components([(r["doc_id"], r["text"]) for r in rows if score(r["text"]) < 0.5])}
    expected = {
        "toxicity": lambda before: [r for r in before if score(r["text"]) < 0.5],
        "near_duplicates": lambda before: [r for r in before if first[r["doc_id"]] == r["doc_id"]],
        "decontamination": lambda before: [r for r in before if not leaked(r["text"], items)],
        "personal_data": lambda before: [r | {"text": redacted(r["text"])} for r in before],
    }
    order = lambda rs: sorted(tuple(map(str, r.values())) for r in rs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, ROOT), name)
        rows = expected[name](rows)
        assert order(r.asDict() for r in docs.collect()) == order(rows), name
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT).collect()
    want = plain_mixture(docs.collect(), 0.6, MIX_WEIGHTS, 2)
    assert sorted((r.doc_id, r.mix_epoch, r.mix_taken) for r in mixed if r.mix_tokens) == [x for x in want if x[2]]


def test_odd_rows(spark, odd):
    """Nulls, blanks, repeats, a long text and clashing columns: every stage keeps columns and what it must."""
    docs = odd.withColumnsRenamed({"key": "_KEY", "score": "_row"}).withColumn("mix_domain", F.lit("own"))
    kept = {"toxicity": 9, "near_duplicates": 7, "decontamination": 7, "personal_data": 7}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, docs, ROOT), name)
        assert after.columns == docs.columns and after.count() == kept[name], name
        docs = after
    assert {r.doc_id for r in docs.collect()} == {None, 1, 2, 3, 4, 5, 7}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, ROOT).count() > 0


def test_empty(spark):
    none = table(spark, ROOT, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, ROOT).count() == 0
