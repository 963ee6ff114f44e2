"""Nearest neighbours against exhaustive search; bounds; odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from rosterworks.llm import ann
from rosterworks.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.001"


def exhaustive(ids, x, asked, k):
    out = {}
    for i in asked:
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_and_scores(spark):
    rows = table(spark, ROOT, "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = exhaustive(ids, x, np.flatnonzero(ids % 20 == 0), 20)
    got = {}
    for r in QUERIES["op3_nearest"](spark, ROOT).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    for q, best in got.items():
        assert np.allclose([s for _, s in best], [x[ids == v][0] @ x[ids == q][0] for v, _ in best], atol=1e-12)


def test_estimates_keep_their_bounds():
    random = np.random.default_rng(5)
    v, q = random.standard_normal((4000, 40)) * random.uniform(0.1, 9, (4000, 1)), random.standard_normal(40)
    turn = ann.rotation(40, 1)
    bits, length, fit = ann.encode(v, turn)
    code = np.unpackbits(bits, axis=1).astype(float) * 2 - 1
    estimate = code @ (q @ turn) / np.sqrt(40) * length / fit
    error = length * np.linalg.norm(q) * np.sqrt(1 - fit**2) / fit * 3 / np.sqrt(39)
    assert (np.abs(estimate - v @ q) <= error).mean() > 0.99


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, float(k), 0.0]) for k in range(1, 8)] + [(20, None), (21, []), (22, [0.0, 0.0, 0.0]), (23, [1.0, nan, 1.0]), (24, [inf, 1.0, 1.0]), (25, [1.0, None, 2.0]), (26, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (7, [1.0, 7.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, query_id string")
    got = ann.nearest(frame, F.col("vec_id").isin(1, 7, 20), k=20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got if r.query_id == 1] == [(1, n, v) for n, v in enumerate((7, 7, 6, 5, 4, 3, 2), 1)]
    assert {r.vec_id for r in got if r.query_id == 7} == set(range(1, 7))
    assert ann.nearest(frame.where("false"), F.col("vec_id") == 1).count() == 0
    ties = spark.createDataFrame([(k, [1.0, 1.0]) for k in range(60)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in ann.nearest(ties, F.col("vec_id") == 0, k=5).orderBy("rank").collect()] == [1, 2, 3, 4, 5]
