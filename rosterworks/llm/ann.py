"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector of length r is turned by a random rotation, and of its unit vector only the signs are kept,
packed to bits, with two scalars: r and the inner product c of the unit vector with its own code.
For a query q the estimate of the inner product is r * <code, q'> / c, summed from tables of the
query's partial sums for every byte that a code can hold, and it is off by more than
r * |q| * sqrt((1 - c*c) / (c*c)) * margin / sqrt(d - 1) with a probability that falls off like a Gaussian's
tail in the margin. The 4 k vectors of highest estimate set a bar with their exact products; all whose
upper bound reaches the k-th best of them are reranked exactly.

Queries and vectors are dealt into blocks of bounded size, and each pair of blocks is one task's
work, so neither side is ever broadcast or gathered whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

QUERY_BLOCK = 4_096
VECTOR_BLOCK = 8_192
ROWS = 128


def rotation(d: int, seed: int) -> np.ndarray:
    """A random rotation of d dimensions, d being a multiple of 8."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def padded(d: int) -> int:
    return -(-d // 8) * 8


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, lengths, inner product of each unit vector with its code)."""
    d = turn.shape[0]
    length = np.linalg.norm(vectors, axis=1)
    unit = np.zeros((len(vectors), d))
    unit[:, : vectors.shape[1]] = vectors / length[:, None]
    turned = unit @ turn
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(1) / np.sqrt(d)


def _encode(d: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(padded(d), seed)
        for batch in batches:
            values = [(i, v) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            x = np.array([v for _, v in values], np.float64).reshape(len(values), d)
            scale = np.abs(x).max(axis=1, initial=0.0)
            take = np.isfinite(scale) & (scale > 0)
            x, ids = x[take], [i for (i, _), t in zip(values, take, strict=True) if t]
            bits, length, fit = encode(x / scale[take][:, None], turn)
            rows = [ids, [b.tobytes() for b in bits], length * scale[take], fit, [v.tobytes() for v in x], batch.column(2).filter(pa.array(take))]
            types = (batch.schema.field(0).type, pa.binary(), pa.float64(), pa.float64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([r if isinstance(r, pa.Array) else pa.array(r, t) for r, t in zip(rows, types, strict=True)], ["vec_id", "code", "length", "fit", "vector", "asks"])

    return run


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, added from first to last component, so that equal vectors score equally anywhere."""
    return np.cumsum(x * y, axis=1)[:, -1]


def byte_tables(turned: np.ndarray) -> np.ndarray:
    """For each query, byte of a code and value of that byte: the sum of the byte's eight components with the signs of its bits."""
    signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(turned.dtype) * 2 - 1
    return turned.reshape(len(turned), -1, 8) @ signs.T


def code_products(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """<code, query> of all pairs from packed codes (a row per byte): one lookup for every eight components."""
    total = np.zeros((len(tables), codes.shape[1]), tables.dtype)
    for k, row in enumerate(codes):
        total += np.take(tables[:, k], row, axis=1)
    return total


def _search(d: int, seed: int, k: int, margin: float):
    columns = ["query_id", "vec_id", "score"]

    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in zip(columns, ("int64", "int64", "float64"), strict=True)})
        size, turn = padded(d), rotation(padded(d), seed)
        q = np.frombuffer(b"".join(queries["vector"]), np.float64).reshape(-1, d)
        v = np.frombuffer(b"".join(vectors["vector"]), np.float64).reshape(-1, d)
        kind = np.float32 if max(np.abs(q).max(), np.abs(v).max()) < 1e15 else np.float64
        codes = np.ascontiguousarray(np.frombuffer(b"".join(vectors["code"]), np.uint8).reshape(-1, size // 8).T)
        fit = vectors["fit"].to_numpy()
        factor = (vectors["length"].to_numpy() / fit / np.sqrt(size)).astype(kind)
        spread = (vectors["length"].to_numpy() * np.sqrt(np.maximum(0, 1 - fit**2)) / fit * margin / np.sqrt(size - 1)).astype(kind)
        turned, q_length = (q @ turn[:d]).astype(kind), np.linalg.norm(q, axis=1).astype(kind)
        ids, own, out = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy(), []
        first, small = min(len(ids), 4 * k), v.astype(kind)
        longest = float(vectors["length"].max()) + 1
        for at in range(0, len(q), ROWS):
            part = slice(at, at + ROWS)
            estimate = code_products(byte_tables(turned[part]), codes) * factor
            estimate[ids == own[part][:, None]] = -np.inf
            bar = np.full(len(estimate), -np.inf)
            if first > k:
                likely = np.argpartition(estimate, len(ids) - first, axis=1)[:, len(ids) - first :]
                sure = np.einsum("ij,ikj->ik", q[part], v[likely])
                sure[np.take_along_axis(estimate, likely, axis=1) == -np.inf] = -np.inf
                bar = np.partition(sure, first - k, axis=1)[:, first - k]
            estimate += q_length[part][:, None] * spread
            for row, (query, at_least) in enumerate(zip(q[part], bar, strict=True), at):
                slack = 1e-5 * (1 + abs(at_least)) if np.isfinite(at_least) else 0.0
                near = np.flatnonzero((estimate[row - at] >= at_least - slack) & (estimate[row - at] != -np.inf))
                near = near[small[near] @ query.astype(kind) >= at_least - slack * q_length[row] * longest]
                score = _exact(v[near], query)
                best = np.lexsort((ids[near], -score))[:k]
                out.append((np.full(len(best), own[row]), ids[near[best]], score[best]))
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return run


def nearest(vectors: DataFrame, is_query, k: int = 20, seed: int = 3, margin: float = 4.0) -> DataFrame:
    """For each query row its k nearest rows by largest inner product: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding (an array); more columns are ignored. ``is_query`` is a
    condition on any of its columns (null: no query). A row is no candidate for queries of its own vec_id. Scores are the
    exact inner products of the original vectors in double precision; ties go to the smaller vec_id;
    fewer candidates give fewer rows.

    Rows whose vec_id is null, or whose vector is null, empty, zero or has null, NaN or infinite components
    take no part, nor do those of another size than the most frequent (of equally frequent sizes the
    smallest). Rows that repeat a vec_id are candidates each. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    good = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull()))
    first = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    schema = "query_id long, vec_id long, score double"
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = first["d"]
    sized = good.where(F.size("embedding") == d).select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asks"))
    coded = materialize(sized.mapInArrow(_encode(d, seed), "vec_id long, code binary, length double, fit double, vector binary, asks boolean"), "codes")
    n, asked = coded.agg(F.count("*"), F.count_if("asks")).first()
    query_blocks, vector_blocks = max(1, -(-asked // QUERY_BLOCK)), max(1, -(-n // VECTOR_BLOCK))
    part = lambda blocks, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    right = coded.drop("asks").withColumn("v", part(vector_blocks, "v")).withColumn("q", every(query_blocks))
    left = coded.where("asks").select("vec_id", "vector", part(query_blocks, "q").alias("q")).withColumn("v", every(vector_blocks))
    found = left.groupBy("q", "v").cogroup(right.groupBy("q", "v")).applyInPandas(_search(d, seed, k, margin), schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
