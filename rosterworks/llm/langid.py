"""Language identification with bit-sliced Bloom filters over character n-grams.

Every language has a Bloom filter of its characteristic n-grams (four bytes of lower-cased UTF-8).
The filters lie bit-sliced: one table whose cell k holds bit k of all filters as a mask of
languages, so the AND of an n-gram's few cells gives all languages that contain it at once. A text's
score for a language is the number of its n-grams found there, corrected for those that the filter's
fill leads one to expect by chance.

Counts cover all documents that are not held out: each task adds up its n-grams per language, Spark
sums them, and those with at least ``least_share`` of a language's n-grams enter its filter, of
which there are never more than 1 / least_share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_views, is_bucket, materialize, mix

N = 4
CHUNK = 1 << 20
UNKNOWN = "und"


def _fold_table() -> np.ndarray:
    """Bytes as n-grams see them: A-Z lower-cased, all else of ASCII but letters one space."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    return table


_FOLD = _fold_table()


def grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """The n-grams of a text's bytes as 32-bit numbers, in pieces; runs of non-letters count as one space."""
    x = _FOLD[data]
    # The second byte of an upper-case Latin letter with an accent (À-Þ) turns to that of the lower-case one.
    upper = np.flatnonzero((x[:-1] == 0xC3) & (x[1:] >= 0x80) & (x[1:] <= 0x9E) & (x[1:] != 0x97)) + 1
    x[upper] += 0x20
    space = np.full(1, 32, np.uint8)
    x = np.concatenate((space, x, space))
    gap = x == 32
    x = x[~(gap & np.concatenate(([False], gap[:-1])))]
    for at in range(0, len(x) - N + 1, CHUNK):
        part = x[at : at + CHUNK + N - 1].astype(np.uint32)
        yield part[:-3] << 24 | part[1:-2] << 16 | part[2:-1] << 8 | part[3:]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, where = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return values, np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of a task by language, each once; pieces are added up whenever a million has gathered."""
    sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    new: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}

    def add(lang: str) -> None:
        sums.setdefault(lang, []).append(np.unique(np.concatenate(new.pop(lang)), return_counts=True))
        size[lang] = 0
        if len(sums[lang]) > 8:
            sums[lang] = [_added(sums[lang])]

    for batch in batches:
        for lang, data in zip(batch.column(0).to_pylist(), byte_views(batch.column(1)), strict=True):
            for piece in grams(data):
                new.setdefault(lang, []).append(piece)
                size[lang] = size.get(lang, 0) + len(piece)
                if size[lang] > 1_000_000:
                    add(lang)
    for lang in list(new):
        add(lang)
    for lang, parts in sums.items():
        values, counts = _added(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values)), pa.array(values.astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"])


@dataclass
class Filters:
    """table: (cells, words of 64 languages); fill: the share of set bits for each language."""

    languages: list[str]
    table: np.ndarray
    hashes: int
    fill: np.ndarray

    def cells(self, values: np.ndarray) -> list[np.ndarray]:
        h = mix(values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        step, size = h >> np.uint64(32) | np.uint64(1), np.uint64(len(self.table) - 1)
        return [((h + np.uint64(k) * step) & size).astype(np.int64) for k in range(self.hashes)]

    def masks(self, values: np.ndarray) -> np.ndarray:
        """For each n-gram the languages whose filters hold it, as bits."""
        first, *rest = self.cells(values)
        out = self.table[first].copy()
        for cell in rest:
            out &= self.table[cell]
        return out

    def predict(self, data: np.ndarray) -> tuple[str, float]:
        found, total = np.zeros(len(self.languages)), 0
        for values in grams(data):
            masks = self.masks(values)
            total += len(values)
            for k in range(len(self.languages)):
                found[k] += np.count_nonzero(masks[:, k >> 6] & np.uint64(1 << (k & 63)))
        if not len(found):
            return UNKNOWN, 0.0
        if not total:
            return self.languages[0], 0.0
        chance = self.fill**self.hashes
        share = np.clip((found / total - chance) / (1 - chance), 0, 1)
        best = int(np.argmax(share))
        return self.languages[best], float(share[best])


def build(languages: list[str], lang: np.ndarray, values: np.ndarray, hashes: int = 2, bits_per_gram: int = 16) -> Filters:
    """Filters from pairs (number of a language, n-gram); the table has room for the largest language."""
    most = int(np.bincount(lang).max()) if len(lang) else 1
    size = 1 << max(10, int(np.ceil(np.log2(most * bits_per_gram))))
    filters = Filters(languages, np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64), hashes, np.zeros(len(languages)))
    for k in range(len(languages)):
        for cell in filters.cells(values[lang == k]):
            filters.table[cell, k >> 6] |= np.uint64(1 << (k & 63))
        filters.fill[k] = np.count_nonzero(filters.table[:, k >> 6] & np.uint64(1 << (k & 63))) / size
    return filters


def train(docs: DataFrame, modulus: int = 5, least_share: float = 2e-5) -> Filters:
    """Filters of the languages in docs (doc_id, text, lang), from rows that are not held out and whose lang is not null.

    Languages are in order of their n-grams, most first: ties and letters without any known n-gram
    go to the first. Without such rows there are no
    filters, and every text is "und".
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_bucket(F.col("doc_id"), modulus, 0)).select("lang", "text")
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "grams")
    common = counts.join(counts.groupBy("lang").agg(F.sum("n").alias("whole")), "lang")
    table = common.where(F.col("n") >= F.col("whole") * least_share).select("lang", "gram", "whole").toPandas()
    languages = sorted(table["lang"].unique(), key=dict(zip(table["lang"], -table["whole"], strict=True)).get)
    number = {x: k for k, x in enumerate(languages)}
    return build(languages, table["lang"].map(number).to_numpy(np.int64), table["gram"].to_numpy(np.int64).astype(np.uint32))


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in batches:
            got = []
            for text, data in zip(batch.column(0).to_pylist(), byte_views(batch.column(0)), strict=True):
                letters = text is not None and any(map(str.isalpha, text))
                got.append(filters.predict(data) if letters else (UNKNOWN, 0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], [*batch.schema.names[1:], "lang_pred", "score"])

    return run


def identify(docs: DataFrame, filters: Filters, modulus: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs (doc_id, text; others are ignored).

    Texts that are null or have no letter are "und" with score 0; a null doc_id counts as the text
    ''; rows repeat as in the input; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rows = docs.select("text", "doc_id", is_bucket(F.col("doc_id"), modulus, 0).alias("held_out"))
    return rows.mapInArrow(_predict(shared), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
