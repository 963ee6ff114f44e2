"""Benchmark decontamination by greedy string tiling.

A pair of document and benchmark item is looked at if both hold a run of ``least`` equal words.
Tiles are common runs of at least that length; the longest go first and mark their words, found in
each round by comparing Karp-Rabin hashes that roll over the unmarked words. An item counts as
leaked into a document when tiles cover the threshold's share of the item's words; since tiles may
lie in any order, a passage with its sentences moved about is caught too.

Items are known by a key of their own, so ids may repeat or be null; items of equal words are tiled once.
An item of fewer words than ``least`` is in no pair: so few words in a row say nothing about a leak.

The benchmark's runs set bits in a bitmap of fixed size, with which one pass over the documents
keeps only words that can lie in a tile. Those pieces, not the texts, are joined with the items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_words, distinct, materialize, parts, shingle_hashes, text_key, without_keys
from .jaccard import BITMAP_BITS, bitmap_of


def _item_runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            words = [w for w, _ in batch_words(batch.column(1))]
            runs = [distinct(shingle_hashes(w, least)) if len(w) >= least else w[:0] for w in words]
            columns = [pa.array([x.view(np.int64).tolist() for x in part], pa.list_(pa.int64())) for part in (words, runs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["item_id", "words", "runs"])

    return run


def _pieces(least: int, bitmap):
    """For each document with a run that may be the benchmark's: the run hashes and the words of its
    possible tiles. Pieces that do not touch are parted by a 0 in ``words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint64)
        for batch in parts(batches, 2):
            ids, keys, found, kept = [], [], [], []
            for doc_id, key, (words, _) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch_words(batch.column(2)), strict=True):
                if len(words) < least:
                    continue
                runs = shingle_hashes(words, least)
                place = runs & np.uint64((1 << BITMAP_BITS) - 1)
                hit = np.flatnonzero(bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1))
                if not len(hit):
                    continue
                inside = np.zeros(len(words) + 1, np.int64)
                np.add.at(inside, hit, 1)
                np.add.at(inside, hit + least, -1)
                at = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
                gaps = np.flatnonzero(np.diff(at) > 1) + 1
                ids.append(doc_id)
                keys.append(key)
                found.append(distinct(runs[hit]).view(np.int64).tolist())
                kept.append(np.insert(words[at], gaps, 0).view(np.int64).tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(keys, pa.int64()), pa.array(found, longs), pa.array(kept, longs)], ["doc_id", "key", "runs", "words"])

    return run


_ROLL = 0x100000001B3
_UNROLL = pow(_ROLL, -1, 1 << 64)


def _rolling(words: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of all runs of ``size`` unmarked words, and where they start."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    weight, back = (np.cumprod(np.full(len(words), x, np.uint64), dtype=np.uint64) for x in (_UNROLL, _ROLL))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * weight, dtype=np.uint64)))
    value = (sums[size:] - sums[:n]) * back[:n]
    open_words = np.concatenate(([0], np.cumsum(free)))
    starts = np.flatnonzero(open_words[size:] - open_words[:n] == size)
    return value[starts], starts


def tile(item: np.ndarray, document: np.ndarray, least: int) -> tuple[int, int]:
    """(words of the item that tiles cover, number of tiles); 0 in the document never matches."""
    free_a, free_b = np.ones(len(item), bool), document != 0
    covered = tiles = 0
    size = min(len(item), len(document))
    while size >= least:
        a, at_a = _rolling(item, free_a, size)
        b, at_b = _rolling(document, free_b, size)
        common = np.isin(a, b)
        if not common.any():
            # No run of this length: halve the distance to the longest one that there is.
            low, high = least - 1, size - 1
            while low < high:
                middle = (low + high + 1) // 2
                if np.isin(_rolling(item, free_a, middle)[0], _rolling(document, free_b, middle)[0]).any():
                    low = middle
                else:
                    high = middle - 1
            size = low
            continue
        where: dict[int, list[int]] = {}
        for value, start in zip(b.tolist(), at_b.tolist(), strict=True):
            where.setdefault(value, []).append(start)
        for value, start in zip(a[common].tolist(), at_a[common].tolist(), strict=True):
            if not free_a[start : start + size].all():
                continue
            for other in where.get(value, ()):
                if free_b[other : other + size].all() and np.array_equal(item[start : start + size], document[other : other + size]):
                    free_a[start : start + size] = free_b[other : other + size] = False
                    covered += size
                    tiles += 1
                    break
        size -= 1
    return covered, tiles


def _tiled(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got, total = [], []
            for item, words in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                item = np.array(item, np.int64).view(np.uint64)
                got.append(tile(item, np.array(words, np.int64).view(np.uint64), least))
                total.append(len(item))
            columns = [pa.array(total, pa.int64()), *[pa.array([x[k] for x in got], pa.int64()) for k in (0, 1)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["piece", "item", "item_words", "covered_words", "tiles"])

    return run


def tiled_pairs(docs: DataFrame, benchmark: DataFrame, least: int = 5) -> DataFrame:
    """doc_id, key (of the text), item_id, item_words, covered_words, tiles, coverage for each pair
    of a document and an item (item_id, text) that share a run of ``least`` words.

    Words are runs of non-space characters with A-Z lower-cased. Items and documents with fewer than
    ``least`` words, empty or null texts are in no pair.
    Rows that repeat doc_id and text, or item_id and the item's words, give one row; items of one id
    and different words, and null ids, are items each. More columns are ignored; empty tables give
    an empty table.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id"))}
    items = benchmark.select("item_id", "text").mapInArrow(_item_runs(least), f"item_id {kinds['item_id']}, words array<long>, runs array<long>").where(F.size("words") >= least)
    items = materialize(items.withColumn("item", F.xxhash64("words")).dropDuplicates(["item_id", "item"]), "items")
    wordings = materialize(items.dropDuplicates(["item"]).select("item", "words", "runs"), "wordings")
    seeds = wordings.select("item", F.explode("runs").alias("run"))
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(seeds, "run"))
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    pieces = rows.mapInArrow(_pieces(least, bitmap), f"doc_id {kinds['doc_id']}, key long, runs array<long>, words array<long>")
    pieces = materialize(pieces.withColumn("piece", F.xxhash64("words")), "pieces")

    # Texts whose possible tiles are equal are tiled once, however many copies there are.
    distinct_pieces = pieces.groupBy("piece").agg(F.first("runs").alias("runs"), F.first("words").alias("piece_words"))
    distinct_pieces = materialize(distinct_pieces, "distinct")
    pairs = distinct_pieces.select("piece", F.explode("runs").alias("run")).join(seeds, "run").select("piece", "item").distinct()
    work = pairs.join(distinct_pieces.select("piece", "piece_words"), "piece").join(wordings.select("item", "words"), "item")
    schema = "piece long, item long, item_words long, covered_words long, tiles long"
    tiled = materialize(work.select("piece", "item", "words", "piece_words").mapInArrow(_tiled(least), schema), "tiled")
    found = pieces.select("doc_id", "key", "piece").distinct().join(tiled, "piece").join(items.select("item", "item_id"), "item")
    return found.select("doc_id", "key", "item_id", "item_words", "covered_words", "tiles").withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.6) -> DataFrame:
    """The pairs of :func:`tiled_pairs` whose coverage reaches the threshold."""
    return tiled_pairs(docs, benchmark, least).where(F.col("coverage") >= threshold)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.6) -> DataFrame:
    """docs without the rows that an item leaked into; columns and other rows stay."""
    bad = leaked_pairs(docs, benchmark, least, threshold).select("key").distinct()
    return without_keys(docs, text_key(F.col("text")), materialize(bad, "leaks"))
