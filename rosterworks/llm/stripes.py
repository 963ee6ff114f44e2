"""Stripes: a key with its total and a counter of names, folded in map tasks and merged by key.

A map task folds whole texts into stripes and hands them on in blocks. All stripes of a block that share a
part (a language) and a bucket (of a hash of the key) travel as one row of plain byte columns: keys, sizes,
totals, the number of names of each key, names and counts. A reduce task reads the rows of one bucket
after the other and merges the stripes element by element, whenever enough have gathered, so that its memory
follows the distinct stripes of a bucket and not the number of blocks that mention them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_views, mix

PACKED = "part string, bucket int, keys binary, key_sizes binary, totals binary, fans binary, names binary, name_sizes binary, counts binary"
MERGED = "part string, key string, total long, names array<string>, counts array<long>"
#: Bytes of text whose stripes share a bucket, so that a reduce task holds few of them at once.
BUCKET_BYTES = 1 << 24
#: Entries that gather before they are merged, and those that one Arrow batch of results holds.
GATHER, EMIT = 1 << 21, 1 << 18
#: Bytes of a text that are taken apart at once.
PIECE = 1 << 20


class Vocabulary(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def words(self) -> pa.Array:
        return pa.array(list(self), pa.binary())

    def hashes(self) -> np.ndarray:
        return mix(np.fromiter(map(zlib.crc32, self), np.uint64, len(self)))


def bucket_count(docs: DataFrame, column: str) -> int:
    """How many buckets the stripes of a text column are dealt over."""
    size = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return size // BUCKET_BYTES + 1


def pieces(data: bytes, marks: bytes) -> Iterator[bytes]:
    """The bytes in pieces of about PIECE, cut behind one of the marks; what has none stays together."""
    at = 0
    while len(data) - at > PIECE:
        cut = min((k for k in (data.find(bytes([m]), at + PIECE) for m in marks) if k >= 0), default=-1) + 1
        if not cut:
            break
        yield data[at:cut]
        at = cut
    yield data[at:]


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Offsets and bytes of a binary array that begins at its buffers' beginning."""
    return np.frombuffer(values.buffers()[1], np.int32)[: len(values) + 1], values.buffers()[2] or pa.py_buffer(b"")


def _cut(data: pa.Buffer, offsets: np.ndarray) -> pa.Array:
    """One value for each stretch between neighbouring offsets."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data])


def pack(part: str, keys: pa.Array, hashes: np.ndarray, totals: np.ndarray, fans: np.ndarray, names: pa.Array, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for every bucket; names and counts follow the keys, as many for each as ``fans`` says."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, fans = (np.cumsum(fans) - fans)[order], fans[order]
    ends = np.cumsum(fans)
    entry = np.repeat(first - (ends - fans), fans) + np.arange(int(ends[-1]) if len(ends) else 0)
    keys, names = keys.take(pa.array(order)), names.take(pa.array(entry))
    found, at = np.unique(bucket[order], return_index=True)
    at = np.append(at, len(order))
    names_at = np.concatenate(([0], ends))[at]

    def numbers(values: np.ndarray, where: np.ndarray) -> pa.Array:
        return _cut(pa.py_buffer(np.ascontiguousarray(values, np.uint32)), where * 4)

    (key_at, key_bytes), (name_at, name_bytes) = _bytes_of(keys), _bytes_of(names)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(found), pa.string()), pa.array(found, pa.int32()),
            _cut(key_bytes, key_at[at]), numbers(np.diff(key_at), at), numbers(totals[order], at), numbers(fans, at),
            _cut(name_bytes, name_at[names_at]), numbers(np.diff(name_at), names_at), numbers(counts[entry], names_at),
        ],
        ["part", "bucket", "keys", "key_sizes", "totals", "fans", "names", "name_sizes", "counts"],
    )


class _Bucket:
    """The stripes of one bucket, merged so far."""

    def __init__(self) -> None:
        self.keys, self.totals, self.fans, self.names, self.counts = [], [], [], [], []
        self.gathered, self.limit = 0, GATHER

    def add(self, row: list[np.ndarray]) -> None:
        keys, key_sizes, totals, fans, names, name_sizes, counts = row
        sized = lambda data, sizes: _cut(pa.py_buffer(data), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))))
        key_sizes, name_sizes = key_sizes.view(np.uint32), name_sizes.view(np.uint32)
        for into, values in zip(
            (self.keys, self.totals, self.fans, self.names, self.counts),
            (sized(keys, key_sizes), *(x.view(np.uint32).astype(np.int64) for x in (totals, fans)), sized(names, name_sizes), counts.view(np.uint32).astype(np.int64)),
            strict=True,
        ):
            into.append(values)
        self.gathered += len(key_sizes) + len(name_sizes)
        if self.gathered > self.limit:
            self.merge()

    def merge(self) -> None:
        keys, names = pa.concat_arrays(self.keys).dictionary_encode(), pa.concat_arrays(self.names).dictionary_encode()
        key = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        totals = np.zeros(len(keys.dictionary), np.int64)
        np.add.at(totals, key, np.concatenate(self.totals))
        entry = np.repeat(key, np.concatenate(self.fans)) << 32 | names.indices.to_numpy(zero_copy_only=False)
        entry, place = np.unique(entry, return_inverse=True)
        counts = np.zeros(len(entry), np.int64)
        np.add.at(counts, place, np.concatenate(self.counts))
        self.keys, self.totals = [keys.dictionary], [totals]
        self.fans, self.counts = [np.bincount(entry >> 32, minlength=len(totals))], [counts]
        self.names = [names.dictionary.take(pa.array(entry & 0xFFFFFFFF))]
        self.gathered = len(totals) + len(counts)
        self.limit = max(GATHER, 2 * self.gathered)

    def rows(self, part: str, least: int, least_count: int) -> Iterator[pa.RecordBatch]:
        self.merge()
        keys, totals, fans, names, counts = self.keys[0], self.totals[0], self.fans[0], self.names[0], self.counts[0]
        owner = np.repeat(np.arange(len(keys)), fans)
        whole = pa.compute.equal(keys, b"").to_numpy(zero_copy_only=False)
        keep = (totals >= least) | whole
        entry = keep[owner] & ((counts >= least_count) | whole[owner])
        fans = np.bincount(owner[entry], minlength=len(keys))[keep]
        keys, totals, names, counts = keys.filter(pa.array(keep)).cast(pa.string()), totals[keep], names.filter(pa.array(entry)).cast(pa.string()), counts[entry]
        ends = np.cumsum(fans)
        for start, end in _stretches(ends):
            low, high = (int(ends[start - 1]) if start else 0), int(ends[end - 1])
            offsets = pa.array(np.concatenate(([low], ends[start:end])) - low, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * (end - start), pa.string()), keys.slice(start, end - start), pa.array(totals[start:end]), pa.ListArray.from_arrays(offsets, names.slice(low, high - low)), pa.ListArray.from_arrays(offsets, pa.array(counts[low:high]))],
                ["part", "key", "total", "names", "counts"],
            )


def _stretches(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring keys with about EMIT names and no more than 10,000 keys."""
    start = 0
    while start < len(ends):
        begun = int(ends[start - 1]) if start else 0
        end = min(max(start + 1, int(np.searchsorted(ends, begun + EMIT, side="right"))), start + 10_000, len(ends))
        yield start, end
        start = end


def _merge(batches: Iterable[pa.RecordBatch], least: int, least_count: int) -> Iterator[pa.RecordBatch]:
    held, bucket = None, _Bucket()
    for batch in batches:
        parts, buckets = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        columns = [list(byte_views(batch.column(k))) for k in range(2, 9)]
        for k, at in enumerate(zip(parts, buckets, strict=True)):
            if held is not None and at != held:
                yield from bucket.rows(held[0], least, least_count)
                bucket = _Bucket()
            held = at
            bucket.add([c[k].copy() for c in columns])
    if held is not None:
        yield from bucket.rows(held[0], least, least_count)


def merged(packed: DataFrame, least: int = 1, least_count: int = 1) -> DataFrame:
    """part, key, total, names, counts: one row for every part and key.

    Only stripes with a total of ``least`` come back, with the names that have a count of ``least_count``; the stripe
    of the empty key always comes back whole. The order of names is not fixed.
    """
    dealt = packed.repartition("part", "bucket").sortWithinPartitions("part", "bucket")
    return dealt.mapInArrow(partial(_merge, least=least, least_count=least_count), MERGED)
