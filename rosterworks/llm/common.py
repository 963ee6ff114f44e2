"""What the operators of this package share: tables in the shared folder and word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent, a temporary folder takes its place if the session runs in one
    process; on several machines that would lose data, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rosterworks-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int | None):
    """Within it Arrow batches have at most so many rows, so that neither side of a Python worker holds many texts at once."""
    before = spark.conf.get(_BATCH)
    if rows is not None and not 0 < int(before) <= rows:
        spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def materialize(df: DataFrame, tag: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: its lineage ends there.

    ``batch`` bounds the rows of the Arrow batches in which the write hands texts to Python.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with batches_of(spark, batch):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_bucket(column: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the column's text leaves this remainder; null text counts as ''."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % modulus == remainder


def text_key(column: Column) -> Column:
    """A 64-bit key of a text; null and empty text share one."""
    return F.xxhash64(F.coalesce(column, F.lit("")))


#: What is broadcast has so many rows and, with values of any length beside the key, so many bytes.
BROADCAST_KEYS, BROADCAST_BYTES = 1_000_000, 64 << 20
SALTS = 32


def if_few(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it has been counted to be small enough; a larger one is joined by shuffling."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def is_small(df: DataFrame) -> bool:
    """Whether df has been counted to be small enough for a broadcast, in rows and in bytes as JSON."""
    if df.count() > BROADCAST_KEYS:
        return False
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0) <= BROADCAST_BYTES


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_keyed(docs: DataFrame, key: Column, values: DataFrame, how: str) -> DataFrame:
    """docs joined with ``values`` (key and, for a left join, one value column) on a key of their rows.

    Few keys are broadcast, after rows and bytes have been counted. More are repeated for each of some salts, so that
    even a key that a third of all rows have is dealt over that many tasks; the salt is a hash of the row, so a
    lost task is dealt as before. The value column comes last.
    """
    name, salt = free_name(docs, "_key"), free_name(docs, "_salt")
    extra = [c for c in values.columns if c != "key"]
    renamed = values.select(F.col("key").alias(name), *[F.col(c).alias(free_name(docs, f"_{c}")) for c in extra])
    keep = [F.col(f"`{c}`") for c in docs.columns] + ([F.col(free_name(docs, f"_{c}")) for c in extra] if how == "left" else [])
    keyed = docs.withColumn(name, key)
    if is_small(values):
        return keyed.join(F.broadcast(renamed), name, how).select(*keep)
    keyed = keyed.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]), F.lit(SALTS)).cast("int"))
    spread = renamed.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return keyed.join(spread, [name, salt], how).select(*keep)


def without_keys(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of docs whose key is not among ``keys`` (key)."""
    return with_keyed(docs, key, keys, "left_anti")


# Word hashes ------------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 18


def _byte_table(fold: bool) -> np.ndarray:
    table = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)
    if fold:
        table[65:91] = table[97:123]
    return table


_FOLDED = _byte_table(True)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _power_table(base: int) -> np.ndarray:
    steps = np.full(_BLOCK + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWER, _UNDO = _power_table(_BASE), _power_table(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block_words(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unmixed hashes, starts and ends of the words of a block; no word crosses a cut (a position in it)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    begins, stops = (inside[1:] > inside[:-1]), (inside[1:] < inside[:-1])
    joined = cuts[(inside[cuts] & inside[cuts + 1]) == 1]
    begins[joined] = stops[joined] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_FOLDED[data] * _POWER[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * _UNDO[starts], starts, ends


_NO_CUT = np.zeros(0, np.int64)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 bytes, A-Z lower-cased, with their start and end bytes.

    Words are runs without the bytes 9-13 and 32. Texts are taken in blocks of a fixed size, and a
    word that a block's end cuts is put together from its pieces, so that memory stays in
    proportion to the block and the words, however long a text or a word is.
    """
    parts, open_word = [], None
    for at in range(0, len(data), _BLOCK):
        value, starts, ends = _block_words(data[at : at + _BLOCK], _NO_CUT)
        starts, ends = starts + at, ends + at
        if open_word is not None:
            first, begun = open_word
            if len(starts) and starts[0] == at:
                value[0] = (first + int(value[0]) * pow(_BASE, at - begun, 1 << 64)) & MASK64
                starts[0] = begun
            else:
                parts.append((np.array([first], np.uint64), np.array([begun]), np.array([at])))
            open_word = None
        if len(ends) and ends[-1] == at + _BLOCK < len(data):
            open_word = int(value[-1]), int(starts[-1])
            value, starts, ends = value[:-1], starts[:-1], ends[:-1]
        parts.append((value, starts, ends))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    value, starts, ends = parts[0] if len(parts) == 1 else (np.concatenate(x) for x in zip(*parts, strict=True))
    return mix(value + (ends - starts).astype(np.uint64)), starts, ends


def _groups(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of at most a block together; a longer text stands alone."""
    start = total = 0
    for k, n in enumerate(lengths.tolist()):
        if total + n > _BLOCK and k > start:
            yield start, k
            start, total = k, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def _group_words(views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, byte lengths, text number) of the words of several texts."""
    if len(views) == 1:
        value, starts, ends = words_of(views[0])
        return value, ends - starts, np.zeros(len(value), np.int64)
    cuts = np.cumsum([len(v) for v in views])
    value, starts, ends = _block_words(np.concatenate(views), cuts[:-1])
    return mix(value + (ends - starts).astype(np.uint64)), ends - starts, np.searchsorted(cuts, starts, side="right")


def batch_words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text of an Arrow column the hashes and byte lengths of its words, as in :func:`words_of`."""
    views = list(byte_views(column))
    for start, end in _groups(np.array([len(v) for v in views], np.int64)):
        value, size, owner = _group_words(views[start:end])
        at = np.searchsorted(owner, np.arange(end - start + 1))
        for k in range(end - start):
            yield value[at[k] : at[k + 1]], size[at[k] : at[k + 1]]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, in order; fewer words make one hash, none make none."""
    n = len(words)
    if not n:
        return words
    take = min(size, n)
    total = np.zeros(n - take + 1, np.uint64)
    for k in range(take):
        total += words[k : n - take + 1 + k] * np.uint64((_BASE * (2 * k + 3) ** 5 | 1) & MASK64)
    return mix(total + np.uint64(take))


def batch_shingles(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text of an Arrow column the sorted distinct shingle hashes of its words."""
    views = list(byte_views(column))
    for start, end in _groups(np.array([len(v) for v in views], np.int64)):
        value, _, owner = _group_words(views[start:end])
        runs = shingle_hashes(value, size) if len(value) >= size else value[:0]
        at = np.searchsorted(owner, np.arange(end - start + 1)).tolist()
        for first, last in zip(at, at[1:], strict=False):
            own = runs[first : last - size + 1] if last - first >= size else shingle_hashes(value[first:last], size)
            yield distinct(own)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def byte_views(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of an Arrow column, without a copy; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        yield data[offsets[k] : offsets[k + 1]] if valid[k] else data[:0]


def parts(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of a column have about ``size`` bytes each; a longer text stands alone."""
    for batch in batches:
        lengths = np.array([len(x) for x in byte_views(batch.column(column))], np.int64)
        if lengths.sum() <= size:
            yield batch
            continue
        group = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(batch)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, end - start)


def as_int64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
