"""Audit of sources: how far the words of a source diverge from the other sources of its language.

Map tasks fold whole documents into stripes (term: document frequency and counts by source); the merged stripes are
dealt over buckets of bounded size, and each bucket emits its share of every divergence and its best terms.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_views, materialize, parts
from .stripes import PACKED, Vocabulary, bucket_count, merged, pack, pieces

#: Terms are runs of these bytes: letters, A-Z lower-cased, and all of UTF-8 beyond ASCII.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A block ends with so many words, or so many different ones; a bucket of merged stripes has so many counts.
BLOCK, BLOCK_WORDS, BUCKET = 1 << 21, 1 << 19, 200_000
#: Cells of the table of shares that are compared at once.
CELLS = 1 << 20
SHARE = 1_000_000_000


class _Block:
    """The documents of one language that wait to be folded."""

    def __init__(self) -> None:
        self.terms, self.sources, self.ids, self.owner, self.size = Vocabulary(), Vocabulary(), [], [], 0

    def add(self, source: str, text: bytes) -> None:
        document = len(self.ids)
        found = [np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words)) for words in (p.split() for p in pieces(text.translate(_TERMS), b" "))]
        self.ids.append(found[0] if len(found) == 1 else np.concatenate(found))
        self.owner.append(self.sources[source.encode()])
        self.size += len(self.ids[document]) + 1

    def fold(self, part: str, buckets: int) -> pa.RecordBatch:
        """Stripes of all terms, and that of the empty key, which counts the documents of each source."""
        length, owner = np.array([len(x) for x in self.ids]), np.array(self.owner, np.int64)
        term = np.concatenate(self.ids).astype(np.int64)
        frequency = np.bincount(np.unique(np.repeat(np.arange(len(length)), length) << 32 | term) & 0xFFFFFFFF, minlength=len(self.terms))
        entry, counts = np.unique(term << 32 | np.repeat(owner, length), return_counts=True)
        documents = np.bincount(owner, minlength=len(self.sources))
        fans = np.concatenate((np.bincount(entry >> 32, minlength=len(self.terms)), [len(documents)]))
        names = np.concatenate((entry & 0xFFFFFFFF, np.arange(len(documents))))
        keys = pa.concat_arrays([self.terms.words(), pa.array([b""], pa.binary())])
        hashes = np.concatenate((self.terms.hashes(), np.zeros(1, np.uint64)))
        return pack(part, keys, hashes, np.concatenate((frequency, [len(owner)])), fans, self.sources.words().take(pa.array(names)), np.concatenate((counts, documents)), buckets)


def _fold(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    blocks: dict[str, _Block] = {}
    size = 0
    for batch in parts(batches, 2):
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_views(batch.column(2)), strict=True):
            block = blocks.setdefault(lang, _Block())
            before, words = block.size, len(block.terms)
            block.add(source, text.tobytes())
            size += max(block.size - before, (len(block.terms) - words) * (BLOCK // BLOCK_WORDS))
            if size >= BLOCK:
                yield from (b.fold(k, buckets) for k, b in blocks.items())
                blocks, size = {}, 0
    yield from (b.fold(k, buckets) for k, b in blocks.items())


def term_stripes(docs: DataFrame, min_docs: int) -> DataFrame:
    """part (language), key (term), total (documents), names (sources), counts; the empty key counts documents."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return merged(rows.mapInArrow(partial(_fold, buckets=bucket_count(rows, "text")), PACKED), least=min_docs)


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SHARE * count / total) for counts up to the total, by long division in steps of 1000."""
    quotient, rest = np.zeros(np.broadcast_shapes(count.shape, total.shape), np.int64), np.broadcast_to(count, np.broadcast_shapes(count.shape, total.shape))
    more, rest = np.divmod(rest, total)
    quotient += more
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        quotient = quotient * 1000 + more
    return quotient + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _emit(key: tuple, stripes: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """The bucket's part of all pairs of the language's sources, and the best terms of each source."""
    lang, bucket = key[0].as_py(), key[1].as_py()
    groups = groups.sort_by("source")
    sources, n = groups.column("source").to_pylist(), groups.column("n").to_numpy().astype(np.int64)
    out = {"source": [], "part": [], "item": [], "value": []}
    if sources and (len(stripes) or bucket == 0):
        terms, vocabulary, width = stripes.column("key"), int(groups.column("v")[0].as_py()), len(sources)
        place = {s: k for k, s in enumerate(sources)}
        fan = np.array([len(x) for x in stripes.column("names")], np.int64)
        column = np.array([place[x] for names in stripes.column("names") for x in names.as_py()], np.int64)
        count = np.array([x for counts in stripes.column("counts") for x in counts.as_py()], np.int64)
        row, ends = np.repeat(np.arange(len(terms)), fan), np.concatenate(([0], np.cumsum(fan)))
        sums, best, total = np.zeros((width, width), np.int64), [[] for _ in sources], n + 2 * vocabulary
        whole = n.sum() + 2 * vocabulary
        for low in range(0, len(terms), max(1, CELLS // width)):
            high = min(len(terms), low + max(1, CELLS // width))
            cells = np.zeros((high - low, width), np.int64)
            here = slice(ends[low], ends[high])
            cells[row[here] - low, column[here]] = count[here]
            share, used = _share(cells + 2, total), cells > 0
            flags = used.astype(np.float32)  # exact: a chunk has fewer than 2^24 rows
            both = (flags.T @ flags).astype(np.int64)
            alone = both.diagonal()
            missing = (high - low) - alone[:, None] - alone[None, :] + both
            base = _share(np.array([2]), total)
            sums += missing * _apart(base[:, None], base[None, :])
            overall = _share(cells.sum(1) + 2, np.array([whole]))
            for s in range(width):
                mine = np.flatnonzero(used[:, s])
                if not len(mine):
                    continue
                counted = ~used[mine]
                counted[:, s + 1 :] = True
                far = (_apart(share[mine, s : s + 1], share[mine]) * counted).sum(0)
                sums[s] += far
                sums[:, s] += far
                more = mine[share[mine, s] > overall[mine]]
                value = _apart(share[more, s], overall[more])
                if len(value) > top:
                    least = np.partition(value, len(value) - top)[len(value) - top]
                    more, value = more[value >= least], value[value >= least]
                best[s] = sorted([*best[s], *((-v, terms[low + k].as_py().encode()) for v, k in zip(value.tolist(), more.tolist(), strict=True))])[:top]
        for s, source in enumerate(sources):
            out["source"] += [source] * (width - 1 + len(best[s]))
            out["part"] += ["pair"] * (width - 1) + ["term"] * len(best[s])
            out["item"] += [x for x in sources if x != source] + [t.decode() for _, t in best[s]]
            out["value"] += [int(sums[s, t]) for t in range(width) if t != s] + [-v for v, _ in best[s]]
    return pa.table({"lang": pa.array([lang] * len(out["source"]), pa.string()), "source": pa.array(out["source"], pa.string()), "part": pa.array(out["part"], pa.string()), "item": pa.array(out["item"], pa.string()), "value": pa.array(out["value"], pa.int64())})


def source_divergences(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank for docs (lang, source, text).

    A term's share in a group (lang, source) is 1 + floor(10^9 * (count + 2) / (N + 2 V)), with V kept terms of the
    language (those in at least ``min_docs`` of its documents) and N their occurrences in the group. Part "pair" compares the group
    with each other source of its language: the sum over all kept terms of floor((p - q)^2 / (p + q)). Part "term" lists the
    ``top`` terms of the group that stand out most against the whole language.

    Null lang, source and text count as ''; rows that repeat are documents of their own; a group without a word, or a
    language without a kept term, still has its pairs (value 0 for no term). Ties go to the smaller item in the order of UTF-8
    bytes. More columns are ignored; an empty table gives an empty table. The result has a row for each pair of sources of a
    language, and so has a bucket's part of it: a language's number of sources squared must fit into a task.
    """
    kept = materialize(term_stripes(docs, min_docs), "stripes")
    named = kept.where("key = ''").select(F.col("part").alias("lang"), F.explode("names").alias("source"))
    terms = kept.where("key <> ''").select(F.col("part").alias("lang"), "key", "names", "counts")
    counts = terms.select("lang", F.explode(F.arrays_zip("names", "counts")).alias("e")).groupBy("lang", F.col("e.names").alias("source")).agg(F.sum("e.counts").alias("n"))
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"))
    groups = named.join(counts, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = materialize(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")), "groups")
    buckets = (terms.agg(F.sum(F.size("names"))).first()[0] or 0) // BUCKET + 1
    dealt = terms.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("lang", "bucket")
    known = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<long>"))).groupBy("lang", "bucket")
    found = dealt.cogroup(known).applyInArrow(lambda key, left, right: _emit(key, left, right, top), "lang string, source string, part string, item string, value long")
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
