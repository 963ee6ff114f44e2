"""Collocations: phrases whose words stand together more often than their parts would by chance.

Map tasks fold texts into stripes: each prefix of up to two words keys a counter of the words that follow it. Merging
them element by element gives, from one structure, the total of every prefix (so all counts of one and two words), its extensions
(counts of three words) and the largest of them (what a longer phrase takes over). The counter of a one-word prefix is spread over the
totals of its two-word prefixes, so that no common word has one large stripe.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_views, materialize, mix, parts
from .stripes import PACKED, Vocabulary, bucket_count, merged, pack, pieces

#: A-Z lower-cased; the marks that end a piece become line ends, the blanks between words spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b" \t" else b for b in range(256))
#: A block ends with so many words, or so many different ones.
BLOCK, BLOCK_WORDS = 1 << 21, 1 << 19
#: The first sorts of the best phrases are over so many parts of a language.
SALTS = 16
_LOW = 0xFFFFFFFF


class _Block:
    """The words of one language that wait to be folded, with -1 between pieces."""

    def __init__(self) -> None:
        self.words, self.ids = Vocabulary(), array("i")

    def add(self, text: bytes) -> None:
        number = self.words.__getitem__
        for part in pieces(text.translate(_FOLD), b"\n "):
            for k, piece in enumerate(part.split(b"\n")):
                if k:
                    self.ids.append(-1)
                self.ids.extend(map(number, piece.split()))
        self.ids.append(-1)

    def fold(self, part: str, buckets: int) -> pa.RecordBatch:
        """Stripes of the prefixes of no word (how many words there are), of one and of two words."""
        ids = np.frombuffer(self.ids, np.int32).astype(np.int64)
        known = ids >= 0
        single = np.bincount(ids[known], minlength=len(self.words))
        pair = known[:-1] & known[1:]
        codes, place, totals = np.unique((ids[:-1] << 32 | ids[1:] & _LOW)[pair], return_inverse=True, return_counts=True)
        prefix = np.full(len(pair), -1, np.int64)
        prefix[pair] = place
        triple = (prefix[:-1] >= 0) & (prefix[1:] >= 0)
        entry, counts = np.unique(prefix[:-1][triple] << 32 | ids[2:][triple], return_counts=True)
        words, first, second = self.words.words(), codes >> 32, codes & _LOW
        keys = pa.concat_arrays([pa.array([b""], pa.binary()), words, pc.binary_join_element_wise(words.take(pa.array(first)), words.take(pa.array(second)), b" ")])
        hashes = self.words.hashes()
        hashes = np.concatenate((np.zeros(1, np.uint64), hashes, mix(hashes[first] * np.uint64(3) + hashes[second])))
        fans = np.concatenate((np.zeros(1 + len(words), np.int64), np.bincount(entry >> 32, minlength=len(codes))))
        return pack(part, keys, hashes, np.concatenate(([known.sum()], single, totals)), fans, words.take(pa.array(entry & _LOW)), counts, buckets)


def _fold(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    blocks: dict[str, _Block] = {}
    size = 0
    for batch in parts(batches, 1):
        for lang, text in zip(batch.column(0).to_pylist(), byte_views(batch.column(1)), strict=True):
            block = blocks.setdefault(lang, _Block())
            before, words = len(block.ids), len(block.words)
            block.add(text.tobytes())
            size += max(len(block.ids) - before, (len(block.words) - words) * (BLOCK // BLOCK_WORDS))
            if size >= BLOCK:
                yield from (b.fold(k, buckets) for k, b in blocks.items())
                blocks, size = {}, 0
    yield from (b.fold(k, buckets) for k, b in blocks.items())


def phrase_stripes(docs: DataFrame, min_count: int) -> DataFrame:
    """lang, key (a prefix), total, names (next words), counts, of all prefixes and extensions with ``min_count`` occurrences."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    packed = rows.mapInArrow(partial(_fold, buckets=bucket_count(rows, "text")), PACKED)
    return merged(packed, least=min_count, least_count=min_count).withColumnRenamed("part", "lang")


def _score(a: str, left: str, right: str):
    """floor(10^6 a^2 / (l r)) in whole decimals of 38 digits."""
    wide = lambda c: f"CAST(CAST({c} AS DECIMAL(18,0)) AS DECIMAL(19,0))"
    return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7,0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)}) AS BIGINT)")


def collocations(docs: DataFrame, min_count: int = 10, top: int = 2000, taken_over: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two and three words for docs (lang, text).

    Words are counted within pieces between the marks . , ; : ! ? and line ends, A-Z lower-cased, overlaps included. Candidates
    occur ``min_count`` times; their score is that of the cut that scores least, of equal ones the first. Candidates
    that a longer candidate holds are dropped if it has ``taken_over`` per cent of their occurrences.

    Null languages are "und", null and empty texts have no word, rows that repeat are counted as often as they come; ties
    end with the phrase in the order of UTF-8 bytes. More columns are ignored; an empty table gives an empty table.
    """
    stripes = materialize(phrase_stripes(docs, min_count), "prefixes")
    all_words = stripes.where("key = ''").select("lang", F.col("total").alias("n"))
    words = stripes.where("key <> '' AND instr(key, ' ') = 0").select("lang", F.col("key").alias("word"), "total")
    pairs = stripes.where("instr(key, ' ') > 0").select("lang", F.col("key").alias("phrase"), F.substring_index("key", " ", 1).alias("w1"), F.substring_index("key", " ", -1).alias("w2"), F.col("total").alias("a"), "names", "counts")
    triples = pairs.select("lang", "w1", "w2", F.col("phrase").alias("head"), F.col("a").alias("head_total"), F.explode(F.arrays_zip("names", "counts")).alias("e"))
    triples = triples.select("lang", "w1", "head", "head_total", F.col("e.names").alias("w3"), F.concat_ws(" ", "w2", "e.names").alias("tail"), F.col("e.counts").alias("a"))
    # What longer phrases take over: the largest extension on the right is in the stripe itself, that on the left comes from other stripes.
    before = triples.groupBy("lang", F.col("tail").alias("phrase")).agg(F.max("a").alias("before"))
    totals = lambda name, value: words.select("lang", F.col("word").alias(name), F.col("total").alias(value))
    free = pairs.join(before, ["lang", "phrase"], "left").where(100 * F.greatest(F.coalesce("before", F.lit(0)), F.coalesce(F.array_max("counts"), F.lit(0))) < taken_over * F.col("a"))
    two = free.join(totals("w1", "l"), ["lang", "w1"]).join(totals("w2", "r"), ["lang", "w2"])
    two = two.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score"))
    tails = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("tail_total"))
    three = triples.join(totals("w1", "first"), ["lang", "w1"]).join(totals("w3", "last"), ["lang", "w3"]).join(tails, ["lang", "tail"])
    three = three.withColumns({"early": _score("a", "first", "tail_total"), "late": _score("a", "head_total", "last")})
    cut = lambda one, other: F.when(F.col("early") <= F.col("late"), F.col(one)).otherwise(F.col(other))
    three = three.select("lang", F.concat_ws(" ", "head", "w3").alias("phrase"), "a", cut("first", "head_total").alias("l"), cut("tail_total", "last").alias("r"), cut("early", "late").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = two.unionByName(three).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(all_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
