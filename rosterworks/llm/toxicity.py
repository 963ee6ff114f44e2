"""Toxicity scores of texts after undoing obfuscation with a noisy-channel model.

The channel turns letters into look-alike signs, repeats letters and puts spaces or marks between
them. A token that could hide a listed word becomes a lattice of readings; Viterbi decoding under a
character language model (4-grams over all documents, with shorter ones mixed in) picks one, and
the restored words are what the classifier sees. Tokens that no reading can turn into a listed word
have one path only and are left as they are.

Listed words are those whose presence separates labelled toxic documents from others; the
classifier is a logistic regression on their presence in restored text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_views, is_bucket, parts

# Signs that stand for letters, in the order they are tried.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
MARKS = " \t\n.-_*'~"
EDGE = ".,;:?\"'()[]{}<>~_-…»«“”"
#: Letters and signs that can be read as each other share a class, named by one letter.
CLASS = str.maketrans({**{s: letters[0] for s, letters in LOOKALIKES.items() if s != "*"}, "l": "i", "£": "i", "6": "g", **dict.fromkeys(MARKS)})
_SIGNS = re.escape("".join(s for s in LOOKALIKES if not s.isalnum()))
SPACED = re.compile(rf"(?<!\S)[^\W_]?[\w{_SIGNS}](?:[\s._*~-]+[\w{_SIGNS}]){{2,}}(?![^\s.,;:?!])")
#: Edge signs that stand for letters; the rest of EDGE is stripped from both ends of a token in any case.
EDGE_SIGNS = "".join(c for c in EDGE if c in LOOKALIKES)
_BARE_EDGE = "".join(c for c in EDGE if c not in LOOKALIKES)
_TWICE, _AGAIN = re.compile(r"(.)\1", re.DOTALL), re.compile(r"(.)\1+", re.DOTALL)
GRAM, SIZE = 4, 27
MEMO = 200_000


def _letter_table() -> np.ndarray:
    """Letter numbers of bytes: a-z and Latin letters with accents 1-26, the lead byte of these 255, others 0."""
    table = np.zeros(256, np.uint8)
    table[97:123] = table[65:91] = np.arange(1, 27)
    for byte in range(0x80, 0xC0):
        plain = unicodedata.normalize("NFD", chr(byte + 0x40))[0].lower()
        table[byte] = ord(plain) - 96 if "a" <= plain <= "z" else 0
    table[0xC3] = 255
    return table


_LETTERS = _letter_table()


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE**GRAM, np.int64)
    for batch in batches:
        for data in byte_views(batch.column(0)):
            for at in range(0, len(data), 1 << 20):
                x = _LETTERS[data[max(0, at - GRAM + 1) : at + (1 << 20)]]
                x = x[x != 255].astype(np.int32)
                x = np.concatenate(([0] * (GRAM - 1) * (at == 0), x, [0])).astype(np.int32)
                if len(x) >= GRAM:
                    n = len(x) - GRAM + 1
                    cell = x[:n].copy()
                    for k in range(1, GRAM):
                        cell = cell * SIZE + x[k : k + n]
                    total += np.bincount(cell, minlength=len(total)) if n > 50_000 else 0
                    if n <= 50_000:
                        np.add.at(total, cell, 1)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["gram", "n"])


@dataclass
class CharModel:
    """log P(letter | up to three before), as a table of 27**4 cells."""

    table: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> CharModel:
        cells = counts.reshape((SIZE,) * GRAM).astype(float)
        mixed = np.full(SIZE, 1 / SIZE)
        for order, weight in zip(range(1, GRAM + 1), (0.9, 0.9, 0.9, 0.9), strict=True):
            part = cells.sum(axis=tuple(range(GRAM - order)))
            total = part.sum(-1, keepdims=True)
            seen = total / (total + 50)
            mixed = weight * seen * part / np.maximum(total, 1) + (1 - weight * seen) * mixed[None] if order > 1 else weight * seen * part / np.maximum(total, 1) + (1 - weight * seen) * mixed
        return cls(np.log(mixed).astype(np.float32))

    def decode(self, seen: str) -> str:
        """The most likely text behind what is seen; words in it are parted by spaces."""
        best = {(0, 0, 0): (0.0, "")}
        waiting: dict[int, dict] = defaultdict(dict)
        waiting[0] = best
        for at in range(len(seen)):
            for context, (score, text) in waiting.pop(at, {}).items():
                for end, letters, cost in self._edges(seen, at):
                    now, total, out = context, score - cost, text
                    for letter in letters:
                        number = ord(letter) - 96 if "a" <= letter <= "z" else 0
                        if not (number == 0 and now[2] == 0):
                            total += float(self.table[now[0], now[1], now[2], number])
                            now = (now[1], now[2], number)
                            out += letter
                    old = waiting[end].get(now)
                    if old is None or total > old[0]:
                        waiting[end][now] = (total, out)
        last = waiting.get(len(seen), {})
        ended = [(score + float(self.table[c[0], c[1], c[2], 0]), text) for c, (score, text) in last.items()]
        return max(ended, default=(0, seen))[1]

    @staticmethod
    def _edges(seen: str, at: int) -> list[tuple[int, str, float]]:
        c, run = seen[at], at + 1
        while run < len(seen) and seen[run] == c:
            run += 1
        edges = []
        if c.isalpha():
            edges += [(at + 1, c, 0.0)] if run - at < 3 else [(run, c, 1.0), (run, c * 2, 1.5)]
            if run - at == 2:
                edges.append((run, c, 3.0))
        for letter in LOOKALIKES.get(c, ""):
            edges += [(at + 1, letter, 1.0)] + [(run, letter, 1.5)] * (run - at > 1)
        if c in MARKS:
            edges += [(run, "", 0.5), (run, " ", 1.5)]
        elif not c.isalpha():
            edges.append((at + 1, " ", 4.0))
        return edges


def once(word: str) -> str:
    """The word without repeats of a letter."""
    return _AGAIN.sub(r"\1", word) if _TWICE.search(word) else word


def shape(token: str) -> str:
    """The token's class letters without marks and repeats: equal for all disguises of a word."""
    return once(token.translate(CLASS))


@dataclass
class Restorer:
    """Finds the listed words in a text, disguised or not."""

    chars: CharModel
    words: frozenset[str]
    memo: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.shapes = frozenset(shape(w) for w in self.words)
        self.plain = {once(w): w for w in sorted(self.words)}

    def _decoded(self, seen: str) -> tuple[str, ...]:
        """Listed words in the most likely reading; letters that it repeats or not make no difference."""
        return tuple(self.plain[w] for x in self.chars.decode(seen).split() if (w := once(x)) in self.plain)

    def _read(self, token: str) -> tuple[str, ...]:
        core = token.strip(EDGE)
        if core in self.words:
            return (core,)
        if core.isalpha() and not _TWICE.search(core):
            return (self.plain[core],) if core in self.plain else ()
        for text in dict.fromkeys((core.rstrip("!"), core)):
            if text in self.words:
                return (text,)
            if "*" in text or shape(text) in self.shapes:
                if got := self._decoded(text):
                    return got
        return ()

    def _signed(self, token: str) -> tuple[str, ...]:
        """Readings with look-alikes kept at the edges: at both, at the start, at the end."""
        token = token.strip(_BARE_EDGE)
        for text in dict.fromkeys((token, token.rstrip(EDGE + "!"), token.lstrip(EDGE))):
            if text and (text[0] in EDGE_SIGNS or text[-1] in EDGE_SIGNS) and shape(text) in self.shapes and (got := self._decoded(text)):
                return got
        return ()

    @staticmethod
    def _bracketed(text: str, token: str) -> bool:
        """Whether the token's plain letters stand in brackets wherever it occurs: "(rap music)" has no hidden letter."""
        if not token.strip(EDGE).isalpha():
            return False
        at = text.find(token)
        while at >= 0:
            sign = next(k for k in range(at, at + len(token)) if text[k] in EDGE_SIGNS)
            end = text.find(")" if text[sign] == "(" else ">", sign + 1, sign + 200)
            if end < 0 or text.find(text[sign], sign + 1, end) >= 0:
                return False
            at = text.find(token, at + len(token))
        return True

    def words_in(self, text: str) -> set[str]:
        lower, memo, found = text.lower(), self.memo, set()
        for token in set(lower.split()):
            got = memo.get(token)
            if got is None:
                if token.isalpha() and not _TWICE.search(token):
                    # What _read says of plain words, most of which are too rare to be remembered.
                    if token in self.words:
                        found.add(token)
                    elif token in self.plain:
                        found.add(self.plain[token])
                    continue
                if len(memo) > MEMO:
                    memo.clear()
                got = memo[token] = self._read(token)
            if got:
                found.update(got)
            elif "(" in token or "<" in token:
                hidden = memo.get((token,))
                if hidden is None:
                    hidden = memo[token,] = self._signed(token)
                if hidden and not self._bracketed(lower, token):
                    found.update(hidden)
        for match in SPACED.finditer(lower):
            hidden = shape(match[0])
            if any(s in hidden for s in self.shapes):
                found.update(self._decoded(match[0]))
        return found


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 0):
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update({w for t in set((text or "").lower().split()) if (w := t.strip(EDGE + "!"))})
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *[pa.array([c[w] for w in words], pa.int64()) for c in counts]], ["word", "clean", "toxic"])


def _listed_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(*shared.value)
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic][" ".join(sorted(restorer.words_in(text or "")))] += 1
        found = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *[pa.array([c[w] for w in found], pa.int64()) for c in counts]], ["found", "clean", "toxic"])

    return run


def fit_logistic(x: np.ndarray, clean: np.ndarray, toxic: np.ndarray, word_ridge: float = 0.5, any_ridge: float = 0.01) -> np.ndarray:
    """Weights of a logistic regression on counted rows by Newton steps: one for each word, one for
    "any listed word", which is held back less since more rows speak for it, and the bias."""
    x = np.hstack([x, x.any(axis=1, keepdims=True), np.ones((len(x), 1))])
    ridge = np.diag([word_ridge] * (x.shape[1] - 2) + [any_ridge, 1e-6])
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (toxic - (clean + toxic) * p) - ridge @ beta
        bend = (x * ((clean + toxic) * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


@dataclass
class ToxicityModel:
    chars: CharModel
    weights: dict[str, float]
    any_word: float
    bias: float

    def scorer(self):
        restorer = Restorer(self.chars, frozenset(self.weights))

        def score(text: str | None) -> float:
            found = restorer.words_in(text or "")
            odds = self.bias + self.any_word * bool(found) + sum(self.weights[w] for w in sorted(found))
            return 1 / (1 + math.exp(-min(500.0, max(-500.0, odds))))

        return score


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, max_rows: int = 20_000, min_docs: int = 5, min_lift: float = 4.0, min_gain: float = 30.0) -> ToxicityModel:
    """Fit the model: letter statistics on all texts, word weights on labelled rows that are not held out.

    ``max_rows`` bounds the labelled rows (in expectation; rows are chosen by a hash of doc_id), so
    the sample and with it the vocabulary can be sent to every executor. Listed are words in at
    least ``min_docs`` toxic rows, ``min_lift`` times as common there, with a log-likelihood ratio
    (G) of ``min_gain``, all of them: the sample bounds their number. A doc_id with several
    labels is toxic if one of them says so; rows without a label (null) are not used. With no labelled
    row of either kind the scores are 0.5 everywhere.
    """
    spark = docs.sparkSession
    grams = docs.select("text").mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE**GRAM)
    counts[grams["gram"].to_numpy(np.int64)] = grams["n"]
    chars = CharModel.of(counts)

    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_bucket(F.col("doc_id"), modulus, 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = known.count()
    share = min(1.0, max_rows / max(1, rows))
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    taught = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    words = taught.mapInArrow(_word_counts, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    size = sample.groupBy("toxic").count().toPandas().set_index("toxic")["count"]
    n0, n1 = int(size.get(0, 0)), int(size.get(1, 0))
    if not n0 or not n1:
        return ToxicityModel(chars, {}, 0.0, 0.0)
    part = lambda seen, of: F.when(seen > 0, seen * F.log(seen * (n0 + n1) / (of * (F.col("toxic") + F.col("clean"))))).otherwise(0.0)
    rest = lambda seen, of: F.when(of > seen, (of - seen) * F.log((of - seen) * (n0 + n1) / (of * (n0 + n1 - F.col("toxic") - F.col("clean"))))).otherwise(0.0)
    gain = 2 * (part(F.col("toxic"), n1) + part(F.col("clean"), n0) + rest(F.col("toxic"), n1) + rest(F.col("clean"), n0))
    lift = (F.col("toxic") + 0.5) / (n1 + 1) * (n0 + 1) / (F.col("clean") + 0.5)
    listed = words.where((F.col("toxic") >= min_docs) & (lift >= min_lift)).withColumn("gain", gain).where(F.col("gain") >= min_gain)
    vocabulary = frozenset(r.word for r in listed.select("word").collect())

    shared = spark.sparkContext.broadcast((chars, vocabulary))
    seen = taught.mapInArrow(_listed_counts(shared), "found string, clean long, toxic long").groupBy("found").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).orderBy("found").toPandas()
    order = sorted(vocabulary)
    x = np.array([[w in found for w in order] for found in map(str.split, seen["found"])], float).reshape(len(seen), len(order))
    beta = fit_logistic(x, seen["clean"].to_numpy(float), seen["toxic"].to_numpy(float))
    return ToxicityModel(chars, dict(zip(order, beta[:-2].tolist(), strict=True)), float(beta[-2]), float(beta[-1]))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in parts(batches, 0):
            values = [score(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values, pa.float64())], [*batch.schema.names[1:], "score"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, modulus: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text; other columns are ignored).

    Null and empty texts hold no word and get the score of that; repeated rows repeat, equal texts
    score equally; a null doc_id counts as the text '' when rows are held out; no rows, no scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("text", "doc_id", is_bucket(F.col("doc_id"), modulus, 0).alias("held_out"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_score(shared), f"doc_id {id_type}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _clean(shared, limit: float, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in parts(batches, place):
            yield batch.filter(pa.array([score(x) < limit for x in batch.column(place).to_pylist()], pa.bool_()))

    return run


def drop_toxic(docs: DataFrame, model: ToxicityModel, limit: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores below ``limit``, with all their columns, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_clean(shared, limit, docs.columns.index("text")), docs.schema)
