"""Language-model scores from a hidden Markov model over words.

The vocabulary grows with the corpus, so the model has two layers. Every token is a symbol: one of
the frequent words (at least one token in ``rare_below``, hence a bounded list), the text end, or
one of 16 classes of the other words by length. A hidden Markov model over symbols is trained with
Baum-Welch: expected counts are taken per partition and summed by Spark. Inside a class a word has
its add-one share of the class's training tokens, looked up in the count table of all words, which
stays distributed. The likelihood of a text is the product of both, exactly.

Words are identified by 64-bit hashes (low 4 bits: length class). Counting them and looking their
counts up are an aggregate and a join by hash; a frequent word, which would fill one task, is in the
broadcast list, and of texts that a batch holds more than once the words are looked up once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_words, is_bucket, materialize, parts, text_key

CLASSES = 16
END = np.uint64(0)
STRETCH = 512
CELLS = 400_000


def batch_tokens(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its word hashes, low 4 bits being min(bytes, 15), and then the end."""
    for value, size in batch_words(column):
        size = np.minimum(size, CLASSES - 1).astype(np.uint64)
        yield np.append(value & ~np.uint64(15) | size, END)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 0):
        every = list(batch_tokens(batch.column(0)))
        if every:
            hashes, counts = np.unique(np.concatenate(every), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["hash", "n"])


@dataclass
class Model:
    """heavy: sorted hashes of the symbols that are words; start[0] begins a text, start[1] a stretch inside one."""

    heavy: np.ndarray
    heavy_counts: np.ndarray
    tokens: int
    words: int
    rare_tokens: np.ndarray
    rare_words: np.ndarray
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.heavy, hashes), max(0, len(self.heavy) - 1))
        known = self.heavy[at] == hashes if len(self.heavy) else np.zeros(len(hashes), bool)
        return np.where(known, at, len(self.heavy) + (hashes & np.uint64(15)).astype(np.int64))


def _by_step(lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences that lie one after another, turned to step order: longest first, so that at step t
    the first active[t] of them still run. Returns (order of sequences, offsets of steps, values)."""
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    most = int(lengths.max()) if len(lengths) else 0
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(most), side="right")
    offset = np.concatenate(([0], np.cumsum(active)))
    step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.empty(len(flat), flat.dtype)
    out[offset[step] + np.repeat(rank, lengths)] = flat
    return order, offset, out


def log_likelihoods(model: Model, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Natural log-likelihoods of whole sequences by the scaled forward recursion, all sequences side by side."""
    order, offset, obs = _by_step(lengths, symbols)
    emit = np.ascontiguousarray(model.emit.T)
    total, alpha = np.zeros(len(lengths)), np.zeros((len(lengths), 0))
    for t in range(len(offset) - 1):
        n = offset[t + 1] - offset[t]
        alpha = (model.start[0] if t == 0 else alpha[:n] @ model.move) * emit[obs[offset[t] : offset[t + 1]]]
        scale = alpha.sum(1)
        total[:n] += np.log(scale)
        alpha /= scale[:, None]
    out = np.empty(len(lengths))
    out[order] = total
    return out


def expected_counts(model: Model, lengths: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts (starts, moves, emissions) of sequences; first: whether each begins a text."""
    order, offset, obs = _by_step(lengths, symbols)
    emit = np.ascontiguousarray(model.emit.T)
    states = model.move.shape[0]
    starts, moves = np.zeros_like(model.start), np.zeros_like(model.move)
    if not len(obs):
        return starts, moves, np.zeros_like(model.emit)
    seen = emit[obs]
    alpha, scale = np.empty((len(obs), states)), np.empty(len(obs))
    cuts = [slice(offset[t], offset[t + 1]) for t in range(len(offset) - 1)]
    now = model.start[np.where(first[order], 0, 1)] * seen[cuts[0]]
    for t, at in enumerate(cuts):
        if t:
            now = (now[: at.stop - at.start] @ model.move) * seen[at]
        s = now.sum(1)
        now = now / s[:, None]
        alpha[at], scale[at] = now, s
    beta = np.ones((cuts[-1].stop - cuts[-1].start, states))
    gamma = np.empty_like(alpha)
    for t in range(len(cuts) - 1, -1, -1):
        at = cuts[t]
        gamma[at] = alpha[at] * beta
        if t:
            before = cuts[t - 1]
            ahead = seen[at] * beta / scale[at][:, None]
            moves += alpha[before][: len(ahead)].T @ ahead
            beta = np.ones((before.stop - before.start, states))
            beta[: len(ahead)] = ahead @ model.move.T
    head = gamma[cuts[0]]
    starts[0], starts[1] = head[first[order]].sum(0), head[~first[order]].sum(0)
    emissions = np.stack([np.bincount(obs, gamma[:, k], model.emit.shape[1]) for k in range(states)])
    return starts, moves * model.move, emissions


def _stretches(model: Model, texts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of stretches of up to STRETCH tokens: lengths, symbols, whether each begins a text."""
    lengths, symbols, first, cells = [], [], [], 0
    for hashes in texts:
        whole = model.symbols(hashes)
        for at in range(0, len(whole), STRETCH):
            part = whole[at : at + STRETCH]
            lengths.append(len(part))
            symbols.append(part)
            first.append(at == 0)
            cells += len(part)
            if cells >= CELLS:
                yield np.array(lengths), np.concatenate(symbols), np.array(first)
                lengths, symbols, first, cells = [], [], [], 0
    if lengths:
        yield np.array(lengths), np.concatenate(symbols), np.array(first)


def _expect(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums = shared.value, None
        for batch in parts(batches, 0):
            for group in _stretches(model, batch_tokens(batch.column(0))):
                got = np.concatenate([x.ravel() for x in expected_counts(model, *group)])
                sums = got if sums is None else sums + got
        if sums is not None:
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at])], ["cell", "amount"])

    return run


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def _first_model(counts: DataFrame, states: int, rare_below: int, seed: int) -> Model:
    sums = counts.groupBy(F.col("hash").bitwiseAND(CLASSES - 1).alias("kind")).agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).collect()
    by = {c: np.zeros(CLASSES, np.int64) for c in ("tokens", "words")}
    for row in sums:
        for c, values in by.items():
            values[row["kind"]] = row[c]
    tokens, words = int(by["tokens"].sum()), int(by["words"].sum())
    top = counts.where((F.col("n") >= max(1, tokens / rare_below)) | (F.col("hash") == int(END))).toPandas()
    heavy = top["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(heavy)
    heavy, n = heavy[order], top["n"].to_numpy(np.int64)[order]
    kind = (heavy & np.uint64(15)).astype(np.int64)
    rare_tokens = by["tokens"] - np.bincount(kind, n, CLASSES).astype(np.int64)
    rare_words = by["words"] - np.bincount(kind, minlength=CLASSES)
    random = np.random.Generator(np.random.PCG64(seed))
    share = np.concatenate((n, rare_tokens)) + 0.5
    emit = _normal(share * random.uniform(0.5, 1.5, (states, len(share))))
    move = _normal(random.uniform(0.5, 1.0, (states, states)) + 2 * np.eye(states))
    return Model(heavy, n, tokens, words, rare_tokens, rare_words, np.full((2, states), 1 / states), move, emit)


def _trained(texts: DataFrame, model: Model, rounds: int) -> Model:
    spark, states, cells = texts.sparkSession, model.move.shape[0], model.emit.shape[1]
    share = np.concatenate((model.heavy_counts, model.rare_tokens)) + 0.5
    prior = 5 * share / share.sum()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        sums = texts.mapInArrow(_expect(shared), "cell long, amount double").groupBy("cell").agg(F.sum("amount").alias("amount")).toPandas()
        flat = np.zeros(2 * states + states * states + states * cells)
        flat[sums["cell"].to_numpy(np.int64)] = sums["amount"]
        a, b = 2 * states, 2 * states + states * states
        model = Model(
            model.heavy, model.heavy_counts, model.tokens, model.words, model.rare_tokens, model.rare_words,
            _normal(flat[:a].reshape(2, states) + 1), _normal(flat[a:b].reshape(states, states) + 1), _normal(flat[b:].reshape(states, cells) + prior),
        )
    return model


def _forward(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        base = np.log10((model.heavy_counts + 1) / (model.tokens + model.words + 1))
        for batch in parts(batches, 0):
            hashes = list(batch_tokens(batch.column(0)))
            lengths = np.array([len(x) for x in hashes], np.int64)
            symbols = model.symbols(np.concatenate(hashes)) if hashes else np.zeros(0, np.int64)
            heavy = symbols < len(base)
            who = np.repeat(np.arange(len(lengths)), lengths)[heavy]
            sums = np.bincount(who, base[symbols[heavy]], len(lengths))
            known = np.bincount(who, minlength=len(lengths))
            score = log_likelihoods(model, lengths, symbols) / np.log(10)
            columns = [pa.array(lengths), pa.array(known.astype(np.int64)), pa.array(sums.astype(float)), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], [*batch.schema.names[1:], "n_tokens", "known", "base", "states"])

    return run


def _entries(shared):
    """(key, hash, times) of the words of each text that are not in the frequent list, and (key, end, 1)
    for every time that its words are listed: once for all its copies in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in parts(batches, 1, 1 << 22):
            keys = batch.column(0).to_numpy()
            first = np.zeros(len(keys), bool)
            first[np.unique(keys, return_index=True)[1]] = True
            batch = batch.filter(pa.array(first))
            owners, hashes, times = [], [], []
            for key, tokens in zip(batch.column(0).to_pylist(), batch_tokens(batch.column(1)), strict=True):
                words, n = np.unique(tokens[model.symbols(tokens) >= len(model.heavy)], return_counts=True)
                if len(words):
                    owners.append(np.full(len(words) + 1, key, np.int64))
                    hashes += [words, np.array([END])]
                    times += [n, np.ones(1, np.int64)]
            if owners:
                columns = [np.concatenate(owners), np.concatenate(hashes).view(np.int64), np.concatenate(times).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "hash", "times"])

    return run


def _rare_sums(entries: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """For each text key the sums over its words outside the frequent list: rare_base, rare_in, rare_known.

    A text that was listed several times has each sum as often, so the sums are shared out again.
    """
    c = F.coalesce("n", F.lit(0))
    inside = F.lit(float(model.rare_tokens[0] + model.rare_words[0] + 1))
    for kind in range(1, CLASSES):
        inside = F.when(F.col("hash").bitwiseAND(CLASSES - 1) == kind, F.lit(float(model.rare_tokens[kind] + model.rare_words[kind] + 1))).otherwise(inside)
    word = F.col("hash") != int(END)
    log = lambda of: F.sum(F.when(word, F.col("times") * F.log10((c + 1) / of)).otherwise(0.0))
    sums = (
        entries.join(counts.where(F.col("hash") != int(END)), "hash", "left")
        .groupBy("key")
        .agg(log(F.lit(float(model.tokens + model.words + 1))).alias("base"), log(inside).alias("inside"), F.sum(F.when(word & (c > 0), F.col("times")).otherwise(0)).alias("known"), F.count_if(~word).alias("listed"))
    )
    return sums.select("key", (F.col("base") / F.col("listed")).alias("rare_base"), (F.col("inside") / F.col("listed")).alias("rare_in"), F.expr("known div listed").alias("rare_known"))


def hmm_scores(docs: DataFrame, held_out_modulus: int = 7, held_out_remainder: int = 2, states: int = 4, rounds: int = 3, rare_below: int = 50_000, seed: int = 10) -> DataFrame:
    """Score every row's whole text under a model of the rows that are not held out.

    ``docs`` has doc_id and text; more columns are ignored. Returns for every row doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score (add-one unigram, log10) and score (log10 probability
    under the hidden Markov model).

    Null and empty texts consist of the end token alone and get its score. Rows repeat as in the
    input; a null doc_id counts as the text '' when rows are held out. If nothing is left to train on, all
    counts are 0 and the scores are those of the smoothed model. An empty table gives an empty table.

    In training, texts are cut into stretches of 512 tokens; in scoring they are not.
    """
    rows = docs.select("doc_id", "text", is_bucket(F.col("doc_id"), held_out_modulus, held_out_remainder).alias("held_out"))
    spark = docs.sparkSession
    training = rows.where(~F.col("held_out")).select("text")
    counts = training.mapInArrow(_count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "counts")
    model = _trained(training, _first_model(counts, states, rare_below, seed), rounds)
    shared = spark.sparkContext.broadcast(model)

    keyed = rows.withColumn("key", text_key(F.col("text")))
    entries = keyed.select("key", "text").mapInArrow(_entries(shared), "key long, hash long, times long")
    rare = materialize(_rare_sums(entries, counts, model), "rare")

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = keyed.select("text", "doc_id", "held_out", "key").mapInArrow(_forward(shared), f"doc_id {id_type}, held_out boolean, key long, n_tokens long, known long, base double, states double")
    return scored.join(rare, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("states") + F.coalesce("rare_in", F.lit(0.0))).alias("score"),
    )
