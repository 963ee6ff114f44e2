"""Personal data: base patterns, and more identifiers by bootstrapped contexts.

Base matches are seeds. Every seed and every stretch that could be an identifier (digits, an "at")
stands between two words; the pair of words, and each of them alone, are lexical patterns. Spark
keeps the graph of patterns and instances. In a pass it scores both in turn: a pattern by the share
of its weight that hangs on instances of a kind, an instance by the patterns it occurs in.
Candidates in patterns that reach the threshold and that enough different instances support are new
identifiers; they are seeds of the next pass, in which the other contexts that they stand in can
become strong patterns, until a pass finds nothing new.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_few, materialize, parts, text_key, with_keyed

# The kinds in their order, and what their matches look like.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What may be an identifier although no base pattern says so: words around an "at" (in brackets, or
#: with a "dot" later), groups of digits, a token with digits.
_FAST = re.compile(
    r"(?<!\S)[^\s\[(<{]++[^\S\n]?[\[(<{][^\S\n]?at[^\S\n]?[\])>}][^\S\n]?\S+"
    r"|(?<!\S)[\w.+-]++ at [\w-]++(?: dot [\w-]++)++"
    r"|(?<!\S)[(+]?[0-9][0-9()./-]*+(?:[^\S\n]\(?[0-9][0-9()./-]*+)+(?![^\s.,;:?!])"
    r"|(?<!\S)[^\s0-9]*+[0-9]\S*",
    re.IGNORECASE,
)
_AT = re.compile(r"[\[(<{]\s?at\s?[\])>}]| at .* dot ", re.IGNORECASE)
_EDGE = ".,;:?!\"'()[]<>"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping: what stands before an "@" reaches back as far as it can, so every "@" is tried once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (match := _DOMAIN.match(text, at + 1)):
            yield start, match.end()
            done = match.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all base matches by kind and start; code points, end exclusive."""
    spans = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    for match in _IP.finditer(text):
        parts = match[0].split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
                spans.append(("phone", *match.span()))
    return spans


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def contexts(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """The words before and after each of the spans, without marks at their edges.

    A word ends where another span begins, so a text is read at most twice however long its words are;
    next to another span and at the ends of the text there is none ("").
    """
    order = sorted(range(len(spans)), key=lambda k: spans[k])
    out, begun, reach = [("", "")] * len(spans), 0, 0
    following = [*(spans[k][0] for k in order[1:]), len(text)][: len(order)]
    for k, stop in zip(order, following, strict=True):
        start, end = spans[k]
        before, after = text[max(begun, reach) : start].rsplit(None, 1), text[end : max(end, stop)].split(None, 1)
        out[k] = (before[-1].lower().strip(_EDGE) if before else "", after[0].lower().strip(_EDGE) if after else "")
        begun, reach = start, max(reach, end)
    return out


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Stretches that may be identifiers and touch no base match."""
    taken = sorted((s, e) for _, s, e in spans)
    ends = [e for _, e in taken]
    out = []
    for match in _FAST.finditer(text):
        token = match[0]
        digits = sum(c.isdigit() for c in token)
        if digits < 4 and not _AT.search(token):
            continue
        start, end = match.start(), match.end()
        while end > start and text[end - 1] in ".,;:?!\"')]>}":
            end -= 1
        while start < end and text[start] in "\"'([<{" and not (text[start] == "(" and ")" in text[start:end]):
            start += 1
        k = int(np.searchsorted(ends, start, side="right")) if ends else 0
        if end > start and not (k < len(taken) and taken[k][0] < end):
            out.append((start, end))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SIGHT = pa.struct([("kind", pa.string()), ("instance", pa.string()), ("left", pa.string()), ("right", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPAN_SQL = "array<struct<kind string, start bigint, end bigint>>"
SIGHT_SQL = "array<struct<kind string, instance string, left string, right string, start bigint, end bigint>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 0):
        spans, sights = [], []
        for text in batch.column(0).to_pylist():
            text = text or ""
            base = base_spans(text)
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            seen = [*base, *(("", s, e) for s, e in candidates(text, base))]
            row = []
            for (kind, s, e), (left, right) in zip(seen, contexts(text, [(s, e) for _, s, e in seen]), strict=True):
                row.append({"kind": kind, "instance": hashlib.blake2b(text[s:e].lower().encode(), digest_size=8).hexdigest(), "left": left, "right": right, "start": s, "end": e})
            sights.append(row)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(spans, pa.list_(_SPAN)), pa.array(sights, pa.list_(_SIGHT))], [*batch.schema.names[1:], "base", "sights"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), base spans and sightings of seeds and candidates: one pass over the texts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("text", "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    return rows.mapInArrow(_scan, f"doc_id {id_type}, key long, base {SPAN_SQL}, sights {SIGHT_SQL}")


NONE = "instance string, kind string"


def _labelled(edges: DataFrame, accepted: DataFrame) -> DataFrame:
    """Edges with the kind that is known of their instance: that of a base match, else the accepted one, else ''."""
    known = accepted.select("instance", F.col("kind").alias("learned"))
    return edges.join(known, "instance", "left").withColumn("kind", F.when(F.col("kind") != "", F.col("kind")).otherwise(F.coalesce("learned", F.lit("")))).drop("learned")


def _good_patterns(edges: DataFrame, rounds: int, min_seeds: int, threshold: float) -> DataFrame:
    """pattern, kind, score of the patterns that reach the threshold, from labelled edges."""
    seeds = edges.where("kind <> ''").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"), F.sum("n").alias("weight"))
    seeds = materialize(seeds.where(F.col("seeds") >= min_seeds), "seeds")
    met = edges.join(if_few(seeds.select("pattern").distinct()), "pattern", "left_semi")
    whole = met.groupBy("pattern").agg(F.sum("n").alias("whole"))
    scores = seeds.join(whole, "pattern").select("pattern", F.col("kind").alias("as_kind"), "weight", "whole", (F.col("weight") / (F.col("whole") + 1)).alias("score"))
    scores = materialize(scores, "patterns")
    open_edges = materialize(met.where("kind = ''").select("pattern", "instance", "n"), "open")
    weight = open_edges.groupBy("instance").agg(F.sum("n").alias("all"))
    for _ in range(rounds - 1):
        part = open_edges.join(if_few(scores), "pattern").groupBy("instance", "as_kind").agg(F.sum(F.col("n") * F.col("score")).alias("part"))
        belief = part.join(weight, "instance").select("instance", "as_kind", (F.col("part") / F.col("all")).alias("belief"))
        gain = open_edges.join(belief, "instance").groupBy("pattern", "as_kind").agg(F.sum(F.col("n") * F.col("belief")).alias("gain"))
        scores = scores.drop("score").join(gain, ["pattern", "as_kind"], "left").withColumn("score", (F.col("weight") + F.coalesce("gain", F.lit(0.0))) / (F.col("whole") + 1)).drop("gain")
        scores = materialize(scores, "patterns")
    return materialize(scores.where(F.col("score") >= threshold).select("pattern", F.col("as_kind").alias("kind"), "score"), "good")


def discover(scanned: DataFrame, rounds: int = 4, passes: int | None = None, min_seeds: int = 5, threshold: float = 0.8) -> DataFrame:
    """New identifiers of a scanned table: key, kind, start, end (distinct).

    Patterns are (left word, right word), (left word, any) and (any, right word). In each of the
    ``rounds`` of a pass a pattern's score for a kind is the weight of its instances times their scores
    over its whole weight plus one; an instance's score is the mean over its patterns with seeds by weight; seeds
    keep score 1 for their kind. Sightings are counted once per text, so copies of a document add nothing.
    A candidate is accepted if it stands anywhere in a pattern with a score of ``threshold`` and at least
    ``min_seeds`` different seeds of the kind; of several kinds the one with the surest pattern counts.
    Accepted ones are seeds of the next pass, until a pass accepts none (``passes`` ends it sooner); whatever was accepted is found wherever it
    stands, in strong patterns and outside of them.
    """
    sight = scanned.select("key", F.explode("sights").alias("s")).select("key", "s.*").distinct()
    sight = sight.withColumn("pattern", F.explode(F.array(F.struct("left", "right"), F.struct("left", F.lit(None).cast("string").alias("right")), F.struct(F.lit(None).cast("string").alias("left"), "right"))))
    sight = sight.where((F.coalesce(F.col("pattern.left"), F.lit("")) != "") | (F.coalesce(F.col("pattern.right"), F.lit("")) != ""))
    sight = materialize(sight.select("key", "kind", "instance", "start", "end", F.xxhash64("pattern.left", "pattern.right", F.col("pattern.left").isNull()).alias("pattern")), "sights")
    edges = materialize(sight.groupBy("pattern", "instance", "kind").agg(F.count("*").cast("double").alias("n")), "edges")
    accepted = scanned.sparkSession.createDataFrame([], NONE)
    for _ in itertools.count() if passes is None else range(passes):
        good = _good_patterns(_labelled(edges, accepted), rounds, min_seeds, threshold)
        hits = edges.where("kind = ''").select("pattern", "instance").join(if_few(good), "pattern")
        now = hits.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("top")).select("instance", F.col("top.kind").alias("kind"))
        now = materialize(accepted.union(now.join(accepted, "instance", "left_anti")), "accepted")
        grown = now.count() > accepted.count()
        accepted = now
        if not grown:
            break
    spots = scanned.select("key", F.explode(F.filter("sights", lambda s: s["kind"] == "")).alias("s")).select("key", "s.instance", "s.start", "s.end").distinct()
    return spots.join(if_few(accepted), "instance").select("key", "kind", "start", "end")


def _joined(spans):
    ranked = F.transform(spans, lambda s: F.struct(F.array_position(F.lit(list(KINDS)), s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(ranked), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda other: other == kind


def find_pii(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of docs (doc_id, text).

    The counts and base_sha256 are of base matches; spans also has those that contexts discovered.
    Null and empty texts have none; rows repeat as in the input and equal texts get equal spans;
    more columns are ignored; an empty table gives an empty table.
    """
    scanned = materialize(scan(docs), "scan")
    added = discover(scanned, **options).groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    rows = scanned.select("doc_id", "key", "base").join(materialize(added, "added"), "key", "left")
    every = F.concat("base", F.coalesce("more", F.array().cast(SPAN_SQL)))
    counts = [F.size(F.filter(F.col("base.kind"), _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"))


def _redact(place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, place):
            out = []
            for text, more in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if text:
                    spans = [(s, e, k) for k, s, e in base_spans(text)] + [(m["start"], m["end"], m["kind"]) for m in more or []]
                    pieces, at = [], 0
                    for s, e, kind in sorted(spans):
                        if s >= at:
                            pieces += [text[at:s], f"[{kind.upper()}]"]
                        at = max(at, e)
                    text = "".join([*pieces, text[at:]])
                out.append(text)
            columns = batch.columns[:-1]
            columns[place] = pa.array(out, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return run


def redact(docs: DataFrame, **options) -> DataFrame:
    """docs with every found span replaced by its kind in brackets ([EMAIL]); other columns and rows stay.

    Overlapping spans become the bracket of the first. Null texts stay null.
    """
    scanned = materialize(scan(docs), "scan")
    added = materialize(discover(scanned, **options).groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")), "added")
    rows = with_keyed(docs, text_key(F.col("text")), added, "left")
    return rows.mapInArrow(_redact(docs.columns.index("text")), docs.schema)
