"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, and the posterior decides.

Everything is DataFrame functions. What the rules look at is measured within each row: repeated windows are found by sorting
hashes that carry their position, so no text leaves its row. Rows with equal votes are counted together, at
most 3 ** len(RULES) of them however many documents there are, and the rounds run over those counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Blanks that part words.
BLANK = r"[\x20\x09-\x0D]+"
_TRIM = " \t\n\x0b\f\r"
#: Each rule by its name: when it votes against a text, when it votes for it; else it abstains. Whole numbers only.
RULES = {
    "length": ("n_words < 60", "n_words BETWEEN 100 AND 100000"),
    "word_length": ("10 * word_chars NOT BETWEEN 30 * n_words AND 75 * n_words", "n_words > 0 AND 10 * word_chars BETWEEN 35 * n_words AND 62 * n_words"),
    "symbols": ("100 * n_symbols > 10 * n_words", "n_words > 0 AND 100 * n_symbols <= n_words"),
    "marks": ("100 * n_marks > 10 * word_chars", "n_words > 0 AND 100 * n_marks <= 6 * word_chars"),
    "repeated_lines": ("10 * n_dup_lines > 3 * n_lines", "n_lines > 0 AND 20 * n_dup_lines <= n_lines"),
    "repeated_words": ("100 * n_repeat_words > 25 * n_words", "n_words > 0 AND 100 * n_repeat_words <= 5 * n_words"),
    "variety": ("n_words BETWEEN 50 AND 2000 AND 100 * n_distinct < 35 * n_words", "n_words >= 50 AND 100 * n_distinct >= 55 * n_words"),
    "line_ends": ("100 * n_ended < 50 * n_lines", "n_lines > 0 AND 100 * n_ended >= 90 * n_lines"),
    "capitals": ("100 * n_capitals > 25 * word_chars", "n_words > 0 AND 100 * n_capitals <= 8 * word_chars"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_marks", "n_distinct", "n_capitals")
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
#: Where the rounds begin: good texts seldom break a rule, bad ones break only some. How many rounds there are, and how many
#: texts at these values every estimate counts beforehand.
PRIOR, GOOD, BAD, ROUNDS, BEFORE = 0.7, 0.97, 0.4, 20, 10


def let(value: Column, body) -> Column:
    """The body's value for a value that is worked out once: inside it stands for a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(hashes: Column) -> Column:
    """How many words lie in windows of three words that come twice or more, from an array of a text's word hashes.

    Windows are compared as 64-bit hashes whose low bits, as many as the text's length needs, give way to the window's
    position: after one sort of numbers equal windows are neighbours.
    """
    one = F.lit(1).cast("long")

    def covered(h: Column) -> Column:
        return let(F.pow(F.lit(2.0), F.ceil(F.log2(F.size(h)))).cast("long") - one, lambda mask: let(F.bitwise_not(mask), lambda high: windows(h, mask, high)))

    def windows(h: Column, mask: Column, high: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long")))
        same = lambda x, y: x.bitwiseXOR(y).bitwiseAND(high) == 0
        equal = lambda s: F.filter(s, lambda x, i: F.coalesce(same(x, F.get(s, i + 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, i - 1)), F.lit(False)))
        positions = lambda s: F.sort_array(F.transform(equal(s), lambda x: x.bitwiseAND(mask)))
        return let(F.sort_array(F.slice(placed, F.lit(1), F.size(h) - 2)), lambda s: let(positions(s), steps))

    def steps(at: Column) -> Column:
        wide = F.transform(at, lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, i + 1) - x, F.lit(3).cast("long"))))
        return F.aggregate(wide, F.lit(0).cast("long"), lambda total, x: total + x)

    return F.when(F.size(hashes) < 4, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and MEASURES of each row of docs (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = F.btrim(text, F.lit(_TRIM))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_TRIM)) != "")
    counted = lambda c: c.cast("long")
    ended = lambda x: F.rtrim(x, F.lit(_TRIM)).rlike(r"[.!?\x22]\z")
    marks = F.regexp_replace("text", r"[\p{L}\p{N}\x20\x09-\x0D]+", "")
    rows = docs.select("doc_id", text.alias("text"), words.alias("words"), lines.alias("lines"))
    rows = rows.select("doc_id", "text", "words", "lines", marks.alias("marks"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    return rows.select(
        "doc_id",
        counted(F.size("words")).alias("n_words"),
        counted(F.length(F.array_join("words", ""))).alias("word_chars"),
        counted(F.length(F.regexp_replace("marks", r"[^#*$%&|<>]+", ""))).alias("n_symbols"),
        counted(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        repeat_words(F.col("hashes")).alias("n_repeat_words"),
        counted(F.size("lines")).alias("n_lines"),
        counted(F.size(F.filter("lines", ended))).alias("n_ended"),
        counted(F.length("marks")).alias("n_marks"),
        counted(F.size(F.array_distinct("hashes"))).alias("n_distinct"),
        counted(F.length(F.regexp_replace("text", "[^A-Z]+", ""))).alias("n_capitals"),
    )


def votes(measured: DataFrame) -> DataFrame:
    """Adds the array votes, one for each rule: 1 for the text, -1 against it, 0 for no vote."""
    return measured.withColumn("votes", F.array(*[F.when(F.expr(against), -1).when(F.expr(for_it), 1).otherwise(0) for against, for_it in RULES.values()]))


def posterior(model: dict) -> Column:
    """The probability of quality given a row's votes.

    The model enters as one array, so that every round of :func:`fit` runs the same compiled plan.
    """
    weights = [math.log(model["prior"] / (1 - model["prior"]))]
    for name in RULES:
        good, bad = model["good"][name], model["bad"][name]
        weights += [math.log((1 - good) / bad), 0.0, math.log(good / (1 - bad))]
    table = F.array(*map(F.lit, weights))
    odds = F.aggregate(F.transform("votes", lambda v, i: F.get(table, 3 * i + v + 2)), F.get(table, F.lit(0)), lambda total, x: total + x)
    return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """Prior and accuracies of the rules from counted votes (votes, n).

    "good" is the share of votes for texts of quality among a rule's votes on them, "bad" that of votes against the others.
    Estimates count ``BEFORE`` texts at their first values beforehand, and no rule may speak for the
    opposite of its vote (good + bad >= 1); a table without rows keeps the first values.
    """
    model = {"prior": PRIOR, "good": dict.fromkeys(RULES, GOOD), "bad": dict.fromkeys(RULES, BAD)}
    share = lambda yes, no, first: (yes + BEFORE * first) / (yes + no + BEFORE)
    for _ in range(rounds):
        weighed = patterns.select(F.posexplode("votes").alias("rule", "vote"), "n", (F.col("n") * posterior(model)).alias("good"))
        sums = {(r.rule, r.vote): (r.good, r.n - r.good) for r in weighed.groupBy("rule", "vote").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).collect()}
        at = lambda k, vote, side: sums.get((k, vote), (0.0, 0.0))[side]  # noqa: B023, E731
        bad = {name: share(at(k, -1, 1), at(k, 1, 1), BAD) for k, name in enumerate(RULES)}
        good = {name: max(1 - bad[name], share(at(k, 1, 0), at(k, -1, 0), GOOD)) for k, name in enumerate(RULES)}
        model = {"prior": share(*(sum(at(0, v, side) for v in (-1, 0, 1)) for side in (0, 1)), PRIOR), "good": good, "bad": bad}
    return model


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, MEASURES, base_failed, quality (the posterior), kept: a row for each row of docs (doc_id, text).

    A text is kept if it does not fail the base rules and its posterior is at least ``least``. Null and empty texts have no
    words and fail; rows that repeat are judged alike and each counts; rows without doc_id are judged as well. More columns
    are ignored; an empty table gives an empty table.
    """
    measured = materialize(measures(docs), "measures")
    voted = votes(measured)
    model = fit(materialize(voted.groupBy("votes").agg(F.count("*").alias("n")).coalesce(1), "votes"))
    judged = voted.withColumn("quality", F.round(posterior(model), 6)).withColumn("base_failed", F.expr(BASE_FAILED))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)).select("doc_id", *MEASURES, "base_failed", "quality", "kept")
