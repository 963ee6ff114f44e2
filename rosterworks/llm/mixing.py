"""Mixing sources to target weights: hierarchical token budgets over domain, language and source.

The tree's leaves are (domain, language, source) groups of documents. A total budget of tokens goes
from the root down: siblings share their parent's budget by weight, none gets more than it can give
(its tokens times the allowed epochs), and what one cannot give goes to its siblings by weight. Only
what a whole family cannot give falls back to the parents' level, since a node's limit is the sum
of its leaves' limits. The share at which siblings fill up is found with one window: sorted by limit
over weight, a node is full iff filling up all before it and giving every other one the same share per
weight stays within the budget.

A leaf whose budget is e epochs and a rest takes all its documents e times, and for the rest a
prefix of the next epoch's order: documents in order of an md5 of (seed, epoch, doc_id, md5 of the text), the
last one cut. The prefix's end is found without sorting a leaf in one task: hash ranges are summed
first, and only the range in which the budget ends is ordered.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

LEVELS = ("domain", "lang", "source")
PER_RANGE = 4_096
BROADCAST_LEAVES = 100_000
NONE = "(none)"
ADDED = ("mix_domain", "mix_epoch", "mix_tokens", "mix_taken")


def tokens_of(text: Column) -> Column:
    """The number of runs of non-space characters; 0 for null."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(spaced, " \t\n\x0b\x0c\r", "")).cast("long")


def _number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of an md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def domain_of(source: Column, domains: int = 4) -> Column:
    """A stand-in for a table of domains: a hash of the source's name picks one of a few."""
    return F.concat(F.lit("domain"), (_number(source, 6) % domains).cast("string"))


def _weight(level: str, weights: dict[str, float]) -> Column:
    column = F.lit(1.0)
    for name, value in weights.items():
        column = F.when(F.col(level) == name, F.lit(float(value))).otherwise(column)
    return column


def shares(nodes: DataFrame, parents: list[str], weights: dict[str, float]) -> DataFrame:
    """Share out ``given`` (the parent's budget) among nodes with ``room``: adds ``budget``.

    Weights are by node name, 1 where absent; a weight of 0 gives nothing.
    """
    level = LEVELS[len(parents)]
    nodes = nodes.withColumn("w", _weight(level, weights)).withColumn("ratio", F.when(F.col("w") > 0, F.col("room") / F.col("w")))
    key = parents or [F.lit(1)]
    order = Window.partitionBy(*key).orderBy(F.col("ratio").asc_nulls_first(), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    family = Window.partitionBy(*key)
    nodes = nodes.withColumn("full_before", F.coalesce(F.sum(F.when(F.col("w") > 0, F.col("room"))).over(before), F.lit(0.0))).withColumn("open_weight", F.sum("w").over(family) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    full = (F.col("w") > 0) & (F.col("full_before") + F.col("ratio") * F.col("open_weight") <= F.col("given") * (1 + 1e-12))
    nodes = nodes.withColumn("full", full)
    rest = F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(family), F.lit(0.0))
    open_all = F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0.0)).over(family)
    budget = F.when(F.col("full"), F.col("room")).when(F.col("w") > 0, F.least(F.col("room"), rest * F.col("w") / open_all)).otherwise(0.0)
    return nodes.withColumn("budget", F.greatest(budget, F.lit(0.0))).drop("w", "ratio", "full_before", "open_weight", "full")


def leaf_budgets(leaves: DataFrame, total: float, weights: dict[str, dict[str, float]], max_epochs: float) -> DataFrame:
    """Budgets of leaves (domain, lang, source, docs, tokens): adds ``budget`` in tokens."""
    sized = leaves.withColumn("room", F.col("tokens") * F.lit(float(max_epochs)))
    given = None
    for depth in range(len(LEVELS)):
        path = list(LEVELS[: depth + 1])
        nodes = sized.groupBy(*path).agg(F.sum("room").alias("room"))
        nodes = nodes.withColumn("given", F.lit(float(total))) if depth == 0 else nodes.join(given, path[:-1])
        given = shares(nodes, path[:-1], weights.get(LEVELS[depth], {})).select(*path, F.col("budget").alias("given"))
    return leaves.join(given.withColumnRenamed("given", "budget"), list(LEVELS))


def _named(docs: DataFrame, domain: Column) -> DataFrame:
    """The columns of docs as c0, c1, ... and those that decide: _domain, _lang, _source, _tokens, _id."""
    filled = lambda c, name: F.coalesce(c.cast("string"), F.lit(NONE)).alias(name)
    own = [docs[c].alias(f"c{k}") for k, c in enumerate(docs.columns)]
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    identity = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).alias("_id")
    return docs.select(*own, filled(domain, "_domain"), filled(F.col("lang"), "_lang"), filled(F.col("source"), "_source"), tokens_of(F.col("text")).alias("_tokens"), identity)


def _place(seed: int, epoch: Column) -> Column:
    """Where a document stands in an epoch's order: 0 to 16**15 - 1."""
    return _number(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.col("_id")), 15)


def mix(
    docs: DataFrame,
    total_share: float = 0.6,
    weights: dict[str, dict[str, float]] | None = None,
    max_epochs: int = 2,
    seed: int = 1,
    domain: Column | None = None,
    cut_text: bool = True,
) -> DataFrame:
    """Select a mixture of ``total_share`` of all tokens of docs (doc_id, text, lang, source, ...).

    Returns a row for every document and epoch that is taken: all columns of docs, then mix_domain,
    mix_epoch (from 0), mix_tokens (of the document) and mix_taken (tokens taken, less than all for
    the document in which a leaf's budget ends; with ``cut_text`` its text is cut there).
    ``weights`` gives a weight for names of each level; names not listed weigh 1.

    Columns of docs that are named like the added ones are replaced by them. Null lang, source or domain form a group of their own. Documents without tokens (null, empty or
    blank text) cost nothing: they come with every whole epoch and with the prefix as far as it
    reaches. Rows that repeat doc_id and text share a place in the order and are taken or cut
    alike, so a leaf's last place can give up to one token less for each of them. An empty table gives an empty table.
    """
    columns = [c for c in docs.columns if c not in ADDED]
    named = _named(docs, domain_of(F.col("source")) if domain is None else domain)
    path = [F.col(f"_{c}").alias(c) for c in LEVELS]
    narrow = materialize(named.select(*path, "_tokens", "_id"), "tokens")
    leaves = materialize(narrow.groupBy(*LEVELS).agg(F.count("*").alias("docs"), F.sum("_tokens").alias("tokens")), "leaves")
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * total_share
    plan = leaf_budgets(leaves, total, weights or {}, max_epochs).withColumn("budget", F.floor("budget").cast("long"))
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("int"))
    plan = materialize(plan.withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("whole") * F.col("tokens")).otherwise(F.lit(0))).withColumn("ranges", F.ceil(F.col("docs") / PER_RANGE)), "budgets")
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_LEAVES else plan

    width = F.lit(float(16**15)) / F.col("ranges")
    placed = narrow.join(plan.where("rest > 0"), list(LEVELS)).withColumn("place", _place(seed, F.col("whole"))).withColumn("range", F.floor(F.col("place") / width))
    sums = placed.groupBy(*LEVELS, "range").agg(F.sum("_tokens").alias("sum"), F.first("rest").alias("rest"))
    over = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("sofar", F.coalesce(F.sum("sum").over(over), F.lit(0)))
    last = materialize(sums.where((F.col("sofar") < F.col("rest")) & (F.col("sofar") + F.col("sum") >= F.col("rest"))).select(*LEVELS, "range", "sofar"), "ranges")
    last = F.broadcast(last) if last.count() <= BROADCAST_LEAVES else last
    steps = placed.join(last, [*LEVELS, "range"]).groupBy(*LEVELS, "place").agg(F.sum("_tokens").alias("sum"), F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("sofar").alias("sofar"))
    run = Window.partitionBy(*LEVELS).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("sofar", F.col("sofar") + F.coalesce(F.sum("sum").over(run), F.lit(0)))
    ends = steps.where((F.col("sofar") < F.col("rest")) & (F.col("sofar") + F.col("sum") >= F.col("rest")))
    ends = ends.select(*LEVELS, F.col("place").alias("_end"), F.floor((F.col("rest") - F.col("sofar")) / F.col("n")).alias("_cut"))
    final = plan.join(ends, list(LEVELS), "left").select(*[F.col(c).alias(f"_{c}") for c in LEVELS], F.col("whole").alias("_whole"), "_end", "_cut")
    final = materialize(final.where("_whole > 0 OR _end IS NOT NULL"), "plan")
    final = F.broadcast(final) if final.count() <= BROADCAST_LEAVES else final

    rows = named.join(final, [f"_{c}" for c in LEVELS]).withColumn("_place", _place(seed, F.col("_whole")))
    extra = F.when(F.col("_place") <= F.col("_end"), 1).otherwise(0)
    epochs = F.when(F.col("_whole") + extra > 0, F.sequence(F.lit(0), F.col("_whole") + extra - 1))
    rows = rows.withColumn("_epoch", F.explode(epochs))
    ends_here = (F.col("_epoch") == F.col("_whole")) & (F.col("_place") == F.col("_end")) & (F.col("_cut") < F.col("_tokens"))
    taken = F.when(ends_here, F.col("_cut")).otherwise(F.col("_tokens"))
    own = {c: F.col(f"c{k}") for k, c in enumerate(docs.columns)}
    if cut_text:
        parts = F.slice(F.regexp_extract_all(own["text"], F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1), 1, F.greatest(F.lit(0), F.col("_cut")).cast("int"))
        own["text"] = F.when(ends_here, F.array_join(parts, "")).otherwise(own["text"])
    kept = [own[c].alias(c) for c in columns]
    return rows.select(*kept, F.col("_domain").alias("mix_domain"), F.col("_epoch").alias("mix_epoch"), F.col("_tokens").alias("mix_tokens"), taken.cast("long").alias("mix_taken")).where((F.col("mix_taken") > 0) | (F.col("mix_tokens") == 0))
