"""Exact Jaccard join of word-shingle sets that skips by set relations.

Stages, each a Spark job over the whole table:

1. *Profile*: every text gets its set size and a 64-bit identity of its set. Documents with equal
   sets form one class, so copies are never compared with each other.
2. *Support*: a set with a partner can miss at most a fifth of its shingles there, so of those whose
   hash lies in a fixed third of all hashes it has at most as many that no other class has. A second
   pass over the texts (cheaper than keeping a third of all shingles) and an aggregate by shingle, combined before the
   shuffle however common a shingle is, finds those and drops sets with too many of them.
3. *Index lists*: the sets left are ordered rarest shingle first and only their prefixes enter the
   lists. Lists are cut into blocks by position; a pair of blocks whose best positional bound is
   too small is skipped whole.
4. *Answers from similar sets*: every set belongs to a home block, a piece of bounded size of its
   longest list. In a home block one set's overlaps with all others are counted from the lists; a
   similar set's follow from them by the lists of the few shingles in which the two differ. Every
   list also has a leader, to which its other sets are compared. A set that is linked to another
   takes over the answers found for it, so only pairs of different components and home blocks are
   left, each looked at in the first list that both sets are in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_int64, batch_shingles, free_name, if_few, materialize, mix, parts, text_key, with_keyed, without_keys
from .graph import components

BITMAP_BITS = 24
BLOCK = 8
#: A home block has so many sets, and so many shingles, at most in expectation; its task holds some 50 bytes for each shingle.
HOME, HOME_SHINGLES = 2_000, 1_000_000
#: Rows of the Arrow batches in which texts and sets reach Python.
BATCH = 1_000
#: A longer list is dealt over several tasks; until its length is known, any list over this many.
SPLIT = 500
SALTS = 32
#: Hashes below this bound are the third that the support is counted on.
SAMPLED = np.uint64((1 << 64) // 3)


def set_identity(hashes: np.ndarray) -> int:
    """64 bits that stand for a set; equal sets, equal identity (two of 10**9 sets meet by chance with p = 0.03)."""
    if not len(hashes):
        return 0
    value = mix(np.array([hashes.sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64))
    return int(as_int64(value)[0])


def _profile(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1, 1 << 21):
            sets = [(set_identity(x), len(x)) for x in batch_shingles(batch.column(1), size)]
            columns = [pa.array([x[k] for x in sets], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["doc_id", "key", "set_id", "n_shingles"])

    return run


def _sampled(size: int):
    """(token, set_id) for the shingles of each text that lie in the sampled third."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 0, 1 << 21):
            tokens, keys = [], []
            for hashes in batch_shingles(batch.column(0), size):
                own = hashes[: np.searchsorted(hashes, SAMPLED)]
                tokens.append(own)
                keys.append(np.full(len(own), set_identity(hashes), np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(as_int64(np.concatenate(tokens))), pa.array(np.concatenate(keys))], ["token", "set_id"])

    return run


def _sets(size: int, bitmap):
    """The sets of texts whose mark may be in the bitmap; no other text is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint64)
        for batch in batches:
            for part in parts(iter([_marked(batch, 2, bits)]), 1, 1 << 21):
                ids, keys, sets = part.column(0).to_pylist(), [], []
                for hashes in batch_shingles(part.column(1), size):
                    keys.append(set_identity(hashes))
                    sets.append(hashes.tobytes())
                rows = [x for x in zip(ids, keys, sets, strict=True) if x[2]]
                columns = [[x[k] for x in rows] for k in range(3)]
                kinds = (part.schema.field(0).type, pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["doc_id", "set_id", "hashes"])

    return run


def bitmap_of(keys: DataFrame, column: str) -> bytes:
    """A bitmap of 2**24 bits (2 MB, whatever the table) in which the low bits of the keys are set."""
    words = (
        keys.select((F.col(column).bitwiseAND((1 << BITMAP_BITS) - 1)).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    )
    out = np.zeros((1 << BITMAP_BITS) // 64, np.int64)
    for word, bits in words.toLocalIterator():
        out[word] = bits
    return out.tobytes()


def _marked(batch: pa.RecordBatch, column: int, bits: np.ndarray) -> pa.RecordBatch:
    """The rows whose key may be in a bitmap."""
    place = batch.column(column).to_numpy() & ((1 << BITMAP_BITS) - 1)
    marked = bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)
    return batch.filter(pa.array(marked.astype(bool)))


def _among(bitmap):
    """The rows whose first column may be in a bitmap: a cheap step before a join on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint64)
        for batch in batches:
            yield _marked(batch, 0, bits)

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 1, 1 << 21):
        sets = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
        ids = np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets) if sets else ids), pa.array(ids)], ["token", "set_id"])


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 2, 1 << 22):
        x, y = (batch.column(k).to_pylist() for k in (2, 3))
        got = [len(np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True)) for p, q in zip(x, y, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.int64()), pa.array([(len(p) + len(q)) // 8 for p, q in zip(x, y, strict=True)], pa.int64())], ["a", "b", "common", "both"])


def home_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each of several sets the number of the first set of its component among them.

    Overlaps of a set with all others are counted from the lists of its tokens, or, if it differs in
    fewer tokens from a set whose overlaps are known, derived from those: minus the lists of the
    tokens that only the known set has, plus the lists of those that only this one has.
    """
    size = np.array([len(x) for x in sets])
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    who = np.repeat(np.arange(len(sets), dtype=np.int32), size)[np.argsort(token, kind="stable")]
    length = np.bincount(token)
    start = np.concatenate(([0], np.cumsum(length)))
    own = [x[length[x] > 1] for x in np.split(token, np.cumsum(size)[:-1])]
    shared = np.array([len(x) for x in own])
    root, known = np.arange(len(sets)), {}
    model, apart = np.full(len(sets), -1), shared.copy()

    def counted(tokens: np.ndarray) -> np.ndarray | int:
        lists = [who[start[t] : start[t + 1]] for t in tokens.tolist()]
        return np.bincount(np.concatenate(lists), minlength=len(sets)) if lists else 0

    for k in range(len(sets)):
        if not shared[k]:
            continue
        if (like := int(model[k])) >= 0:
            common = known[like] - counted(np.setdiff1d(own[like], own[k], True)) + counted(np.setdiff1d(own[k], own[like], True))
        else:
            common = counted(own[k])
        differ = shared + shared[k] - 2 * common
        closer = differ < apart
        closer[: k + 1] = False
        if closer.any():
            known[k] = common.astype(np.int32)
            model[closer], apart[closer] = k, differ[closer]
        linked = np.flatnonzero((common * 100 >= percent * (size + size[k] - common)) & (common > 0))
        roots = np.unique(root[linked])
        if len(roots) > 1:
            root[np.isin(root, roots)] = roots[0]
    return root


def _home_links(percent: int):
    """Links that connect what is linked within a home block; rows of a block lie next to each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, sets = None, [], []
        for batch in parts(batches, 2, 1 << 22):
            found = []
            for home, set_id, hashes in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if home != here:
                    found += _connected(ids, sets, percent)
                    here, ids, sets = home, [], []
                ids.append(set_id)
                sets.append(np.frombuffer(hashes, np.uint64))
            yield _pairs(found)
        yield _pairs(_connected(ids, sets, percent))

    return run


def _connected(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    if len(ids) < 2:
        return []
    return [(ids[r], ids[k]) for k, r in enumerate(home_links(sets, percent).tolist()) if r != k]


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def sets_among(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """The sets whose set_id may be among the keys (set_id): what is worth a shuffle before a join with them."""
    bitmap = sets.sparkSession.sparkContext.broadcast(bitmap_of(keys, "set_id"))
    return sets.select("set_id", "hashes").mapInArrow(_among(bitmap), "set_id long, hashes binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    pairs = materialize(pairs, "pairs")
    sets = sets_among(sets, pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")))
    left = sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("y"))
    found = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_overlap, "a long, b long, common long, both long")
    return found.where(F.col("common") * 100 >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def _pieces(length: Column) -> Column:
    """Into how many pieces a list of that length is dealt."""
    return F.ceil(length / SPLIT).cast("int")


def _dealt(lists: DataFrame) -> DataFrame:
    """A row of lists (token, length, ...) for every piece of its list."""
    return lists.withColumn("piece", F.explode(F.sequence(F.lit(0), _pieces(F.col("length")) - 1)))


def _possible(percent: int, n: Column, rest: Column, m: Column, last: Column) -> Column:
    """Whether sets of n and m shingles that meet first with rest and last shingles still to come can be linked."""
    return (F.least(n, m) * 100 >= percent * F.greatest(n, m)) & (F.least(rest, last) * (100 + percent) >= percent * (n + m))


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Components of the documents under "Jaccard of word shingles is at least percent / 100".

    ``docs`` has doc_id and text; more columns are ignored. Returns a row for every row of docs:
    doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Null, empty and blank texts have no shingles and link with nothing, not even each other; fewer
    than ``size`` words make one shingle. Rows with equal sets share a component; repeated rows are
    kept, each with the same component. A row with null doc_id links as others do and never names a
    component unless all its members are null. An empty table gives an empty table.
    """
    return rows_with_components(docs, size, percent).drop("key")


def rows_with_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, key (of the text), n_shingles, component_id: what :func:`jaccard_components` says of every row."""
    text = docs.select("doc_id", "text")
    id_type = text.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    profile = materialize(keyed.mapInArrow(_profile(size), f"doc_id {id_type}, key long, set_id long, n_shingles long"), "profile", BATCH)
    classes = profile.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    holders = docs.select("text").mapInArrow(_sampled(size), "token long, set_id long").groupBy("token").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"))
    alone = holders.where("low = high").groupBy(F.col("low").alias("set_id")).agg(F.count("*").alias("alone"))
    kept = classes.join(alone, "set_id", "left").where(F.coalesce("alone", F.lit(0)) * 100 <= F.col("n") * (100 - percent))
    kept = materialize(kept.select("set_id", "doc_id", "n"), "kept", BATCH)

    mark = F.xxhash64("doc_id").alias("mark")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(kept.select(mark), "mark"))
    found = text.select("doc_id", "text", mark).mapInArrow(_sets(size, bitmap), f"doc_id {id_type}, set_id long, hashes binary")
    own = kept.select("set_id", F.col("doc_id").alias("own"), "n")
    sets = found.join(own, (found.set_id == own.set_id) & found.doc_id.eqNullSafe(own.own)).select(found.set_id, "n", "hashes")
    if not profile.groupBy("set_id", "doc_id").count().where("count > 1").isEmpty():
        sets = sets.dropDuplicates(["set_id"])
    sets = materialize(sets, "sets", BATCH)

    postings = sets.select("set_id", "hashes").mapInArrow(_postings, "token long, set_id long")
    counts = materialize(postings.groupBy("token").agg(F.count("*").alias("df"), F.min("set_id").alias("only")), "counts", BATCH)
    private = counts.where("df = 1").groupBy(F.col("only").alias("set_id")).agg(F.count("*").alias("private"))
    misses = F.floor(F.col("n") * (100 - percent) / 100)
    open_sets = kept.select("set_id", "n").join(private, "set_id", "left").withColumn("private", F.coalesce("private", F.lit(0))).where(F.col("private") <= misses)
    open_sets = materialize(open_sets, "open")
    postings = sets_among(sets, open_sets).mapInArrow(_postings, "token long, set_id long")
    ranked = postings.join(counts.where("df > 1").select("token", "df"), "token").groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    prefix = (misses + 1 - F.col("private")).cast("int")
    heads = open_sets.join(ranked, "set_id").select("set_id", "n", "private", F.slice("tokens.token", 1, prefix).alias("head"))
    heads = materialize(heads, "heads", BATCH)
    entries = heads.select("set_id", "n", "private", F.posexplode("head").alias("pos", "token")).select("token", "set_id", "n", (F.col("n") - F.col("private") - F.col("pos")).alias("rest"))
    entries = materialize(entries.withColumn("salt", F.pmod(F.xxhash64("set_id"), F.lit(SALTS))), "entries")
    counted = entries.groupBy("token", "salt").agg(F.count("*").alias("length"), F.min("set_id").alias("lead_id"), F.min_by("n", "set_id").alias("lead_n"), F.min_by("rest", "set_id").alias("lead_rest"))
    lengths = counted.groupBy("token").agg(F.sum("length").alias("length"), F.min("lead_id").alias("lead_id"), F.min_by("lead_n", "lead_id").alias("lead_n"), F.min_by("lead_rest", "lead_id").alias("lead_rest")).where("length > 1")
    entries = entries.join(counted.select("token", "salt").join(lengths, "token"), ["token", "salt"]).drop("salt")
    entries = materialize(entries.withColumn("piece", F.pmod(F.xxhash64("set_id"), _pieces(F.col("length"))).cast("int")), "lists")
    home = materialize(entries.groupBy("set_id").agg(F.max(F.struct("length", "token")).alias("home"), F.first("n").alias("n")).select("set_id", "home.*", "n"), "home")
    weight = home.groupBy("token").agg(F.sum("n").alias("weight"))
    blocks = F.greatest(F.ceil(F.col("length") / HOME), F.ceil(F.col("weight") / HOME_SHINGLES))
    home = materialize(home.join(weight, "token").select("set_id", F.xxhash64("token", F.pmod(F.xxhash64("set_id"), blocks)).alias("home")), "homes")

    at_home = home.join(sets_among(sets, home), "set_id").select("home", "set_id", "hashes").repartition("home").sortWithinPartitions("home").mapInArrow(_home_links(percent), "a long, b long")
    at_home = materialize(at_home, "at-home", BATCH)
    lead = home.select(F.col("set_id").alias("lead_id"), F.col("home").alias("lead_home"))
    led = (
        entries.where(F.col("set_id") != F.col("lead_id"))
        .where(_possible(percent, F.col("n"), F.col("rest"), F.col("lead_n"), F.col("lead_rest")))
        .select("lead_id", "set_id")
        .distinct()
        .join(home, "set_id")
        .join(lead, "lead_id")
        .where("home <> lead_home")
        .select(F.col("lead_id").alias("a"), F.col("set_id").alias("b"))
    )
    first = components(at_home.union(_verified(led, sets, percent)))

    labelled = entries.drop("lead_id", "lead_n", "lead_rest").join(home, "set_id").join(first.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    labelled = materialize(labelled.withColumn("block", F.floor(F.col("rest") / BLOCK)), "labelled")
    mixed = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("home").alias("here"), F.max("home").alias("there"), F.first("length").alias("length"))
    mixed = materialize(_dealt(mixed.where("low < high and here < there").select("token", "length")).drop("length"), "mixed")
    labelled = labelled.join(if_few(mixed), ["token", "piece"], "left_semi").join(heads.select("set_id", "private", "head"), "set_id")
    before = F.slice("head", F.lit(1), (F.col("n") - F.col("private") - F.col("rest")).cast("int"))
    labelled = materialize(labelled.withColumn("before", before).drop("head", "private"), "labelled")
    name = lambda df, tag: df.select(*[F.col(c).alias(f"{c}_{tag}") for c in df.columns])
    blocks = labelled.groupBy("token", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"))
    bound = (
        (F.col("token_x") == F.col("token_y"))
        & (F.least("most_x", "most_y") * 100 >= F.greatest("least_x", "least_y") * percent)
        & (F.least("rest_x", "rest_y") * (100 + percent) >= (F.col("least_x") + F.col("least_y")) * percent)
    )
    open_blocks = name(blocks, "x").join(name(blocks, "y"), bound).groupBy(F.col("token_x").alias("token"), F.col("block_x").alias("block")).agg(F.collect_set("block_y").alias("open"))
    sizes = labelled.groupBy("token", "label").agg(F.count("*").alias("size"), F.first("length").alias("length"))
    largest = _dealt(sizes.groupBy("token").agg(F.max_by("label", F.struct("size", "label")).alias("largest"), F.first("length").alias("length"))).drop("length")
    largest, open_blocks = materialize(largest, "largest"), materialize(open_blocks, "blocks")
    outside = labelled.join(if_few(largest), ["token", "piece"]).where("label <> largest").join(if_few(open_blocks), ["token", "block"]).drop("block", "piece")
    outside = _dealt(outside.withColumn("block", F.explode("open")).drop("open")).drop("length")
    rest = (
        name(outside, "x")
        .join(
            name(labelled.drop("length"), "y"),
            (F.col("token_x") == F.col("token_y"))
            & (F.col("block_x") == F.col("block_y"))
            & (F.col("piece_x") == F.col("piece_y"))
            & (F.col("label_x") != F.col("label_y"))
            & (F.col("home_x") != F.col("home_y"))
            & ((F.col("label_y") == F.col("largest_x")) | (F.col("set_id_x") < F.col("set_id_y")))
            & _possible(percent, F.col("n_x"), F.col("rest_x"), F.col("n_y"), F.col("rest_y"))
            & ~F.arrays_overlap("before_x", "before_y"),
        )
        .select(F.least("set_id_x", "set_id_y").alias("a"), F.greatest("set_id_x", "set_id_y").alias("b"))
        .distinct()
    )
    more = _verified(rest, sets, percent)
    label = first.select(F.col("node").alias("a"), F.col("label").alias("la"))
    other = first.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    more = more.join(label, "a", "left").join(other, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    second = components(more).select(F.col("node").alias("label"), F.col("label").alias("last"))

    final = (
        classes.join(first.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("label", F.coalesce("label", "set_id"))
        .join(second, "label", "left")
        .select("set_id", "doc_id", F.coalesce("last", "label").alias("label"))
    )
    lowest = final.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    answer = final.select("set_id", "label").join(lowest, "label").select("set_id", "component_id")
    rows = profile.join(answer, "set_id", "left")
    return rows.select("doc_id", "key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component: a row whose doc_id names it. Columns stay as they are.

    Of several such rows (a doc_id that repeats) one stays. Texts without shingles are components of
    their own, one for each doc_id. Rows with null doc_id name no component and all stay.
    """
    found = rows_with_components(docs, size, percent).where("doc_id IS NOT NULL").withColumn("row", F.xxhash64("doc_id", "key"))
    found = materialize(found, "found")
    first = found.where("component_id = doc_id").groupBy("doc_id", F.col("n_shingles") > 0).agg(F.min("key").alias("key"))
    stay = materialize(first.select(F.xxhash64("doc_id", "key").alias("row")), "stay")
    gone = found.join(stay, "row", "left_anti").select(F.col("row").alias("key")).distinct()
    row = F.xxhash64("doc_id", text_key(F.col("text")))
    left = without_keys(docs, row, materialize(gone, "gone"))
    again = found.join(stay, "row", "left_semi").groupBy(F.col("row").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key")
    again = materialize(again, "again")
    if again.isEmpty():
        return left
    name = free_name(docs, "_row")
    once = with_keyed(left, row, again, "left_semi").withColumn(name, row).dropDuplicates([name]).drop(name)
    return without_keys(left, row, again).unionByName(once)
