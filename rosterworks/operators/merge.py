"""Keyed upserts as DataFrame plans: parquet tables know no MERGE, so a merge gives the new table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params

#: (old column, new column) -> merged column
Rule = Callable[[Column, Column], Column]

keep_old: Rule = lambda old, new: F.coalesce(old, new)
take_new: Rule = lambda old, new: F.coalesce(new, old)
overwrite: Rule = lambda old, new: new
leave: Rule = lambda old, new: old
higher: Rule = lambda old, new: F.greatest(old, new)
lower: Rule = lambda old, new: F.least(old, new)
either: Rule = lambda old, new: F.coalesce(old, F.lit(False)) | F.coalesce(new, F.lit(False))

#: Sources found on websites stay; ``REFERENCE_SOURCE`` lets the batch overwrite them.
keep_web: Rule = lambda old, new: F.when(old.isin(*params.WEB_SOURCES), old).otherwise(F.coalesce(new, old))
REFERENCE_SOURCE = {"source_type": overwrite, "source_table": overwrite}

ACCOUNT_RULES = {"email_domain": keep_old, "account_type": keep_old, "account_status": take_new, "confidence_score": higher, "source_type": keep_web, "source_table": keep_old, "is_personal_domain": either, "first_seen_at": lower, "last_seen_at": higher, "updated_at": overwrite}
CONTACT_RULES = {
    **{c: keep_old for c in ("source_contact_id", "full_name", "first_name", "last_name", "email_domain", "domain_type")},
    "is_personal_email": either, "contact_status": take_new, "confidence_score": higher, "source_type": keep_web, "source_table": keep_old, "first_seen_at": lower, "last_seen_at": higher, "updated_at": overwrite,
}
RELATIONSHIP_RULES = {"relationship_status": take_new, "confidence_score": higher, "last_seen_at": higher, "updated_at": overwrite}
SYNC_RULES = {"sync_status": overwrite, "last_synced_at": overwrite, "updated_at": overwrite}


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], rules: Mapping[str, Rule], tag: str | None = None) -> DataFrame:
    """target with source merged in on keys: one shuffle of each side, one full outer join.

    Matched rows follow ``rules``; columns without a rule keep the target's value. Rows of source
    alone are inserted as they are, with nulls for columns that only target has; with ``tag``, a
    column of that name says "insert", "update" or "keep". Source keys must be unique.
    """
    t = target.select(F.struct(*target.columns).alias("t"), *[F.col(k).alias(f"_{k}") for k in keys])
    s = source.select(F.struct(*source.columns).alias("s"), *[F.col(k).alias(f"_{k}") for k in keys])
    both = t.join(s, [f"_{k}" for k in keys], "full_outer")
    matched, new = F.col("t").isNotNull() & F.col("s").isNotNull(), F.col("t").isNull()

    def column(name: str) -> Column:
        if name in keys:
            return F.col(f"_{name}").alias(name)
        kind = target.schema[name].dataType
        old = F.col(f"t.{name}")
        fresh = F.col(f"s.{name}").cast(kind) if name in source.columns else F.lit(None).cast(kind)
        merged = rules[name](old, fresh) if name in rules else old
        return F.when(new, fresh).when(matched, merged).otherwise(old).alias(name)

    out = [column(c) for c in target.columns]
    if tag:
        out.append(F.when(new, "insert").when(matched, "update").otherwise("keep").alias(tag))
    return both.select(*out)


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a merge would insert, update and leave."""
    t = target.select(*keys, F.lit(True).alias("old"))
    s = source.select(*keys, F.lit(True).alias("new"))
    return t.join(s, list(keys), "full_outer").agg(
        F.count_if(F.col("old").isNull()).alias("inserted"), F.count_if(F.col("old").isNotNull() & F.col("new").isNotNull()).alias("updated"), F.count_if(F.col("new").isNull()).alias("untouched")
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """target and the rows of source whose keys it does not have."""
    return target.unionByName(source.join(target, list(keys), "left_anti"), allowMissingColumns=True)


def apply_updates(target: DataFrame, updates: DataFrame, key: str, rules: Mapping[str, Rule]) -> DataFrame:
    """target with the columns of ``rules`` changed for the keys that updates has: one left join for any number of rows."""
    fresh = updates.select(F.col(key), F.struct(*[c for c in updates.columns if c != key]).alias("_new"))
    joined = target.join(fresh, key, "left")
    changed = {c: F.when(F.col("_new").isNotNull(), rule(F.col(c), F.col(f"_new.{c}"))).otherwise(F.col(c)) for c, rule in rules.items()}
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in target.columns])


def merge_web_contacts(target: DataFrame, candidates: DataFrame, as_of: Column, sticky: Sequence[str] = ("suppressed", "invalid")) -> DataFrame:
    """Merge contacts found on pages: names and roles are replaced when at least as certain.

    Candidates (contact_id, full_name, first_name, last_name, email, role_type, role_family, role_title,
    source_url, confidence_score, seq) are first reduced to one per contact, the most certain, the
    latest of equals. A contact that is suppressed or invalid stays so.
    """
    best = candidates.groupBy("contact_id").agg(F.max_by(F.struct(*[c for c in candidates.columns if c not in ("contact_id", "seq")]), F.struct("confidence_score", "seq")).alias("b")).select("contact_id", "b.*")
    sure = F.col("n.confidence_score") >= F.coalesce(F.col("t.confidence_score"), F.lit(0.0))
    both = target.select("contact_id", F.struct(*target.columns).alias("t")).join(best.select("contact_id", F.struct(*best.columns).alias("n")), "contact_id", "full_outer")
    hit = F.col("n").isNotNull()

    def column(name: str) -> Column:
        old, kind = F.col(f"t.{name}"), target.schema[name].dataType
        new = F.col(f"n.{name}").cast(kind) if name in best.columns else F.lit(None).cast(kind)
        if name == "contact_id":
            return F.col("contact_id")
        if name == "contact_status":
            return F.when(hit & ~F.coalesce(F.lower(old).isin(*sticky), F.lit(False)), "active").otherwise(old).alias(name)
        if name in ("full_name", "first_name", "last_name", "role_type", "role_family", "role_title", "source_url"):
            return F.when(hit & sure, F.coalesce(new, old)).otherwise(F.coalesce(old, new)).alias(name)
        if name == "confidence_score":
            return F.greatest(old, new).alias(name)
        if name in ("last_seen_at", "updated_at"):
            return F.when(hit, as_of.cast(kind)).otherwise(old).alias(name)
        if name in ("first_seen_at", "created_at"):
            return F.coalesce(old, as_of.cast(kind)).alias(name)
        if name == "source_type":
            return F.when(hit, "website_contact_extraction").otherwise(old).alias(name)
        return F.coalesce(old, new).alias(name)

    return both.select(*[column(c) for c in target.columns])
