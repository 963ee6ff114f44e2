"""People with e-mail and role from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import PLAIN_NAME, any_of, contact_score, email_domain, host_of, person_near, role_of, same_site_domain, split_name, stable_id
from .pages import with_contexts


def page_candidates(features: DataFrame, accounts: DataFrame, name_pattern: str = PLAIN_NAME) -> DataFrame:
    """Contact candidates of pages (account_key, page_ord, url, email_contexts) of accounts (account_key, website_url).

    Contexts are texts, or spans of the column text as parsed pages have them. An address counts if its domain belongs
    to the account's key, website or page: others are dropped before any context is cut. A candidate needs
    a role and a name near the address; ``name_pattern`` says what a name looks like.
    """
    spans = "start" in features.schema["email_contexts"].dataType.elementType.names
    # As many accounts as pages would be broadcast where Spark's estimate is that of a narrow table.
    known = features.select("account_key", "page_ord", "url", "email_contexts", *(["text"] if spans else [])).join(accounts.select("account_key", "website_url").hint("merge"), "account_key")
    hosts = {f"_host{k}": host_of(F.col(c)) for k, c in enumerate(("account_key", "website_url", "url"))}

    def own(mail: Column) -> Column:
        domain = email_domain(mail["email"])
        return any_of([F.coalesce((F.length(F.col(h)) > 0) & same_site_domain(domain, F.col(h)), F.lit(False)) for h in hosts])

    mails = F.filter("email_contexts", own)
    seen = known.withColumns(hosts).select("account_key", "page_ord", "url", F.explode(with_contexts(mails, F.col("text")) if spans else mails).alias("c"))
    known = seen.select("account_key", "page_ord", "url", F.col("c.pos").alias("ctx_ord"), F.col("c.email").alias("email"), F.col("c.context").alias("context"))
    domain = email_domain(F.col("email"))
    once = lambda c: F.explode(F.array_compact(F.array(c)))  # noqa: E731  (drops nulls; an exploded value is not computed again)
    named = known.withColumn("role", once(role_of(F.col("context"))))
    named = named.withColumn("full_name", once(person_near(F.col("context"), F.col("email"), F.col("role.role_title"), name_pattern)))
    first, last = split_name(F.col("full_name"))
    score = contact_score(F.col("email"), F.col("full_name"), F.col("role.role_title"), F.col("url"))
    return named.select(
        "account_key", "page_ord", "ctx_ord", "full_name", first.alias("first_name"), last.alias("last_name"), "email", domain.alias("email_domain"), "role.*", F.col("url").alias("source_url"), score.alias("confidence_score")
    )


def best_candidates(candidates: DataFrame) -> DataFrame:
    """The surest candidate per account and address, the first of equals."""
    order = Window.partitionBy("account_key", "email").orderBy(F.col("confidence_score").desc(), "page_ord", "ctx_ord")
    return candidates.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def as_contacts(candidates: DataFrame) -> DataFrame:
    """Candidates with the id that merges know them by."""
    return candidates.withColumns({"contact_id": stable_id(F.col("email")), "seq": F.struct("account_key", "page_ord", "ctx_ord")})


def as_relationships(candidates: DataFrame, as_of: Column) -> DataFrame:
    """Relationship rows of candidates, one per account and address."""
    grouped = candidates.groupBy("account_key", "email").agg(F.max("confidence_score").alias("confidence_score"), F.max_by("source_url", "confidence_score").alias("source_url"))
    key, email = F.col("account_key"), F.col("email")
    return grouped.select(
        stable_id(key, email).alias("relationship_id"), stable_id(key).alias("account_id"), stable_id(email).alias("contact_id"), F.lit("website_contact").alias("relationship_type"), F.lit(False).alias("is_primary"),
        F.lit("active").alias("relationship_status"), "confidence_score", F.lit("website_contact_extraction").alias("source_type"), F.lit("pages").alias("source_table"), "source_url",
        as_of.alias("first_seen_at"), as_of.alias("last_seen_at"), as_of.alias("created_at"), as_of.alias("updated_at"),
    )
