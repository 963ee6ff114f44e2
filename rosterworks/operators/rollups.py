"""Raw contact rows to one row per account, contact and relationship."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import filled, is_blank, norm_key, observed_at, stable_id

SOURCE_TYPE = "contact_master_normalization"
SOURCE_TABLE = "contact_master"


def normalized(raw: DataFrame, as_of: Column) -> DataFrame:
    """Keys in lower case and stripped, defaults for missing flags and scores, one time of observation."""
    return raw.select(
        "contact_id",
        norm_key(F.col("account_key")).alias("account_key"),
        norm_key(F.col("email")).alias("email"),
        norm_key(F.col("email_domain")).alias("email_domain"),
        "full_name",
        "first_name",
        "last_name",
        "domain_type",
        "contact_status",
        F.coalesce("is_personal_email", F.lit(False)).alias("is_personal"),
        F.coalesce("confidence_score", F.lit(0.0)).alias("confidence_score"),
        observed_at(F.col("last_seen_at"), F.col("created_at"), as_of).alias("observed_at"),
    )


def _common(as_of: Column) -> list[Column]:
    return [F.lit(SOURCE_TYPE).alias("source_type"), F.lit(SOURCE_TABLE).alias("source_table"), F.col("first_seen_at"), F.col("last_seen_at"), as_of.alias("created_at"), as_of.alias("updated_at")]



def account_rollup(rows: DataFrame, as_of: Column) -> DataFrame:
    """One row per account key of :func:`normalized` rows; rows without a key are dropped."""
    grouped = rows.where(~is_blank(F.col("account_key"))).groupBy("account_key").agg(
        F.min(filled(F.col("email_domain"))).alias("email_domain"),
        F.bool_or("is_personal").alias("is_personal_domain"),
        F.max("confidence_score").alias("confidence_score"),
        F.min("observed_at").alias("first_seen_at"),
        F.max("observed_at").alias("last_seen_at"),
    )
    none = lambda name: F.lit(None).cast("string").alias(name)
    return grouped.select(
        stable_id(F.col("account_key")).alias("account_id"),
        "account_key",
        "email_domain",
        none("account_name"),
        none("inferred_brand"),
        none("website_url"),
        F.when(F.col("is_personal_domain"), "personal_domain_seed").otherwise("domain_seed").alias("account_type"),
        F.lit("active").alias("account_status"),
        "confidence_score",
        "is_personal_domain",
        *_common(as_of),
    )


def contact_rollup(rows: DataFrame, as_of: Column) -> DataFrame:
    """One row per e-mail; each descriptive field is the first that is not null by time and contact id."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("observed_at", "contact_id"))).alias(c)
    grouped = rows.where(~is_blank(F.col("email"))).groupBy("email").agg(
        F.min_by("contact_id", F.struct("observed_at", "contact_id")).alias("source_contact_id"),
        *[first(c) for c in ("full_name", "first_name", "last_name", "email_domain", "domain_type", "contact_status")],
        F.bool_or("is_personal").alias("is_personal_email"),
        F.max("confidence_score").alias("confidence_score"),
        F.min("observed_at").alias("first_seen_at"),
        F.max("observed_at").alias("last_seen_at"),
    )
    return grouped.select(
        stable_id(F.col("email")).alias("contact_id"), "source_contact_id", "full_name", "first_name", "last_name", "email", "email_domain", "is_personal_email", "domain_type", "contact_status", "confidence_score", *_common(as_of)
    )


def relationship_rollup(rows: DataFrame, as_of: Column) -> DataFrame:
    """One row per account and e-mail."""
    both = rows.where(~is_blank(F.col("account_key")) & ~is_blank(F.col("email")))
    grouped = both.groupBy("account_key", "email").agg(F.max("confidence_score").alias("confidence_score"), F.min("observed_at").alias("first_seen_at"), F.max("observed_at").alias("last_seen_at"))
    return grouped.select(
        stable_id(F.col("account_key"), F.col("email")).alias("relationship_id"),
        stable_id(F.col("account_key")).alias("account_id"),
        stable_id(F.col("email")).alias("contact_id"),
        F.lit("domain_membership").alias("relationship_type"),
        F.lit(True).alias("is_primary"),
        F.lit("active").alias("relationship_status"),
        "confidence_score",
        *_common(as_of),
    )


def source_preview(raw: DataFrame) -> DataFrame:
    """Counts of rows and of distinct keys, as they are and normalised.

    Each key column is grouped once as it is, with its flags, and those groups once more by their normal form: partial aggregates
    before every shuffle, no row is multiplied, and no set of distinct values is held in one task.
    """

    def grouped(column: str, flag) -> DataFrame:
        as_is = raw.groupBy(column).agg(F.count("*").alias("n"), F.bool_or(flag).alias("flag"))
        return as_is.groupBy(filled(norm_key(F.col(column))).alias("key")).agg(F.count(column).alias("raw"), F.sum("n").alias("n"), F.bool_or("flag").alias("flag"))

    whole = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    accounts = grouped("account_key", F.lit(False)).agg(
        whole(F.sum("n"), "rows"), whole(F.sum("raw"), "raw_accounts"), F.count("key").alias("accounts"), whole(F.sum(F.when(F.col("key").isNull(), F.col("n"))), "rows_without_account")
    )
    emails = grouped("email", F.coalesce("is_personal_email", F.lit(False))).agg(whole(F.sum("raw"), "raw_emails"), F.count("key").alias("emails"), F.count(F.when(F.col("flag"), F.col("key"))).alias("personal_emails"))
    return accounts.crossJoin(emails).select("rows", "raw_accounts", "raw_emails", "accounts", "emails", "personal_emails", "rows_without_account")


def with_keys(df: DataFrame, keys: Sequence[str], column: str = "account_key") -> DataFrame:
    """The rows whose key is in an explicit list; the list's keys are trimmed and lower-cased first."""
    return df.where(F.col(column).isin(*{k.strip().lower() for k in keys}))
