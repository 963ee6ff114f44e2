"""Queries over raw contacts: keys, ids, rollups and merges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import merge as M
from ..operators import rollups as R
from ..sources import store
from ..sources.schemas import SCHEMAS, conform
from ..sources.views import view
from ..streaming.incremental import current, merge_batch
from .base import NOW, now, query

ROWS = f"""SELECT contact_id, lower(trim(account_key)) AS account_key, lower(trim(email)) AS email, lower(trim(email_domain)) AS email_domain,
 full_name, first_name, last_name, domain_type, contact_status, coalesce(is_personal_email, false) AS is_personal,
 coalesce(confidence_score, 0.0) AS confidence_score, coalesce(last_seen_at, created_at, {NOW}) AS observed_at FROM contact_master_v"""
TAIL = f"'contact_master_normalization' AS source_type, 'contact_master' AS source_table, min(observed_at) AS first_seen_at, max(observed_at) AS last_seen_at, {NOW} AS created_at, {NOW} AS updated_at"


#: Two batches that overlap and together hold every row.
EARLY, LATE = "day(observed_at) <= 20", "day(observed_at) >= 10"


def accounts_sql(where: str = "true") -> str:
    return f"""SELECT sha256(account_key) AS account_id, account_key, min(email_domain) FILTER (trim(email_domain) <> '') AS email_domain,
 CAST(NULL AS VARCHAR) AS account_name, CAST(NULL AS VARCHAR) AS inferred_brand, CAST(NULL AS VARCHAR) AS website_url,
 CASE WHEN bool_or(is_personal) THEN 'personal_domain_seed' ELSE 'domain_seed' END AS account_type, 'active' AS account_status,
 max(confidence_score) AS confidence_score, bool_or(is_personal) AS is_personal_domain, {TAIL}
 FROM ({ROWS}) r WHERE account_key IS NOT NULL AND account_key <> '' AND {where} GROUP BY account_key"""


def contacts_sql(where: str = "true") -> str:
    first = ", ".join(f"first({c} ORDER BY observed_at, contact_id) FILTER ({c} IS NOT NULL) AS {c}" for c in ("full_name", "first_name", "last_name", "email_domain", "domain_type", "contact_status"))
    return f"""SELECT sha256(email) AS contact_id, source_contact_id, full_name, first_name, last_name, email, email_domain, is_personal_email, domain_type, contact_status, confidence_score,
 source_type, source_table, first_seen_at, last_seen_at, created_at, updated_at FROM (
 SELECT email, first(contact_id ORDER BY observed_at, contact_id) AS source_contact_id, {first}, bool_or(is_personal) AS is_personal_email, max(confidence_score) AS confidence_score, {TAIL}
 FROM ({ROWS}) r WHERE email IS NOT NULL AND email <> '' AND {where} GROUP BY email) g"""


def relationships_sql(where: str = "true") -> str:
    return f"""SELECT sha256(account_key || '|' || email) AS relationship_id, sha256(account_key) AS account_id, sha256(email) AS contact_id, 'domain_membership' AS relationship_type,
 true AS is_primary, 'active' AS relationship_status, max(confidence_score) AS confidence_score, {TAIL}
 FROM ({ROWS}) r WHERE account_key IS NOT NULL AND account_key <> '' AND email IS NOT NULL AND email <> '' AND {where} GROUP BY account_key, email"""


def merged_sql(build, key: str, columns: list[str], rules: dict[str, str]) -> str:
    """The merge of an earlier batch (days up to 20) with a later one (days from 10)."""
    how = {"old": "coalesce(t.{c}, s.{c})", "new": "coalesce(s.{c}, t.{c})", "max": "greatest(t.{c}, s.{c})", "min": "least(t.{c}, s.{c})", "or": "(coalesce(t.{c}, false) OR coalesce(s.{c}, false))", "set": "s.{c}", "leave": "t.{c}"}
    body = ", ".join(f"CASE WHEN t.{key} IS NULL THEN s.{c} WHEN s.{key} IS NULL THEN t.{c} ELSE {how[rules.get(c, 'leave')].format(c=c)} END AS {c}" if c != key else f"coalesce(t.{c}, s.{c}) AS {c}" for c in columns)
    return f"SELECT {body} FROM ({build(EARLY)}) t FULL OUTER JOIN ({build(LATE)}) s ON t.{key} = s.{key}"


SEEN = ["source_type", "source_table", "first_seen_at", "last_seen_at", "created_at", "updated_at"]
ACCOUNT_COLUMNS = ["account_id", "account_key", "email_domain", "account_name", "inferred_brand", "website_url", "account_type", "account_status", "confidence_score", "is_personal_domain", *SEEN]
CONTACT_COLUMNS = ["contact_id", "source_contact_id", "full_name", "first_name", "last_name", "email", "email_domain", "is_personal_email", "domain_type", "contact_status", "confidence_score", *SEEN]
RELATIONSHIP_COLUMNS = ["relationship_id", "account_id", "contact_id", "relationship_type", "is_primary", "relationship_status", "confidence_score", *SEEN]
SET = {"source_type": "set", "source_table": "set", "updated_at": "set", "first_seen_at": "min", "last_seen_at": "max", "confidence_score": "max"}
ACCOUNTS_MERGED = merged_sql(accounts_sql, "account_id", ACCOUNT_COLUMNS, SET | {"email_domain": "old", "account_type": "old", "account_status": "new", "is_personal_domain": "or"})


def rows(spark: SparkSession, root: str) -> DataFrame:
    return R.normalized(view(spark, root, "contact_master"), now())


def batches(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """An earlier and a later batch that overlap and together hold every row."""
    every = rows(spark, root)
    return every.where(EARLY), every.where(LATE)


@query("contact_master", "SELECT contact_id, account_key, email, email_domain, is_personal_email, confidence_score, last_seen_at, created_at FROM contact_master_v")
def contact_scan(spark, root):
    return view(spark, root, "contact_master").select("contact_id", "account_key", "email", "email_domain", "is_personal_email", "confidence_score", "last_seen_at", "created_at")


@query("contact_master", "SELECT contact_id, lower(trim(account_key)) AS account_key, lower(trim(email)) AS email, lower(trim(email_domain)) AS email_domain FROM contact_master_v")
def normalize_keys(spark, root):
    return rows(spark, root).select("contact_id", "account_key", "email", "email_domain")


@query("contact_master", f"SELECT contact_id, sha256(email) AS email_id, sha256(account_key) AS account_id, sha256(account_key || '|' || email) AS relationship_id FROM ({ROWS}) r")
def stable_ids(spark, root):
    r = rows(spark, root)
    key, email = F.col("account_key"), F.col("email")
    return r.select("contact_id", X.stable_id(email).alias("email_id"), X.stable_id(key).alias("account_id"), X.stable_id(key, email).alias("relationship_id"))


@query("contact_master", f"SELECT contact_id, observed_at, is_personal, confidence_score FROM ({ROWS}) r")
def observed_at(spark, root):
    return rows(spark, root).select("contact_id", "observed_at", "is_personal", "confidence_score")


@query("contact_master", accounts_sql())
def account_rollup(spark, root):
    return R.account_rollup(rows(spark, root), now())


@query("contact_master", contacts_sql())
def contact_rollup(spark, root):
    return R.contact_rollup(rows(spark, root), now())


@query("contact_master", relationships_sql())
def relationship_rollup(spark, root):
    return R.relationship_rollup(rows(spark, root), now())


@query(
    "contact_master",
    f"""SELECT count(*) AS rows, count(DISTINCT c.account_key) AS raw_accounts, count(DISTINCT c.email) AS raw_emails,
 count(DISTINCT nullif(r.account_key, '')) AS accounts, count(DISTINCT nullif(r.email, '')) AS emails,
 count(DISTINCT CASE WHEN r.is_personal THEN nullif(r.email, '') END) AS personal_emails, count(*) FILTER (nullif(r.account_key, '') IS NULL) AS rows_without_account
 FROM contact_master_v c JOIN ({ROWS}) r ON c.contact_id = r.contact_id""",
)
def source_preview(spark, root):
    return R.source_preview(view(spark, root, "contact_master"))


@query("contact_master", ACCOUNTS_MERGED)
def merge_accounts(spark, root):
    early, late = batches(spark, root)
    return M.merge_upsert(R.account_rollup(early, now()), R.account_rollup(late, now()), ["account_id"], M.ACCOUNT_RULES)


@query("contact_master", merged_sql(contacts_sql, "contact_id", CONTACT_COLUMNS, SET | {c: "old" for c in ("source_contact_id", "full_name", "first_name", "last_name", "email_domain", "domain_type")} | {"is_personal_email": "or", "contact_status": "new"}))
def merge_contacts(spark, root):
    early, late = batches(spark, root)
    return M.merge_upsert(R.contact_rollup(early, now()), R.contact_rollup(late, now()), ["contact_id"], M.CONTACT_RULES)


@query("contact_master", merged_sql(relationships_sql, "relationship_id", RELATIONSHIP_COLUMNS, {"relationship_status": "new", "confidence_score": "max", "last_seen_at": "max", "updated_at": "set"}))
def merge_relationships(spark, root):
    early, late = batches(spark, root)
    return M.merge_upsert(R.relationship_rollup(early, now()), R.relationship_rollup(late, now()), ["relationship_id"], M.RELATIONSHIP_RULES)


@query(
    "contact_master",
    f"""SELECT count(*) FILTER (t.contact_id IS NULL) AS inserted, count(*) FILTER (t.contact_id IS NOT NULL AND s.contact_id IS NOT NULL) AS updated, count(*) FILTER (s.contact_id IS NULL) AS untouched
 FROM ({contacts_sql(EARLY)}) t FULL OUTER JOIN ({contacts_sql(LATE)}) s ON t.contact_id = s.contact_id""",
)
def merge_counts(spark, root):
    early, late = batches(spark, root)
    return M.merge_counts(R.contact_rollup(early, now()), R.contact_rollup(late, now()), ["contact_id"])


@query(
    "contact_master",
    f"""SELECT relationship_id, account_id, contact_id, relationship_type, is_primary, relationship_status, confidence_score, source_type, source_table, CAST(NULL AS VARCHAR) AS source_url,
 first_seen_at, last_seen_at, created_at, updated_at FROM ({relationships_sql()}) x""",
)
def schema_conform(spark, root):
    return conform(R.relationship_rollup(rows(spark, root), now()), SCHEMAS["relationships"])


@query("contacts", "SELECT email, trim(coalesce(nullif(trim(full_name), ''), coalesce(first_name, '') || ' ' || coalesce(last_name, ''))) AS display_name FROM contacts_v")
def display_name(spark, root):
    return view(spark, root, "contacts").select("email", X.display_name(F.col("full_name"), F.col("first_name"), F.col("last_name")).alias("display_name"))


@query(
    "contact_master",
    """SELECT contact_id, split_part(trim(full_name), ' ', 1) AS first_word, CASE WHEN contains(trim(full_name), ' ') THEN split_part(trim(full_name), ' ', -1) ELSE '' END AS last_word,
 regexp_replace(full_name || ' General Used', '(\\s(Co|General|Internet|Business|New|Used|Service|Parts|Finance))+$', '') AS trimmed
 FROM contact_master_v WHERE full_name IS NOT NULL""",
)
def name_split(spark, root):
    named = view(spark, root, "contact_master").where("full_name IS NOT NULL")
    first, last = X.split_name(F.col("full_name"))
    return named.select("contact_id", first.alias("first_word"), last.alias("last_word"), X.trim_name(F.concat("full_name", F.lit(" General Used"))).alias("trimmed"))


@query("contact_master", "SELECT contact_id, CASE WHEN regexp_matches(trim(email), '^[^@]+@[^@]+$') THEN lower(split_part(trim(email), '@', 2)) END AS domain FROM contact_master_v")
def email_domains(spark, root):
    return view(spark, root, "contact_master").select("contact_id", X.email_domain(X.strip(F.col("email"))).alias("domain"))


@query(
    "contact_master",
    """SELECT contact_id, r.dom AS domain, (d = r.dom OR ends_with(d, '.' || r.dom) OR ends_with(r.dom, '.' || d)) AS belongs
 FROM (SELECT contact_id, lower(split_part(trim(email), '@', 2)) AS d, lower(trim(account_key)) AS dom FROM contact_master_v WHERE trim(account_key) <> '') r""",
)
def email_domain_match(spark, root):
    r = rows(spark, root).where(~X.is_blank(F.col("account_key")))
    return r.select("contact_id", F.col("account_key").alias("domain"), X.same_site_domain(X.email_domain(F.col("email")), F.col("account_key")).alias("belongs"))


#: Keys as a caller may write them.
ASKED = ("acct0.example.net", " ACCT3.example.net", "Acct12.Example.net ", "mail1.example.com", "nowhere.example")


@query("contact_master", f"SELECT r.* FROM ({ROWS}) r WHERE account_key IN ('acct0.example.net', 'acct3.example.net', 'acct12.example.net', 'mail1.example.com', 'nowhere.example')")
def key_filter(spark, root):
    kept = R.with_keys(rows(spark, root), ASKED)
    return kept.select("contact_id", "account_key", "email", "email_domain", "full_name", "first_name", "last_name", "domain_type", "contact_status", "is_personal", "confidence_score", "observed_at")


SYNC_SQL = f"""SELECT 'mailing' AS target_system, task_type AS source_record_type, account_key AS source_record_id, status AS sync_status, created_at AS last_synced_at, created_at AS updated_at
 FROM (SELECT *, row_number() OVER (PARTITION BY task_type, account_key ORDER BY created_at DESC, work_item_id) AS rn FROM work_items_v WHERE {{where}}) w WHERE rn = 1"""


def sync_rows(spark, root, where: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("task_type", "account_key").orderBy(F.col("created_at").desc(), "work_item_id")
    items = view(spark, root, "work_items").where(where).withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return items.select(F.lit("mailing").alias("target_system"), F.col("task_type").alias("source_record_type"), F.col("account_key").alias("source_record_id"), F.col("status").alias("sync_status"), F.col("created_at").alias("last_synced_at"), F.col("created_at").alias("updated_at"))


@query(
    "work_items",
    "SELECT coalesce(t.target_system, s.target_system) AS target_system, coalesce(t.source_record_type, s.source_record_type) AS source_record_type, coalesce(t.source_record_id, s.source_record_id) AS source_record_id, "
    + ", ".join(f"CASE WHEN s.target_system IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in ("sync_status", "last_synced_at", "updated_at"))
    + f" FROM ({SYNC_SQL.format(where='day(created_at) <= 20')}) t FULL OUTER JOIN ({SYNC_SQL.format(where='day(created_at) >= 10')}) s ON t.target_system = s.target_system AND t.source_record_type = s.source_record_type AND t.source_record_id = s.source_record_id",
)
def merge_sync_status(spark, root):
    keys = ["target_system", "source_record_type", "source_record_id"]
    return M.merge_upsert(sync_rows(spark, root, "day(created_at) <= 20"), sync_rows(spark, root, "day(created_at) >= 10"), keys, M.SYNC_RULES)


# Landed batches, written ------------------------------------------------------------------------


def landed(spark: SparkSession, root: str) -> tuple[str, list[dict]]:
    """The folder into which two overlapping batches were merged, and what each merge counted; the second batch comes twice."""
    folder, raw = f"{store.scratch(spark)}/landed-{uuid.uuid4().hex}", view(spark, root, "contact_master")
    day = F.dayofmonth(F.coalesce("last_seen_at", "created_at"))
    merge = merge_batch(folder, now(), parts=8)
    return folder, [merge(raw.where(day <= 20), 0), merge(raw.where(day >= 10), 1), merge(raw.where(day >= 10), 1)]


@query("contact_master", ACCOUNTS_MERGED)
def landed_accounts(spark, root):
    folder, _ = landed(spark, root)
    return current(spark, folder, "accounts").select(*ACCOUNT_COLUMNS)


LANDED = """SELECT '{name}' AS table_name, CAST(0 AS BIGINT) AS batch, count(*) FILTER (t.{key} IS NOT NULL) AS inserted, CAST(0 AS BIGINT) AS updated FROM ({early}) t FULL OUTER JOIN ({late}) s ON t.{key} = s.{key}
 UNION ALL SELECT '{name}', 1, count(*) FILTER (t.{key} IS NULL), count(*) FILTER (t.{key} IS NOT NULL AND s.{key} IS NOT NULL) FROM ({early}) t FULL OUTER JOIN ({late}) s ON t.{key} = s.{key}"""
BUILDS = {"accounts": (accounts_sql, "account_id"), "contacts": (contacts_sql, "contact_id"), "relationships": (relationships_sql, "relationship_id")}


@query("contact_master", " UNION ALL ".join(LANDED.format(name=name, key=key, early=build(EARLY), late=build(LATE)) for name, (build, key) in BUILDS.items()))
def landed_counts(spark, root):
    """Rows that the writes themselves inserted and updated."""
    _, counts = landed(spark, root)
    rows = [(table, batch, c["inserted"], c["updated"]) for batch, tables in enumerate(counts) for table, c in tables.items()]
    return spark.createDataFrame(rows, "table_name string, batch long, inserted long, updated long")
