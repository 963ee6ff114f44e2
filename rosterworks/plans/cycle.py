"""Queries over validation from raw pages and over one whole cycle of work.

The view ``visits`` says of each account which of its pages were met, refused or missing, and what they show; the SQL
starts from that knowledge, so equal rows mean that choosing, parsing, ruling and settling found it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params
from ..operators import cycle as Y
from ..operators import validate as V
from ..sources.views import view
from . import report as R
from .base import NOW, now, query
from .pages import _word, decided_sql, signals_sql
from .work import OPEN, SEEDS, accounts

#: The number in an account's key, and what follows from it.
N = "CAST(substr(account_key, 5, length(account_key) - 16) AS BIGINT)"
KNOWN = f"(SELECT *, {N} AS k FROM accounts_v)"
PERSON = "chr(CAST(65 + k % 26 AS INTEGER)) || 'ames ' || chr(CAST(65 + k * 7 % 26 AS INTEGER)) || 'mith'"
MET = "k % 11 <> 0 AND k % 8 <> 1"
HOME_MET = "k % 11 <> 0 AND k % 4 <> 1"
FETCH = f"CASE WHEN {MET} THEN 'success' WHEN k % 4 = 1 THEN 'blocked' ELSE 'unavailable' END"
WHY = f"CASE WHEN {MET} THEN NULL WHEN k % 4 = 1 THEN 'access denied' ELSE 'no_public_html' END"
STOCK = "(k % 6 = 2 AND (k % 11 <> 0 OR k % 4 = 1)) OR (k % 2 = 1 AND k % 3 <> 2 AND (k % 4 = 1 OR k % 3 = 0))"
TOLD = f"""SELECT a.account_key, p.final_url AS source_url, lower(concat_ws(' ', a.account_key, coalesce(account_name, ''), coalesce(inferred_brand, ''), p.final_url, substr(p.shown, 1, 12000),
 CASE WHEN {_word('a.account_key', params.BRAND_WORDS)} THEN 'account_key_brand_hint' ELSE '' END, CASE WHEN {STOCK} THEN 'inventory_page_detected' ELSE '' END, CASE WHEN k % 4 = 1 THEN 'blocked_site' ELSE '' END)) AS e
 FROM {KNOWN} a JOIN visits_v p ON a.account_key = p.account_key AND p.page_id = k * 10"""
JUDGED = decided_sql(signals_sql(TOLD))


def pages(spark, root):
    """Visits as pages are collected: without what the view knows about them."""
    return view(spark, root, "visits").select("page_id", "url", "status_code", "final_url", "html")


@query("accounts visits", f"SELECT a.account_key, CASE WHEN k % 11 <> 0 OR k % 4 = 1 THEN k * 10 END AS page_id, p.final_url AS source_url, p.status_code, {HOME_MET} AS usable FROM {KNOWN} a JOIN visits_v p ON a.account_key = p.account_key AND p.page_id = k * 10")
def home_visits(spark, root):
    return V.home_visits(accounts(spark, root), V.visits(pages(spark, root)))


@query("accounts visits", JUDGED)
def site_validation(spark, root):
    return V.validate(accounts(spark, root), pages(spark, root)).select("account_key", "rule_id", "classification", "confidence")


# One cycle -------------------------------------------------------------------------------------

SIZE = "CASE task_type WHEN 'validate' THEN 50 WHEN 'enrich' THEN 25 WHEN 'extract_contacts' THEN 25 ELSE 10 END"
PICKED = f"SELECT work_item_id FROM (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY priority DESC, created_at NULLS FIRST, work_item_id) AS position FROM ({{items}}) i WHERE {OPEN}) b WHERE position <= {SIZE}"
SEEDED = f"""SELECT CAST(work_item_id AS VARCHAR) AS work_item_id, account_key, task_type, status, priority, next_attempt_at, lease_expires_at, created_at FROM work_items_v
 UNION ALL SELECT sha256(s.task_type || '|' || s.account_key), s.account_key, s.task_type, 'pending', s.priority, {NOW}, NULL, {NOW} FROM ({SEEDS}) s WHERE NOT EXISTS (SELECT 1 FROM work_items_v w WHERE w.task_type = s.task_type AND w.account_key = s.account_key)"""
#: Claimed items with what became of their account's pages; the accounts of a task.
CLAIMED = f"SELECT s.*, {N} AS k FROM ({SEEDED}) s WHERE work_item_id IN ({PICKED.format(items=SEEDED)})"


def _of(*tasks: str) -> str:
    """Whether the account ``a`` was claimed for one of the tasks."""
    listed = ", ".join(f"'{t}'" for t in tasks)
    return f"a.account_key IN (SELECT account_key FROM claimed WHERE task_type IN ({listed}))"


def _after(rest: str) -> str:
    """SQL over ``claimed``, so that it is worked out once."""
    return f"SELECT * FROM (WITH claimed AS MATERIALIZED ({CLAIMED}) {rest}) q"


@query(
    "work_items",
    f"""SELECT w.task_type, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'in_progress') AS in_progress, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(p.work_item_id) AS claimable
 FROM work_items_v w LEFT JOIN ({PICKED.format(items='SELECT * FROM work_items_v')}) p ON w.work_item_id = p.work_item_id GROUP BY w.task_type""",
)
def cycle_preview(spark, root):
    return Y.preview(view(spark, root, "work_items"), as_of=now())


def cycled(spark, root):
    """The tables after one cycle over the visits."""
    contacts = view(spark, root, "contacts").withColumns({c: F.lit(None).cast("string") for c in ("role_type", "source_url", "source_type")})
    return Y.run_cycle(accounts(spark, root), contacts, view(spark, root, "relationships"), view(spark, root, "work_items"), pages(spark, root), now())


ITEMS = f"""SELECT s.work_item_id, s.account_key, s.task_type, CASE WHEN c.k IS NULL THEN s.status WHEN {MET} THEN 'completed' ELSE 'retry' END AS status, s.priority, CASE WHEN c.k IS NULL THEN s.lease_expires_at END AS lease_expires_at,
 CASE WHEN {MET} THEN {NOW} END AS completed_at, CASE WHEN c.k IS NULL OR {MET} THEN s.next_attempt_at ELSE {NOW} + INTERVAL 30 MINUTE END AS next_attempt_at, CASE WHEN c.k IS NOT NULL THEN {WHY} END AS last_error
 FROM ({SEEDED}) s LEFT JOIN claimed c ON s.work_item_id = c.work_item_id"""


@query("accounts work_items", _after(ITEMS))
def cycle_items(spark, root):
    return cycled(spark, root)["work_items"].select("work_item_id", "account_key", "task_type", "status", "priority", "lease_expires_at", "completed_at", "next_attempt_at", "last_error")


SITE = "'https://' || account_key || CASE k % 3 WHEN 0 THEN '/honda/' WHEN 1 THEN '/autos/' ELSE '/' END"
FIRST = f"CASE WHEN {HOME_MET} THEN {SITE} ELSE {SITE} || 'meet-our-staff' END"
REPLACED = """coalesce(j.classification <> 'unknown' AND j.confidence >= 0.8 AND (a.classification_confidence IS NULL OR j.confidence >= a.classification_confidence
 OR coalesce(a.classification <> j.classification AND j.confidence >= greatest(coalesce(a.classification_confidence, 0) - CAST(0.1 AS DOUBLE), CAST(0.8 AS DOUBLE)), false)
 OR (a.classification = 'vendor' AND j.classification IN ('dealer', 'dealer_group', 'non_dealer', 'oem'))), false)"""
ACCOUNTS = f"""SELECT account_id, account_key, is_personal_domain, CASE WHEN enriched THEN CASE WHEN {HOME_MET} THEN 'Acct' || k || ' Welcome' ELSE 'Staff of Acct' || k END ELSE account_name END AS account_name, CASE WHEN enriched AND k % 3 = 0 THEN 'Honda' ELSE inferred_brand END AS inferred_brand,
 CASE WHEN again AND {HOME_MET} THEN {SITE} WHEN enriched THEN {FIRST} ELSE website_url END AS website_url, account_city, account_state, CASE WHEN replaced THEN new_class ELSE classification END AS classification, CASE WHEN replaced THEN new_score ELSE classification_confidence END AS classification_confidence,
 CASE WHEN touched THEN {FETCH} ELSE fetch_status END AS fetch_status, CASE WHEN touched THEN coalesce(blocked_attempt_count, 0) + CASE WHEN {FETCH} = 'blocked' THEN 1 ELSE 0 END ELSE blocked_attempt_count END AS blocked_attempt_count, CASE WHEN touched THEN {NOW} ELSE last_fetch_attempt_at END AS last_fetch_attempt_at
 FROM (SELECT a.*, {N.replace('account_key', 'a.account_key')} AS k, j.classification AS new_class, j.confidence AS new_score, {_of('validate', 'retry_blocked')} AND {REPLACED} AS replaced, a.account_key IN (SELECT account_key FROM claimed) AS touched,
  {_of('enrich')} AND a.account_key IN (SELECT account_key FROM claimed WHERE {MET}) AS enriched, {_of('retry_blocked')} AS again
  FROM accounts_v a LEFT JOIN ({JUDGED}) j ON a.account_key = j.account_key) x"""


@query("accounts work_items visits", _after(ACCOUNTS))
def cycle_accounts(spark, root):
    columns = ("account_id", "account_key", "is_personal_domain", "account_name", "inferred_brand", "website_url", "account_city", "account_state", "classification", "classification_confidence", "fetch_status", "blocked_attempt_count", "last_fetch_attempt_at")
    return cycled(spark, root)["accounts"].select(*columns)


MAIL = "'boss' || k || '@' || account_key"
PEOPLE = f"SELECT DISTINCT account_key, k, {MAIL} AS email, {PERSON} AS full_name, k % 3 = 0 AS chief FROM claimed WHERE task_type = 'extract_contacts' AND {MET} AND k % 3 <> 2"
CONTACTS = f"""SELECT contact_id, email, full_name, CAST(NULL AS VARCHAR) AS role_type, role_family, is_personal_email, contact_status, confidence_score, CAST(NULL AS VARCHAR) AS source_type FROM contacts_v
 UNION ALL SELECT sha256(email), email, full_name, CASE WHEN chief THEN 'general_manager' ELSE 'sales' END, CASE WHEN chief THEN 'executive' ELSE 'sales' END, NULL, 'active', CAST(0.98 AS DOUBLE), 'website_contact_extraction' FROM ({PEOPLE}) p"""
BONDS = f"SELECT relationship_id, account_id, contact_id, source_type FROM relationships_v UNION ALL SELECT sha256(account_key || '|' || email), sha256(account_key), sha256(email), 'website_contact_extraction' FROM ({PEOPLE}) p"


@query("accounts work_items contacts", _after(CONTACTS))
def cycle_contacts(spark, root):
    return cycled(spark, root)["contacts"].select("contact_id", "email", "full_name", "role_type", "role_family", "is_personal_email", "contact_status", "confidence_score", "source_type")


@query("accounts work_items relationships", _after(BONDS))
def cycle_relationships(spark, root):
    return cycled(spark, root)["relationships"].select("relationship_id", "account_id", "contact_id", "source_type")


@query(
    "accounts work_items",
    _after(f"""SELECT sha256(t.task_type || '|' || strftime({NOW}, '%Y-%m-%d %H:%M:%S')) AS run_id, t.task_type, requested_batch_size, claimed_count, succeeded_count, claimed_count - succeeded_count AS failed_count,
 CASE WHEN claimed_count > 0 AND succeeded_count = 0 THEN 'failed' ELSE 'completed' END AS run_status, CASE WHEN claimed_count = 0 THEN 'nothing to claim' WHEN claimed_count > succeeded_count THEN (claimed_count - succeeded_count) || ' without a usable page' END AS run_notes, {NOW} AS started_at
 FROM (SELECT v.task_type, CAST({SIZE.replace('task_type', 'v.task_type')} AS BIGINT) AS requested_batch_size, count(c.k) AS claimed_count, count(*) FILTER ({MET}) AS succeeded_count FROM (VALUES ('validate'), ('enrich'), ('extract_contacts'), ('retry_blocked')) v(task_type) LEFT JOIN claimed c ON v.task_type = c.task_type GROUP BY v.task_type) t"""),
)
def cycle_runs(spark, root):
    return cycled(spark, root)["runs"].select("run_id", "task_type", "requested_batch_size", "claimed_count", "succeeded_count", "failed_count", "run_status", "run_notes", "started_at")


@query(
    "accounts work_items contacts relationships visits",
    _after(f"""SELECT {NOW} AS snapshot_at, accounts, classified, dealers, vendor_accounts, contacts, contacts_with_role, relationships, blocked, branded, pending_work, retry_work, completed_work, failed_work
 FROM (SELECT {R.ACCOUNT_SQL} FROM ({ACCOUNTS}) a) a, (SELECT {R.CONTACT_SQL} FROM ({CONTACTS}) c) c, (SELECT count(*) AS relationships FROM ({BONDS}) r) r, (SELECT count(*) AS work, {R.WORK_SQL} FROM ({ITEMS}) w) w"""),
)
def cycle_snapshot(spark, root):
    return cycled(spark, root)["snapshot"]
