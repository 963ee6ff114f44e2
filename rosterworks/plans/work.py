"""Queries over accounts and work items: what is due, who takes it, how it moves on."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import merge as M
from ..operators import work as W
from ..sources.views import view
from .base import NOW, now, query

TARGET = "coalesce(classification IN ('dealer', 'dealer_group'), false)"
BLANK = "({c} IS NULL OR trim({c}) = '')".format
MISSING = f"({BLANK(c='website_url')} OR {BLANK(c='account_name')} OR {BLANK(c='inferred_brand')} OR account_city IS NULL OR account_state IS NULL)"
OVER = f"(last_fetch_attempt_at IS NULL OR {NOW} >= last_fetch_attempt_at + CASE WHEN coalesce(blocked_attempt_count, 0) <= 1 THEN INTERVAL 6 HOUR WHEN coalesce(blocked_attempt_count, 0) <= 3 THEN INTERVAL 24 HOUR ELSE INTERVAL 72 HOUR END)"
DUE = f"({TARGET} AND fetch_status = 'blocked' AND {OVER})"
OPEN = f"(status IN ('pending', 'retry') OR (status = 'in_progress' AND lease_expires_at < {NOW})) AND (next_attempt_at IS NULL OR next_attempt_at <= {NOW}) AND (lease_expires_at IS NULL OR lease_expires_at < {NOW})"
BATCH = f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY task_type ORDER BY priority DESC, created_at NULLS FIRST, work_item_id) AS INTEGER) AS position FROM work_items_v WHERE {OPEN}) b WHERE position <= 50"
SEEDS = f"""SELECT 'validate' AS task_type, account_key, CAST(100 AS BIGINT) AS priority FROM accounts_v WHERE NOT coalesce(is_personal_domain, false)
 UNION ALL SELECT 'enrich', account_key, 80 FROM accounts_v WHERE {TARGET} AND {MISSING}
 UNION ALL SELECT 'extract_contacts', account_key, 60 FROM accounts_v WHERE {TARGET} AND NOT {BLANK(c='website_url')}
 UNION ALL SELECT 'retry_blocked', account_key, 40 FROM accounts_v WHERE {DUE}"""
ITEMS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_type, account_key ORDER BY work_item_id) AS rn FROM work_items_v) w WHERE rn = 1"""


def accounts(spark, root):
    return view(spark, root, "accounts")


def items(spark, root):
    return view(spark, root, "work_items")


def one_item_each(spark, root):
    first = items(spark, root).groupBy("task_type", "account_key").agg(F.min_by(F.struct("work_item_id", "status", "priority", "next_attempt_at", "lease_expires_at", "created_at"), "work_item_id").alias("w"))
    return first.select("task_type", "account_key", "w.*")


@query("accounts", f"SELECT account_key FROM accounts_v WHERE {TARGET} AND {MISSING}")
def needs_enrichment(spark, root):
    return accounts(spark, root).where(W.in_target() & W.missing_field()).select("account_key")


@query("accounts", f"SELECT account_key, {OVER} AS due FROM accounts_v WHERE {TARGET} AND fetch_status = 'blocked'")
def retry_due(spark, root):
    blocked = accounts(spark, root).where(W.in_target() & (F.col("fetch_status") == "blocked"))
    return blocked.select("account_key", X.cooldown_over(F.col("last_fetch_attempt_at"), F.col("blocked_attempt_count"), now()).alias("due"))


@query("accounts", f"SELECT count(*) AS due FROM accounts_v WHERE {DUE}")
def retry_due_count(spark, root):
    return accounts(spark, root).where(W.retry_due(now())).agg(F.count("*").alias("due"))


@query("accounts", "SELECT account_key, last_fetch_attempt_at FROM accounts_v WHERE NOT coalesce(is_personal_domain, false) ORDER BY coalesce(last_fetch_attempt_at, TIMESTAMP '1970-01-01'), account_key LIMIT 50")
def validation_batch(spark, root):
    never = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return accounts(spark, root).where(W.not_personal()).select("account_key", "last_fetch_attempt_at").orderBy(F.coalesce("last_fetch_attempt_at", never), "account_key").limit(50)


TIER = "CASE WHEN {w} THEN 0 WHEN {n} THEN 1 WHEN {b} THEN 2 ELSE 3 END".format(w=BLANK(c="website_url"), n=BLANK(c="account_name"), b=BLANK(c="inferred_brand"))


@query("accounts", f"SELECT account_key, {TIER} AS tier FROM accounts_v WHERE {TARGET} AND {MISSING} ORDER BY tier, last_fetch_attempt_at NULLS FIRST, account_key LIMIT 25")
def enrichment_batch(spark, root):
    tier = F.when(X.is_blank(F.col("website_url")), 0).when(X.is_blank(F.col("account_name")), 1).when(X.is_blank(F.col("inferred_brand")), 2).otherwise(3)
    due = accounts(spark, root).where(W.in_target() & W.missing_field()).withColumn("tier", tier)
    return due.orderBy("tier", F.col("last_fetch_attempt_at").asc_nulls_first(), "account_key").limit(25).select("account_key", "tier")


@query(
    "accounts relationships",
    f"""SELECT account_key FROM accounts_v a WHERE {TARGET} AND NOT {BLANK(c='website_url')} AND NOT EXISTS (SELECT 1 FROM relationships_v r WHERE r.account_id = a.account_id AND r.source_type = 'website_contact_extraction')
 ORDER BY CASE source_type WHEN 'website_enrichment' THEN 0 WHEN 'website_resolution' THEN 1 ELSE 2 END, coalesce(last_verified_at, TIMESTAMP '1970-01-01'), account_key LIMIT 25""",
)
def extraction_batch(spark, root):
    return W.extraction_batch(accounts(spark, root), view(spark, root, "relationships"), 25).select("account_key")


@query("accounts", f"SELECT account_key FROM accounts_v WHERE {DUE} ORDER BY last_fetch_attempt_at NULLS FIRST, coalesce(blocked_attempt_count, 0), account_key LIMIT 10")
def retry_batch(spark, root):
    due = accounts(spark, root).where(W.retry_due(now()))
    return due.orderBy(F.col("last_fetch_attempt_at").asc_nulls_first(), F.coalesce("blocked_attempt_count", F.lit(0)), "account_key").limit(10).select("account_key")


@query("work_items", BATCH)
def work_batch(spark, root):
    return W.batch(items(spark, root), 50, now())


@query(
    "accounts work_items",
    f"SELECT sha256(s.task_type || '|' || s.account_key) AS work_item_id, s.task_type, s.account_key, 'pending' AS status, s.priority, CAST(0 AS BIGINT) AS attempt_count, {NOW} AS next_attempt_at, {NOW} AS created_at FROM ({SEEDS}) s WHERE NOT EXISTS (SELECT 1 FROM work_items_v w WHERE w.task_type = s.task_type AND w.account_key = s.account_key)",
)
def work_seed(spark, root):
    return W.seed_items(W.seeds(accounts(spark, root), now()), items(spark, root), now())


@query(
    "accounts work_items",
    f"""SELECT coalesce(w.task_type, s.task_type) AS task_type, coalesce(w.account_key, s.account_key) AS account_key,
 CASE WHEN w.status IS NULL OR (s.priority IS NOT NULL AND w.status IN ('completed', 'failed')) THEN 'pending' ELSE w.status END AS status,
 CASE WHEN w.status IS NULL OR (s.priority IS NOT NULL AND w.status IN ('completed', 'failed', 'retry')) THEN s.priority ELSE w.priority END AS priority,
 CASE WHEN w.status IS NULL OR (s.priority IS NOT NULL AND w.status IN ('completed', 'failed', 'retry')) THEN {NOW} ELSE w.next_attempt_at END AS next_attempt_at,
 CASE WHEN s.priority IS NOT NULL AND w.status IN ('completed', 'failed') THEN NULL ELSE w.lease_expires_at END AS lease_expires_at
 FROM ({ITEMS}) w FULL OUTER JOIN (SELECT * FROM ({SEEDS}) x WHERE task_type = 'retry_blocked') s ON w.task_type = s.task_type AND w.account_key = s.account_key""",
)
def work_reopen(spark, root):
    return W.reopen(one_item_each(spark, root), W.seeds(accounts(spark, root), now()).where("task_type = 'retry_blocked'"), now())


@query(
    "work_items",
    f"""SELECT w.work_item_id, w.account_key, w.task_type, CASE WHEN b.work_item_id IS NULL THEN w.status ELSE 'in_progress' END AS status, w.priority, w.next_attempt_at,
 CASE WHEN b.work_item_id IS NULL THEN w.lease_expires_at ELSE {NOW} + INTERVAL 30 MINUTE END AS lease_expires_at, w.created_at, b.work_item_id IS NOT NULL AS claimed
 FROM work_items_v w LEFT JOIN ({BATCH}) b ON w.work_item_id = b.work_item_id""",
)
def work_claim(spark, root):
    return W.claim(items(spark, root), 50, now())


@query(
    "work_items",
    f"""SELECT work_item_id, account_key, task_type, CASE WHEN status = 'in_progress' AND work_item_id % 2 = 0 THEN 'completed' ELSE status END AS status, priority, next_attempt_at,
 CASE WHEN status = 'in_progress' AND work_item_id % 2 = 0 THEN NULL ELSE lease_expires_at END AS lease_expires_at, created_at, CASE WHEN status = 'in_progress' AND work_item_id % 2 = 0 THEN {NOW} END AS completed_at FROM work_items_v""",
)
def work_complete(spark, root):
    all_items = items(spark, root)
    return W.complete(all_items, all_items.where("status = 'in_progress' AND work_item_id % 2 = 0"), now())


@query(
    "work_items",
    f"""SELECT work_item_id, account_key, task_type, CASE WHEN hit THEN 'retry' ELSE status END AS status, priority, CASE WHEN hit THEN {NOW} + INTERVAL 30 MINUTE ELSE next_attempt_at END AS next_attempt_at,
 CASE WHEN hit THEN NULL ELSE lease_expires_at END AS lease_expires_at, created_at, CASE WHEN hit THEN 'timeout ' || CAST(work_item_id AS VARCHAR) END AS last_error
 FROM (SELECT *, status = 'in_progress' AND work_item_id % 2 = 1 AS hit FROM work_items_v) w""",
)
def work_fail(spark, root):
    all_items = items(spark, root)
    failed = all_items.where("status = 'in_progress' AND work_item_id % 2 = 1").select("work_item_id", F.concat(F.lit("timeout "), F.col("work_item_id").cast("string")).alias("error"))
    return W.fail(all_items, failed, now())


FOLD = """SELECT account_key, arg_max(status, ord) AS fetch_status, count(*) FILTER (status = 'blocked') AS blocked_attempt_count, max(attempted_at) AS last_fetch_attempt_at,
 max(attempted_at) FILTER (status = 'success') AS last_fetch_success_at, nullif(arg_max(coalesce(reason, ''), ord) FILTER (status IN ('blocked', 'success')), '') AS blocked_reason
 FROM (SELECT *, row_number() OVER (ORDER BY attempted_at, attempt_id) AS ord FROM attempts_v) x GROUP BY account_key"""


@query("attempts", FOLD)
def attempt_fold(spark, root):
    return W.fold_attempts(view(spark, root, "attempts"))


@query(
    "accounts attempts",
    f"""SELECT a.account_key, coalesce(f.fetch_status, a.fetch_status) AS fetch_status,
 CASE WHEN f.account_key IS NULL THEN a.blocked_attempt_count ELSE coalesce(a.blocked_attempt_count, 0) + f.blocked_attempt_count END AS blocked_attempt_count,
 CASE WHEN f.blocked_reason IS NOT NULL OR f.last_fetch_success_at IS NOT NULL THEN f.blocked_reason END AS blocked_reason,
 coalesce(f.last_fetch_attempt_at, a.last_fetch_attempt_at) AS last_fetch_attempt_at FROM accounts_v a LEFT JOIN ({FOLD}) f ON a.account_key = f.account_key""",
)
def fetch_transition(spark, root):
    known = accounts(spark, root).withColumn("blocked_reason", F.lit(None).cast("string"))
    return W.fetch_transition(known, W.fold_attempts(view(spark, root, "attempts")))


@query("accounts", f"SELECT account_key, CASE WHEN {BLANK(c='website_url')} THEN 'https://' || account_key ELSE trim(website_url) END AS target FROM accounts_v")
def target_url(spark, root):
    return accounts(spark, root).select("account_key", X.target_url(F.col("website_url"), F.col("account_key")).alias("target"))


@query(
    "accounts",
    f"""SELECT account_key, CAST(row_number() OVER (PARTITION BY account_key ORDER BY pos) - 1 AS INTEGER) AS pos, url FROM (
 SELECT account_key, min(pos) AS pos, url FROM (SELECT account_key, unnest([0, 1, 2, 3, 4]) AS pos, unnest([CASE WHEN NOT {BLANK(c='website_url')} THEN website_url END, 'https://' || account_key, 'https://www.' || account_key, 'http://' || account_key, 'http://www.' || account_key]) AS url FROM accounts_v) u
 WHERE url IS NOT NULL GROUP BY account_key, url) g""",
)
def candidate_urls(spark, root):
    return accounts(spark, root).select("account_key", F.posexplode(X.candidate_urls(F.col("website_url"), F.col("account_key"))).alias("pos", "url"))


@query("accounts", "SELECT account_key, website_url, fetch_status, inferred_brand FROM (SELECT account_key, CASE WHEN c % 5 = 1 THEN 'https://www.' || account_key ELSE website_url END AS website_url, fetch_status, CASE WHEN c % 5 = 1 THEN coalesce(inferred_brand, 'Checked') ELSE inferred_brand END AS inferred_brand FROM (SELECT *, CAST(substr(account_key, 5, length(account_key) - 16) AS BIGINT) AS c FROM accounts_v) x) y")
def apply_updates(spark, root):
    number = F.expr("CAST(substring(account_key, 5, length(account_key) - 16) AS BIGINT)")
    table = accounts(spark, root).select("account_key", "website_url", "fetch_status", "inferred_brand")
    updates = table.where(number % 5 == 1).select("account_key", F.concat(F.lit("https://www."), F.col("account_key")).alias("website_url"), F.lit("Checked").alias("inferred_brand"))
    return M.apply_updates(table, updates, "account_key", {"website_url": M.overwrite, "inferred_brand": M.keep_old})


WORK_FOLD = f"""SELECT work_item_id, CASE arg_max(kind, ord) WHEN 'claim' THEN 'in_progress' WHEN 'complete' THEN 'completed' ELSE 'retry' END AS status, count(*) FILTER (kind = 'claim') AS attempt_count, count(*) FILTER (lost) AS failures,
 arg_max(error, ord) FILTER (lost) AS last_error, max(happened_at) FILTER (kind = 'claim') AS last_attempt_at, max(happened_at) FILTER (kind = 'complete') AS completed_at,
 CASE WHEN arg_max(kind, ord) = 'claim' THEN max(happened_at) + INTERVAL 30 MINUTE END AS lease_expires_at, CASE WHEN arg_max(kind, ord) = 'fail' THEN max(happened_at) + INTERVAL 30 MINUTE END AS next_attempt_at
 FROM (SELECT *, kind = 'fail' AND ord > coalesce(max(ord) FILTER (kind = 'complete') OVER (PARTITION BY work_item_id), 0) AS lost FROM (SELECT *, row_number() OVER (PARTITION BY work_item_id ORDER BY happened_at, event_id) AS ord FROM work_events_v) o) x GROUP BY work_item_id"""


@query("work_events", WORK_FOLD)
def work_fold(spark, root):
    return W.fold_work(view(spark, root, "work_events"))


@query(
    "work_items work_events",
    f"""SELECT w.work_item_id, coalesce(f.status, w.status) AS status, CASE WHEN f.status IS NULL THEN w.lease_expires_at ELSE f.lease_expires_at END AS lease_expires_at, CASE WHEN f.status IS NULL THEN w.next_attempt_at ELSE f.next_attempt_at END AS next_attempt_at, 1 + coalesce(f.attempt_count, 0) AS attempt_count
 FROM (SELECT * REPLACE ('w' || work_item_id AS work_item_id) FROM work_items_v) w LEFT JOIN ({WORK_FOLD}) f ON w.work_item_id = f.work_item_id""",
)
def work_transition(spark, root):
    named = items(spark, root).select(F.concat(F.lit("w"), F.col("work_item_id").cast("string")).alias("work_item_id"), "status", "lease_expires_at", "next_attempt_at", F.lit(1).cast("long").alias("attempt_count"))
    return W.work_transition(named, W.fold_work(view(spark, root, "work_events")))


@query("failures", "SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'browser_connection_refused' WHEN 1 THEN 'browser_dns_error' WHEN 2 THEN 'browser_network_error' WHEN 5 THEN NULL ELSE 'browser_navigation_error' END AS reason FROM failures_v")
def error_reasons(spark, root):
    return view(spark, root, "failures").select("event_id", X.error_reason(F.col("message")).alias("reason"))
