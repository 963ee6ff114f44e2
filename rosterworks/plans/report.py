"""Queries for reports, panels, snapshots and the mailing audience."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params
from ..functions import exprs as X
from ..operators import report as R
from ..operators import work as W
from ..sources.views import view
from .base import NOW, now, query
from .work import BLANK, DUE, MISSING, TARGET, accounts, items

FOUR = "accounts contacts relationships work_items"


def _if(condition: str, name: str) -> str:
    return f"count(*) FILTER ({condition}) AS {name}"


ACCOUNT_SQL = ", ".join(
    [
        "count(*) AS accounts", _if("classification IS NOT NULL", "classified"), _if(TARGET, "dealers"),
        *[_if(f"classification = '{c}'", f"{c}_accounts") for c in ("dealer", "dealer_group", "vendor", "oem", "non_dealer", "unknown")],
        *[_if(f"fetch_status = '{s}'", s) for s in ("success", "blocked", "unavailable")],
        _if(f"{TARGET} AND NOT {BLANK(c='account_name')}", "named"), _if(f"{TARGET} AND NOT {BLANK(c='inferred_brand')}", "branded"),
        _if(f"{TARGET} AND account_city IS NOT NULL AND account_state IS NOT NULL", "located"),
        _if(f"{TARGET} AND (fetch_status = 'blocked' OR ({BLANK(c='account_name')} AND {BLANK(c='inferred_brand')}))", "blocked_or_unparsed"),
    ]
)
CONTACT_SQL = ", ".join(["count(*) AS contacts", _if(f"NOT {BLANK(c='role_family')}", "contacts_with_role"), _if("is_personal_email", "personal_contacts"), _if("lower(contact_status) IN ('suppressed', 'invalid')", "closed_contacts")])
WORK_SQL = ", ".join(_if(f"status = '{s}'", f"{s}_work") for s in R.OPEN_STATUSES)
REPORT_SQL = f"SELECT * FROM (SELECT {ACCOUNT_SQL} FROM accounts_v) a, (SELECT {CONTACT_SQL} FROM contacts_v) c, (SELECT count(*) AS relationships FROM relationships_v) r, (SELECT count(*) AS work, {WORK_SQL} FROM work_items_v) w"
OVERVIEW_SQL = f"SELECT accounts, classified, dealers, vendor_accounts, blocked, success, unavailable, named, branded, contacts, contacts_with_role, relationships, pending_work, retry_work, completed_work FROM ({REPORT_SQL}) x"


def four(spark, root):
    return [view(spark, root, name) for name in FOUR.split()]


@query(FOUR, REPORT_SQL)
def pipeline_report(spark, root):
    return R.pipeline_report(*four(spark, root))


@query(FOUR, OVERVIEW_SQL)
def overview(spark, root):
    return R.overview(*four(spark, root))


@query(FOUR, f"SELECT {NOW} AS snapshot_at, accounts, classified, dealers, vendor_accounts, contacts, contacts_with_role, relationships, blocked, branded, pending_work, retry_work, completed_work, failed_work FROM ({REPORT_SQL}) x")
def snapshot_row(spark, root):
    return R.snapshot_row(*four(spark, root), now())


@query(
    FOUR,
    f"""SELECT 'accounts' AS part, CASE WHEN accounts > 0 THEN 'active' ELSE 'empty' END AS state, accounts AS n FROM ({REPORT_SQL}) x UNION ALL
 SELECT 'contacts', CASE WHEN contacts > 0 THEN 'active' ELSE 'empty' END, contacts FROM ({REPORT_SQL}) x UNION ALL
 SELECT 'work', CASE WHEN pending_work > 0 THEN 'active' ELSE 'empty' END, pending_work FROM ({REPORT_SQL}) x UNION ALL
 SELECT 'blocked', CASE WHEN blocked > 0 THEN 'active' ELSE 'empty' END, blocked FROM ({REPORT_SQL}) x""",
)
def health_rows(spark, root):
    return R.health_rows(R.overview(*four(spark, root)))


def coverage_sql(*names: str) -> str:
    personal = "NOT coalesce(is_personal_domain, false)"
    every = {"candidates": personal, "validated": f"{personal} AND classification IS NOT NULL", "targets": f"{TARGET} AND {personal}", "to_enrich": f"{TARGET} AND {personal} AND {MISSING}", "to_extract": f"{TARGET} AND NOT {BLANK(c='website_url')}", "retry_due": DUE}
    return f"SELECT {', '.join(_if(every[n], n) for n in names)} FROM accounts_v"


@query("accounts", coverage_sql("candidates", "validated"))
def validation_coverage(spark, root):
    return R.coverage(accounts(spark, root), now()).select("candidates", "validated")


@query("accounts", coverage_sql("targets", "to_enrich"))
def enrichment_coverage(spark, root):
    return R.coverage(accounts(spark, root), now()).select("targets", "to_enrich")


@query("accounts", coverage_sql("targets", "to_extract", "retry_due"))
def extraction_coverage(spark, root):
    return R.coverage(accounts(spark, root), now()).select("targets", "to_extract", "retry_due")


@query("accounts", "SELECT coalesce(classification, 'unclassified') AS label, count(*) AS n FROM accounts_v GROUP BY 1")
def classification_counts(spark, root):
    return R.label_counts(accounts(spark, root), F.coalesce("classification", F.lit("unclassified")), "label")


@query("accounts", f"SELECT coalesce(fetch_status, 'not_attempted') AS label, count(*) AS n FROM accounts_v WHERE {TARGET} GROUP BY 1")
def fetch_status_counts(spark, root):
    return R.label_counts(accounts(spark, root).where(W.in_target()), F.coalesce("fetch_status", F.lit("not_attempted")), "label")


@query("accounts", f"SELECT trim(inferred_brand) AS label, count(*) AS n FROM accounts_v WHERE {TARGET} AND NOT {BLANK(c='inferred_brand')} GROUP BY 1 ORDER BY n DESC, label LIMIT 15")
def brand_counts(spark, root):
    named = accounts(spark, root).where(W.in_target() & ~X.is_blank(F.col("inferred_brand")))
    return R.label_counts(named, X.strip(F.col("inferred_brand")), "label", 15)


@query("contacts", "SELECT coalesce(nullif(trim(role_family), ''), 'Unknown') AS label, count(*) AS n FROM contacts_v GROUP BY 1 ORDER BY n DESC, label LIMIT 12")
def role_family_counts(spark, root):
    return R.label_counts(view(spark, root, "contacts"), F.coalesce(X.filled(X.strip(F.col("role_family"))), F.lit("Unknown")), "label", 12)


@query("accounts", f"SELECT DISTINCT trim(inferred_brand) AS brand FROM accounts_v WHERE NOT {BLANK(c='inferred_brand')}")
def brand_values(spark, root):
    return accounts(spark, root).where(~X.is_blank(F.col("inferred_brand"))).select(X.strip(F.col("inferred_brand")).alias("brand")).distinct().orderBy("brand")


@query("contacts", "SELECT count(*) AS contacts FROM contacts_v")
def contact_count(spark, root):
    return view(spark, root, "contacts").agg(F.count("*").alias("contacts"))


@query("contact_master", "SELECT count(DISTINCT nullif(lower(trim(email_domain)), '')) AS domains FROM contact_master_v")
def domain_count(spark, root):
    return view(spark, root, "contact_master").agg(F.count_distinct(X.filled(X.norm_key(F.col("email_domain")))).alias("domains"))


@query("work_items", f"SELECT task_type, count(*) AS items, {WORK_SQL} FROM work_items_v GROUP BY task_type")
def work_backlog(spark, root):
    return R.backlog(items(spark, root))


@query("work_items", "SELECT task_type AS target_system, status AS sync_status, created_at, work_item_id FROM (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY created_at DESC NULLS LAST, work_item_id) AS rn FROM work_items_v) w WHERE rn = 1")
def latest_sync(spark, root):
    newest = R.latest(items(spark, root), "task_type", [F.col("created_at").desc_nulls_last(), F.col("work_item_id")])
    return newest.select(F.col("task_type").alias("target_system"), F.col("status").alias("sync_status"), "created_at", "work_item_id")


@query(
    "work_items",
    "SELECT task_type AS target_system, CASE WHEN task_type = 'retry_blocked' THEN 'not_configured' WHEN status IN ('completed') THEN 'healthy' WHEN status = 'failed' THEN 'error' ELSE 'warning' END AS health FROM (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY created_at DESC NULLS LAST, work_item_id) AS rn FROM work_items_v) w WHERE rn = 1",
)
def integration_health(spark, root):
    return R.integration_health(latest_sync(spark, root), F.col("target_system") != "retry_blocked")


@query("work_items", "SELECT work_item_id AS run_id, task_type, status, created_at AS started_at FROM work_items_v ORDER BY created_at DESC, work_item_id LIMIT 12")
def recent_runs(spark, root):
    return items(spark, root).orderBy(F.col("created_at").desc(), "work_item_id").limit(12).select(F.col("work_item_id").alias("run_id"), "task_type", "status", F.col("created_at").alias("started_at"))


@query("work_items", "SELECT task_type, count(*) AS claimed, count(*) FILTER (status = 'completed') AS succeeded, count(*) FILTER (status = 'retry') AS failed, max(created_at) AS completed_at FROM work_items_v GROUP BY task_type")
def run_summary(spark, root):
    return items(spark, root).groupBy("task_type").agg(F.count("*").alias("claimed"), F.count_if(F.col("status") == "completed").alias("succeeded"), F.count_if(F.col("status") == "retry").alias("failed"), F.max("created_at").alias("completed_at"))


@query("accounts", f"SELECT account_key, blocked_attempt_count, last_fetch_attempt_at FROM accounts_v WHERE {TARGET} AND fetch_status = 'blocked' ORDER BY blocked_attempt_count DESC NULLS LAST, last_fetch_attempt_at DESC NULLS LAST, account_key LIMIT 12")
def blocked_accounts(spark, root):
    blocked = accounts(spark, root).where(W.in_target() & (F.col("fetch_status") == "blocked"))
    return blocked.orderBy(F.col("blocked_attempt_count").desc_nulls_last(), F.col("last_fetch_attempt_at").desc_nulls_last(), "account_key").limit(12).select("account_key", "blocked_attempt_count", "last_fetch_attempt_at")


@query("snapshots", "SELECT snapshot_at, accounts, blocked FROM snapshots_v ORDER BY snapshot_at DESC LIMIT 1 OFFSET 1")
def snapshot_page(spark, root):
    return view(spark, root, "snapshots").orderBy(F.col("snapshot_at").desc()).offset(1).limit(1)


@query(
    "snapshots",
    """SELECT metric, value, before, value - before AS delta FROM (SELECT unnest(['accounts', 'blocked']) AS metric, unnest([accounts, blocked]) AS value, unnest([ab, bb]) AS before FROM (
 SELECT *, coalesce(lag(accounts) OVER (ORDER BY snapshot_at), 0) AS ab, coalesce(lag(blocked) OVER (ORDER BY snapshot_at), 0) AS bb FROM snapshots_v ORDER BY snapshot_at DESC LIMIT 1) x) y""",
)
def snapshot_delta(spark, root):
    return R.snapshot_delta(view(spark, root, "snapshots"), ["accounts", "blocked"])


@query(
    "snapshots",
    """SELECT metric, current, current - old AS delta, CASE WHEN current > old THEN 'up' WHEN current < old THEN 'down' ELSE 'flat' END AS direction FROM (
 SELECT metric, arg_max(value, snapshot_at) AS current, arg_min(value, snapshot_at) AS old FROM (
 SELECT snapshot_at, unnest(['accounts', 'blocked']) AS metric, unnest([accounts, blocked]) AS value FROM (SELECT * FROM snapshots_v ORDER BY snapshot_at DESC LIMIT 10) s) u GROUP BY metric) g""",
)
def snapshot_trend(spark, root):
    return R.snapshot_trend(view(spark, root, "snapshots"), ["accounts", "blocked"]).drop("points")


@query(
    "snapshots",
    """SELECT snapshot_at, round((rn - 1) * 100.0 / 9, 2) AS x, round(30 - (blocked - lo) * 24.0 / greatest(hi - lo, 1), 2) AS y FROM (
 SELECT *, row_number() OVER (ORDER BY snapshot_at) AS rn, min(blocked) OVER () AS lo, max(blocked) OVER () AS hi FROM (SELECT * FROM snapshots_v ORDER BY snapshot_at DESC LIMIT 10) s) w""".replace("100.0", "CAST(100 AS DOUBLE)").replace("24.0", "CAST(24 AS DOUBLE)"),
)
def sparkline_points(spark, root):
    recent = view(spark, root, "snapshots").orderBy(F.col("snapshot_at").desc()).limit(10)
    values = F.array_sort(F.collect_list(F.struct("snapshot_at", F.col("blocked").alias("v"))))
    points = recent.agg(values.alias("s")).withColumn("line", F.split(R.sparkline(F.col("s.v")), " ")).select(F.explode(F.arrays_zip("s", "line")).alias("p"))
    part = lambda k: F.element_at(F.split("p.line", ","), k).cast("double")
    return points.select(F.col("p.s.snapshot_at").alias("snapshot_at"), part(1).alias("x"), part(2).alias("y"))


AUDIENCE_SQL = f"""SELECT email, account_key, inferred_brand, account_name FROM (
 SELECT c.email, a.account_key, a.inferred_brand, a.account_name, row_number() OVER (PARTITION BY lower(trim(c.email)) ORDER BY c.confidence_score DESC, c.last_seen_at DESC NULLS LAST, a.account_key) AS rn
 FROM contacts_v c JOIN relationships_v r ON c.contact_id = r.contact_id JOIN accounts_v a ON r.account_id = a.account_id
 WHERE {TARGET} AND NOT {BLANK(c='inferred_brand')} AND NOT {BLANK(c='c.email')} AND NOT coalesce(is_personal_email, false) AND coalesce(lower(contact_status), 'active') NOT IN ('inactive', 'suppressed', 'invalid')) x WHERE rn = 1"""


def reached(spark, root):
    return R.audience(accounts(spark, root), view(spark, root, "contacts"), view(spark, root, "relationships"), params.EXCLUDED_STATUSES)


@query("accounts contacts relationships", f"SELECT * FROM ({AUDIENCE_SQL}) y ORDER BY inferred_brand, account_name NULLS FIRST, email LIMIT 100")
def audience(spark, root):
    return reached(spark, root).select("email", "account_key", "inferred_brand", "account_name").orderBy("inferred_brand", F.col("account_name").asc_nulls_first(), "email").limit(100)


@query("accounts contacts relationships", f"SELECT CAST(floor((row_number() OVER (ORDER BY email) - 1) / 100) AS BIGINT) AS batch, email, '{{\"address\":\"' || email || '\",\"fields\":[{{\"key\":\"brand\",\"value\":\"' || inferred_brand || '\"}},{{\"key\":\"account\",\"value\":\"' || account_key || '\"}}]}}' AS payload FROM ({AUDIENCE_SQL}) y")
def audience_export(spark, root):
    rows = reached(spark, root).withColumn("display_name", F.lit(None).cast("string"))
    return R.export_payload(rows, [("brand", "inferred_brand"), ("account", "account_key")])


SENT = "SELECT email FROM contacts_v WHERE CAST(substr(email, 2, instr(email, '@') - 2) AS BIGINT) % 4 = 1"


def ledger(spark, root):
    """Every fourth contact has been written to; of the others some have failed."""
    number = F.regexp_extract("email", "^p([0-9]+)@", 1).cast("long") % 4
    rows = view(spark, root, "contacts").where(number.isin(1, 2)).withColumn("failed", number == 2)
    return R.sent_rows(rows.where("NOT failed"), "mail", "synced", now()).unionByName(R.sent_rows(rows.where("failed"), "mail", "failed", now()))


@query("accounts contacts relationships", f"SELECT * FROM ({AUDIENCE_SQL}) y WHERE email NOT IN ({SENT}) ORDER BY inferred_brand, account_name NULLS FIRST, email LIMIT 100")
def audience_next(spark, root):
    return R.next_audience(reached(spark, root).select("email", "account_key", "inferred_brand", "account_name"), ledger(spark, root), 100, "mail")


@query(
    "accounts contacts relationships",
    f"""SELECT * FROM ({AUDIENCE_SQL}) y WHERE email NOT IN ({SENT}) AND (inferred_brand > 'Brand12' OR (inferred_brand = 'Brand12' AND (account_name > 'Customer#000000500' OR (account_name = 'Customer#000000500' AND email > 'p2')))) ORDER BY inferred_brand, account_name NULLS FIRST, email LIMIT 100""",
)
def audience_after(spark, root):
    return R.next_audience(reached(spark, root).select("email", "account_key", "inferred_brand", "account_name"), ledger(spark, root), 100, "mail", ("Brand12", "Customer#000000500", "p2"))
