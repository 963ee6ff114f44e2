"""Counts, panels, snapshots and trends; one pass over each table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import is_blank, norm_key
from ..sources import store
from .work import in_target, missing_field, not_personal, retry_due

OPEN_STATUSES = ("pending", "retry", "in_progress", "completed", "failed")


def _count(condition: Column, name: str) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


def account_counts() -> list[Column]:
    named = lambda label: F.col("classification") == label
    return [
        F.count("*").alias("accounts"),
        _count(F.col("classification").isNotNull(), "classified"),
        _count(in_target(), "dealers"),
        *[_count(named(label), f"{label}_accounts") for label in ("dealer", "dealer_group", "vendor", "oem", "non_dealer", "unknown")],
        *[_count(F.col("fetch_status") == s, s) for s in ("success", "blocked", "unavailable")],
        _count(in_target() & ~is_blank(F.col("account_name")), "named"),
        _count(in_target() & ~is_blank(F.col("inferred_brand")), "branded"),
        _count(in_target() & F.col("account_city").isNotNull() & F.col("account_state").isNotNull(), "located"),
        _count(in_target() & ((F.coalesce("fetch_status", F.lit("")) == "blocked") | (is_blank(F.col("account_name")) & is_blank(F.col("inferred_brand")))), "blocked_or_unparsed"),
    ]


def contact_counts() -> list[Column]:
    return [F.count("*").alias("contacts"), _count(~is_blank(F.col("role_family")), "contacts_with_role"), _count(F.col("is_personal_email"), "personal_contacts"), _count(F.lower("contact_status").isin("suppressed", "invalid"), "closed_contacts")]


def work_counts() -> list[Column]:
    return [_count(F.col("status") == s, f"{s}_work") for s in OPEN_STATUSES]


def beside(*frames: DataFrame) -> DataFrame:
    """One-row tables next to each other."""
    out = frames[0]
    for other in frames[1:]:
        out = out.crossJoin(other)
    return out


def pipeline_report(accounts: DataFrame, contacts: DataFrame, relationships: DataFrame, items: DataFrame) -> DataFrame:
    """All counters in one row: one aggregate per table."""
    return beside(accounts.agg(*account_counts()), contacts.agg(*contact_counts()), relationships.agg(F.count("*").alias("relationships")), items.agg(F.count("*").alias("work"), *work_counts()))


def overview(accounts: DataFrame, contacts: DataFrame, relationships: DataFrame, items: DataFrame) -> DataFrame:
    keep = ("accounts", "classified", "dealers", "vendor_accounts", "blocked", "success", "unavailable", "named", "branded", "contacts", "contacts_with_role", "relationships", "pending_work", "retry_work", "completed_work")
    return pipeline_report(accounts, contacts, relationships, items).select(*keep)


def snapshot_row(accounts: DataFrame, contacts: DataFrame, relationships: DataFrame, items: DataFrame, as_of: Column) -> DataFrame:
    keep = ("accounts", "classified", "dealers", "vendor_accounts", "contacts", "contacts_with_role", "relationships", "blocked", "branded", "pending_work", "retry_work", "completed_work", "failed_work")
    return pipeline_report(accounts, contacts, relationships, items).select(as_of.alias("snapshot_at"), *keep)


def coverage(accounts: DataFrame, as_of: Column) -> DataFrame:
    """What is classified, still to enrich, ready for extraction and due for another try."""
    return accounts.agg(
        _count(not_personal(), "candidates"),
        _count(not_personal() & F.col("classification").isNotNull(), "validated"),
        _count(in_target() & not_personal(), "targets"),
        _count(in_target() & not_personal() & missing_field(), "to_enrich"),
        _count(in_target() & ~is_blank(F.col("website_url")), "to_extract"),
        _count(retry_due(as_of), "retry_due"),
    )


def label_counts(df: DataFrame, label: Column, name: str, limit: int | None = None) -> DataFrame:
    """Rows by label, most frequent first, ties by label; the top ones alone if there is a limit."""
    out = df.groupBy(label.alias(name)).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), name)
    return out.limit(limit) if limit else out


def backlog(items: DataFrame) -> DataFrame:
    return items.groupBy("task_type").agg(F.count("*").alias("items"), *work_counts())


def latest(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rank = 1").drop("_rank")


def snapshot_delta(snapshots: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One card per metric: the newest value, the one before (0 if there is none), their difference."""
    order = Window.orderBy("snapshot_at")
    recent = snapshots.orderBy(F.col("snapshot_at").desc()).limit(2)
    last = recent.select("*", *[F.coalesce(F.lag(m).over(order), F.lit(0)).alias(f"{m}_before") for m in metrics]).orderBy(F.col("snapshot_at").desc()).limit(1)
    cards = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.col(f"{m}_before").alias("before")) for m in metrics]))
    return last.select(cards.alias("c")).select("c.metric", "c.value", "c.before", (F.col("c.value") - F.col("c.before")).alias("delta"))


def snapshot_trend(snapshots: DataFrame, metrics: Sequence[str], size: int = 10) -> DataFrame:
    """Per metric over the newest ``size`` snapshots: current value, change since the first, direction, sparkline."""
    recent = snapshots.orderBy(F.col("snapshot_at").desc()).limit(size)
    long = recent.select("snapshot_at", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])).alias("c")).select("snapshot_at", "c.*")
    grouped = long.groupBy("metric").agg(F.max_by("value", "snapshot_at").alias("current"), F.min_by("value", "snapshot_at").alias("first"), F.transform(F.array_sort(F.collect_list(F.struct("snapshot_at", "value"))), lambda x: x["value"]).alias("vals"))
    delta = F.col("current") - F.col("first")
    return grouped.select("metric", "current", delta.alias("delta"), F.when(delta > 0, "up").when(delta < 0, "down").otherwise("flat").alias("direction"), sparkline(F.col("vals")).alias("points"))


def sparkline(values: Column, width: float = 100.0, height: float = 30.0, rise: float = 24.0) -> Column:
    """Points "x,y" of a line through values on a field of 100 by 30; one value makes a level line."""
    low, high, n = F.array_min(values), F.array_max(values), F.size(values)
    x = lambda k: F.round(k * width / (n - 1), 2)
    y = lambda v: F.round(F.lit(height) - (v - low) / F.greatest(high - low, F.lit(1)) * rise, 2)
    line = F.array_join(F.transform(values, lambda v, k: F.concat_ws(",", x(k).cast("string"), y(v).cast("string"))), " ")
    return F.when(n == 1, F.lit("0,30 100,30")).otherwise(line)


def integration_health(status: DataFrame, configured: Column) -> DataFrame:
    """healthy, warning or error for each system (target_system, sync_status) with its latest status."""
    good, bad = F.lower("sync_status").isin("completed", "success", "synced", "healthy"), F.lower("sync_status").isin("failed", "error")
    return status.select("target_system", F.when(~configured, "not_configured").when(F.col("sync_status").isNull(), "warning").when(bad, "error").when(good, "healthy").otherwise("warning").alias("health"))


def health_rows(counts: DataFrame) -> DataFrame:
    """Rows (part, state, n) from an overview row."""
    parts = (("accounts", "accounts"), ("contacts", "contacts"), ("work", "pending_work"), ("blocked", "blocked"))
    rows = [F.struct(F.lit(p).alias("part"), F.when(F.col(c) > 0, "active").otherwise("empty").alias("state"), F.col(c).alias("n")) for p, c in parts]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def audience(accounts: DataFrame, contacts: DataFrame, relationships: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """One row per e-mail that may be written to: its most certain, latest contact and account.

    Both sides are filtered before the joins; of a contact's accounts the smallest key wins a tie.
    """
    people = contacts.where(~is_blank(F.col("email")) & ~F.coalesce("is_personal_email", F.lit(False)) & ~F.coalesce(F.lower("contact_status"), F.lit("active")).isin(*excluded))
    shops = accounts.where(in_target() & ~is_blank(F.col("inferred_brand"))).select("account_id", "account_key", "account_name", "inferred_brand", "account_city", "account_state", "website_url")
    joined = people.join(relationships.select("account_id", "contact_id"), "contact_id").join(shops, "account_id")
    order = Window.partitionBy(norm_key(F.col("email"))).orderBy(F.col("confidence_score").desc(), F.col("last_seen_at").desc_nulls_last(), "account_key")
    return joined.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def next_audience(audience_rows: DataFrame, ledger: DataFrame, limit: int, system: str, after: tuple | None = None) -> DataFrame:
    """The next ``limit`` rows of the audience by brand, name and address that the ledger has not sent to ``system``.

    ledger: target_system, source_record_id (an address), sync_status; failed rows are sent again. With ``after``, the brand, name and
    address of the last row sent, only rows behind it are looked at, so that a long campaign need not rank those before.
    """
    sent = ledger.where((F.col("target_system") == system) & ~F.coalesce(F.lower("sync_status").isin("failed", "error"), F.lit(False))).select(norm_key(F.col("source_record_id")).alias("_email")).distinct()
    rows = audience_rows.withColumn("_email", norm_key(F.col("email")))
    if after is not None:
        brand, name, email = after
        same_name = F.col("account_name").eqNullSafe(F.lit(name))
        later = F.col("account_name").isNotNull() if name is None else F.coalesce(F.col("account_name") > name, F.lit(False))
        rows = rows.where((F.col("inferred_brand") > brand) | ((F.col("inferred_brand") == brand) & (later | (same_name & (F.col("email") > email)))))
    return rows.join(sent, "_email", "left_anti").drop("_email").orderBy("inferred_brand", F.col("account_name").asc_nulls_first(), "email").limit(limit)


def sent_rows(batch: DataFrame, system: str, status: str, as_of: Column) -> DataFrame:
    """Ledger rows of a batch that was handed over, in the form of sync_status."""
    return batch.select(F.lit(system).alias("target_system"), F.lit("subscriber").alias("source_record_type"), norm_key(F.col("email")).alias("source_record_id"), F.lit(status).alias("sync_status"), as_of.alias("last_synced_at"), as_of.alias("updated_at"))


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with a row number from 0 in the order of a column, equal values in the order of a hash of the row.

    Rows are sorted in ranges of the order, each range a task; what ranges before hold is added from their counts. The ranges are
    written once, so that places and counts come from one and the same sort.
    """
    tie = F.xxhash64(*df.columns)
    placed = df.withColumn("_tie", tie).repartitionByRange(order, "_tie").sortWithinPartitions(order, "_tie").drop("_tie")
    placed = store.staged(placed.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place")), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = placed.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_offset") + F.col("_place")).drop("_range", "_offset", "_place")


def export_payload(audience_rows: DataFrame, fields: Sequence[tuple[str, str]], batch: int = 100) -> DataFrame:
    """Batches of subscriber records as JSON, numbered in order of e-mail: address, name and custom fields as key and value."""
    custom = F.array(*[F.struct(F.lit(key).alias("key"), F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")) for key, column in fields])
    rows = numbered(audience_rows, "email", "number").withColumn("batch", F.floor(F.col("number") / batch))
    return rows.select("batch", "email", F.to_json(F.struct(F.col("email").alias("address"), F.col("display_name").alias("name"), custom.alias("fields"))).alias("payload"))
