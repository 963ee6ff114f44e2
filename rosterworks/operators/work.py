"""Due work: seeding, reopening, picking batches and moving items on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.exprs import any_of, cooldown_over, is_blank, stable_id
from .ranking import top_per_key


def not_personal() -> Column:
    return ~F.coalesce("is_personal_domain", F.lit(False))


def in_target(classes: Sequence[str] = params.TARGET_CLASSES) -> Column:
    return F.coalesce(F.col("classification").isin(*classes), F.lit(False))


def missing_field() -> Column:
    """Any of website, name, brand blank, or city or state null."""
    return any_of([is_blank(F.col(c)) for c in ("website_url", "account_name", "inferred_brand")]) | F.col("account_city").isNull() | F.col("account_state").isNull()


def retry_due(as_of: Column) -> Column:
    return in_target() & (F.coalesce("fetch_status", F.lit("")) == "blocked") & cooldown_over(F.col("last_fetch_attempt_at"), F.col("blocked_attempt_count"), as_of)


def seeds(accounts: DataFrame, as_of: Column) -> DataFrame:
    """task_type, account_key, priority of all work that accounts call for: one scan, one row per account and task."""
    wanted = {"validate": not_personal(), "enrich": in_target() & missing_field(), "extract_contacts": in_target() & ~is_blank(F.col("website_url")), "retry_blocked": retry_due(as_of)}
    options = [F.when(condition, F.struct(F.lit(task).alias("task_type"), F.lit(params.TASKS[task]).cast("long").alias("priority"))) for task, condition in wanted.items()]
    return accounts.select("account_key", F.explode(F.array_compact(F.array(*options))).alias("w")).select("w.task_type", "account_key", "w.priority")


def seed_items(source: DataFrame, items: DataFrame, as_of: Column) -> DataFrame:
    """New pending items for seeds that have no item yet; their ids follow from task and account."""
    fresh = source.join(items, ["task_type", "account_key"], "left_anti")
    return fresh.select(stable_id(F.col("task_type"), F.col("account_key")).alias("work_item_id"), "task_type", "account_key", F.lit("pending").alias("status"), "priority", F.lit(0).cast("long").alias("attempt_count"), as_of.alias("next_attempt_at"), as_of.alias("created_at"))


def reopen(items: DataFrame, source: DataFrame, as_of: Column, reseed: Sequence[str] = ("retry_blocked",)) -> DataFrame:
    """items (task_type, account_key, status, priority, next_attempt_at, lease_expires_at) after seeds
    came again: finished ones of the task types in ``reseed`` are pending and those in retry due now;
    unknown ones of any type are added."""
    seed = source.select("task_type", "account_key", F.col("priority").alias("new_priority"))
    both = items.join(seed, ["task_type", "account_key"], "full_outer")
    seen, again = F.col("status").isNotNull(), F.col("new_priority").isNotNull() & F.col("task_type").isin(*reseed)
    finished, retry = again & F.col("status").isin("completed", "failed"), again & (F.col("status") == "retry")
    return both.select(
        "task_type",
        "account_key",
        F.when(~seen | finished, "pending").otherwise(F.col("status")).alias("status"),
        F.when(~seen | finished | retry, F.col("new_priority")).otherwise(F.col("priority")).alias("priority"),
        F.when(~seen | finished | retry, as_of).otherwise(F.col("next_attempt_at")).alias("next_attempt_at"),
        F.when(~finished, F.col("lease_expires_at")).alias("lease_expires_at"),
    )


def claimable(as_of: Column, reclaim_expired: bool = True) -> Column:
    """Open, due and not leased; an expired lease counts as none unless ``reclaim_expired`` is off."""
    due = F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= as_of)
    free = F.col("lease_expires_at").isNull() | (F.col("lease_expires_at") < as_of)
    open_now = F.col("status").isin("pending", "retry")
    if reclaim_expired:
        open_now = open_now | ((F.col("status") == "in_progress") & F.col("lease_expires_at").isNotNull() & (F.col("lease_expires_at") < as_of))
    return open_now & due & free


def batch(items: DataFrame, size: int | Mapping[str, int], as_of: Column, reclaim_expired: bool = True) -> DataFrame:
    """The next ``size`` items of every task type in one pass: by priority, age and id.

    With a mapping every task type has a size of its own, 0 if it is not listed. The ranking is cut at the largest size,
    a constant, so that no task type is sorted whole in one task.
    """
    open_items = items.where(claimable(as_of, reclaim_expired))
    order = [F.col("priority").desc(), F.col("created_at").asc_nulls_first(), F.col("work_item_id")]
    if isinstance(size, int):
        return top_per_key(open_items, ["task_type"], order, size, "position", ["work_item_id"])
    wanted = {t: n for t, n in size.items() if n > 0}
    first = top_per_key(open_items.where(F.col("task_type").isin(*wanted)), ["task_type"], order, max(wanted.values(), default=0), "position", ["work_item_id"])
    return first.where(F.col("position") <= F.coalesce(*[F.when(F.col("task_type") == t, n) for t, n in wanted.items()], F.lit(0)))


def extraction_batch(accounts: DataFrame, relationships: DataFrame, size: int) -> DataFrame:
    """The next accounts whose people are to be looked up: of a target class, with a website, and with
    no relationship that was found on a website; enriched ones first, then resolved ones, the least
    recently verified, the key."""
    found = relationships.where(F.col("source_type") == params.WEB_CONTACTS).select("account_id")
    ready = accounts.where(in_target() & ~is_blank(F.col("website_url"))).join(found, "account_id", "left_anti")
    tier = F.when(F.col("source_type") == "website_enrichment", 0).when(F.col("source_type") == "website_resolution", 1).otherwise(2)
    verified = F.coalesce(F.col("last_verified_at").cast("timestamp_ntz"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return ready.orderBy(tier, verified, "account_key").limit(size)


def claim(items: DataFrame, size: int | Mapping[str, int], as_of: Column, lease_minutes: int = 30) -> DataFrame:
    """items with the next batch in progress, leased and counted as an attempt."""
    picked = batch(items, size, as_of).select("work_item_id", F.lit(True).alias("picked"))
    joined = items.join(picked, "work_item_id", "left")
    hit = F.coalesce("picked", F.lit(False))
    return joined.withColumns({"status": F.when(hit, "in_progress").otherwise(F.col("status")), "lease_expires_at": F.when(hit, as_of + F.make_dt_interval(mins=F.lit(lease_minutes))).otherwise(F.col("lease_expires_at")), "claimed": hit}).drop("picked")


def complete(items: DataFrame, done: DataFrame, as_of: Column) -> DataFrame:
    """items with those whose id is in done completed and their lease gone."""
    joined = items.join(done.select("work_item_id", F.lit(True).alias("hit")), "work_item_id", "left")
    hit = F.coalesce("hit", F.lit(False))
    return joined.withColumns({"status": F.when(hit, "completed").otherwise(F.col("status")), "lease_expires_at": F.when(~hit, F.col("lease_expires_at")), "completed_at": F.when(hit, as_of)}).drop("hit")


def fail(items: DataFrame, failed: DataFrame, as_of: Column, pause_minutes: int = 30, max_attempts: int | None = None) -> DataFrame:
    """items with those in failed (work_item_id, error) back in retry, due after the pause, the error kept.

    With ``max_attempts``, items whose attempt_count has reached it have failed for good.
    """
    joined = items.join(failed.select("work_item_id", F.col("error").alias("last_error"), F.lit(True).alias("hit")), "work_item_id", "left")
    hit = F.coalesce("hit", F.lit(False))
    retry = F.lit("retry") if max_attempts is None else F.when(F.coalesce("attempt_count", F.lit(0)) >= max_attempts, "failed").otherwise("retry")
    return joined.withColumns({"status": F.when(hit, retry).otherwise(F.col("status")), "lease_expires_at": F.when(~hit, F.col("lease_expires_at")), "next_attempt_at": F.when(hit, as_of + F.make_dt_interval(mins=F.lit(pause_minutes))).otherwise(F.col("next_attempt_at"))}).drop("hit")


def fold_attempts(attempts: DataFrame) -> DataFrame:
    """Fetch state per account from its attempts (account_key, attempt_id, attempted_at, status, reason).

    Blocked attempts count and leave their reason, success clears it, others keep it; the last
    status stands.
    """
    at = F.struct("attempted_at", "attempt_id")
    tells = F.col("status").isin("blocked", "success")
    last = F.max(F.when(tells, F.struct("attempted_at", "attempt_id", "status", "reason"))).alias("tell")
    grouped = attempts.groupBy("account_key").agg(
        F.max_by("status", at).alias("fetch_status"), F.count_if(F.col("status") == "blocked").alias("blocked_attempt_count"), F.max("attempted_at").alias("last_fetch_attempt_at"), F.max(F.when(F.col("status") == "success", F.col("attempted_at"))).alias("last_fetch_success_at"), last
    )
    return grouped.select("account_key", "fetch_status", "blocked_attempt_count", "last_fetch_attempt_at", "last_fetch_success_at", F.when(F.col("tell.status") == "blocked", F.col("tell.reason")).alias("blocked_reason"))


def fetch_transition(accounts: DataFrame, folded: DataFrame) -> DataFrame:
    """accounts (account_key, fetch_status, blocked_attempt_count, blocked_reason, ...) after the folded attempts."""
    new = folded.select("account_key", F.struct(*[c for c in folded.columns if c != "account_key"]).alias("n"))
    joined = accounts.join(new, "account_key", "left")
    hit = F.col("n").isNotNull()
    cleared = F.col("n.last_fetch_success_at").isNotNull()
    return joined.select(
        "account_key",
        F.when(hit, F.col("n.fetch_status")).otherwise(F.col("fetch_status")).alias("fetch_status"),
        F.when(hit, F.coalesce("blocked_attempt_count", F.lit(0)) + F.col("n.blocked_attempt_count")).otherwise(F.col("blocked_attempt_count")).alias("blocked_attempt_count"),
        F.when(hit & (F.col("n.blocked_reason").isNotNull() | cleared), F.col("n.blocked_reason")).otherwise(F.col("blocked_reason")).alias("blocked_reason"),
        F.when(hit, F.col("n.last_fetch_attempt_at")).otherwise(F.col("last_fetch_attempt_at")).alias("last_fetch_attempt_at"),
    )


LEASE_MINUTES, PAUSE_MINUTES = 30, 30


def fold_work(events: DataFrame, lease_minutes: int = LEASE_MINUTES, pause_minutes: int = PAUSE_MINUTES) -> DataFrame:
    """The state of each work item from its events (work_item_id, event_id, happened_at, kind, error), in whatever order they come.

    kind: claim, complete or fail; of events at one time the larger id is the later one, and an event that comes twice
    counts once. The last event gives the status. Failures, and the error, are those since the last completion: a
    struct maximum that is joined back, so that both passes combine before their shuffle and no item's events are sorted in one task.
    """
    at = F.struct("happened_at", "event_id")
    once = events.groupBy("work_item_id", "event_id").agg(F.min(F.struct("happened_at", "kind", "error")).alias("e")).select("work_item_id", "event_id", "e.*")
    done = once.where("kind = 'complete'").groupBy("work_item_id").agg(F.max(at).alias("done"))
    both = once.join(done, "work_item_id", "left")
    lost = (F.col("kind") == "fail") & (F.col("done").isNull() | (at > F.col("done")))
    folded = both.groupBy("work_item_id").agg(
        F.max(F.struct("happened_at", "event_id", "kind")).alias("last"),
        F.count_if(F.col("kind") == "claim").alias("attempt_count"),
        F.count_if(lost).alias("failures"),
        F.max_by("error", F.when(lost, at)).alias("last_error"),
        F.max(F.when(F.col("kind") == "claim", F.col("happened_at"))).alias("last_attempt_at"),
        F.max("done.happened_at").alias("completed_at"),
    )
    is_last = lambda kind: F.col("last.kind") == kind
    later = lambda minutes: F.col("last.happened_at") + F.make_dt_interval(mins=F.lit(minutes))
    return folded.select(
        "work_item_id", F.when(is_last("claim"), "in_progress").when(is_last("complete"), "completed").otherwise("retry").alias("status"), "attempt_count", "failures", "last_error", "last_attempt_at", "completed_at",
        F.when(is_last("claim"), later(lease_minutes)).alias("lease_expires_at"), F.when(is_last("fail"), later(pause_minutes)).alias("next_attempt_at"),
    )


def work_transition(items: DataFrame, folded: DataFrame) -> DataFrame:
    """items after folded events: one left join; attempts add up, items without events stay."""
    new = folded.select("work_item_id", F.struct(*[c for c in folded.columns if c != "work_item_id"]).alias("n"))
    joined, hit = items.join(new, "work_item_id", "left"), F.col("n").isNotNull()
    put = {c: F.when(hit, F.col(f"n.{c}")).otherwise(F.col(c)) for c in ("status", "lease_expires_at", "last_error", "completed_at", "last_attempt_at", "next_attempt_at") if c in items.columns}
    if "attempt_count" in items.columns:
        put["attempt_count"] = F.coalesce("attempt_count", F.lit(0)) + F.coalesce("n.attempt_count", F.lit(0))
    return joined.select(*[put.get(c, F.col(c)).alias(c) for c in items.columns])
