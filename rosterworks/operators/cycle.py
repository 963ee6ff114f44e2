"""One cycle of work over whole tables: seed, claim, visit, validate, enrich, extract, settle, log and count.

The batch that a cycle claims is bounded by its sizes, so a cycle works on rows of the claimed accounts alone and
gives back changed rows; whole tables are touched where those are merged and where the snapshot is counted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions.exprs import host_of, stable_id
from ..sources import store
from ..sources.schemas import KEYS
from . import classify, enrich, merge, people, report, validate, work
from .pages import fetch_outcome, page_features, people_pages, same_site_links, site_pages

#: How sure a website is on which a page was read.
HOME_CONFIDENCE = 0.95
#: Why an item goes back when none of its account's pages could be read.
NO_PAGES = "no_public_html"
PAUSE_MINUTES = 30


def seeded(accounts: DataFrame, items: DataFrame, as_of: Column) -> DataFrame:
    """items with a pending one for every account and task that has none; ids of both kinds as text."""
    fresh = work.seed_items(work.seeds(accounts, as_of), items, as_of)
    return items.withColumn("work_item_id", F.col("work_item_id").cast("string")).unionByName(fresh, allowMissingColumns=True)


def preview(items: DataFrame, sizes: Mapping[str, int] = params.BATCHES, as_of: Column | None = None) -> DataFrame:
    """What a cycle would do, without doing it: per task type the items by status and those that it would claim."""
    as_of = F.current_timestamp() if as_of is None else as_of
    counts = items.groupBy("task_type").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("pending", "in_progress", "completed", "failed")])
    picked = work.batch(items, sizes, as_of).groupBy("task_type").agg(F.count("*").alias("claimable"))
    return counts.join(picked, "task_type", "left").withColumn("claimable", F.coalesce("claimable", F.lit(0)))


def replaced(table: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """The table with changed rows in place of those with their keys."""
    return table.join(changed.select(*keys), keys, "left_anti").unionByName(changed.select(*table.columns))


def _rooted(url: Column) -> Column:
    """A URL whose empty path is "/"."""
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*$"), F.concat(url, F.lit("/"))).otherwise(url)


def visited_pages(accounts: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages on the hosts of accounts (a bounded batch), with account_key and what each visit came to, parsed once."""
    hosts = accounts.select("account_key", F.explode(F.array_distinct(F.array(host_of(F.col("account_key")), host_of(F.coalesce("website_url", "account_key"))))).alias("_host"))
    found = validate.visits(pages.withColumn("_host", host_of(F.col("url"))).join(F.broadcast(hosts), "_host"))
    kept = ("account_key", "status_code", "final_url", "bare", "parsed", "usable", "marker", "html")
    return store.staged(page_features(found, kept), "visited")


def settled(picked: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Claimed items after their work: done where the account had a usable page, else to be tried again after a pause.

    picked: items as they were claimed; outcomes: account_key, fetch_status, reason. The attempt counts in both cases.
    """
    both = picked.join(outcomes, "account_key", "left")
    done = F.coalesce(F.col("fetch_status") == "success", F.lit(False))
    has = lambda c: F.col(c) if c in picked.columns else F.lit(None)
    return both.withColumns(
        {
            "status": F.when(done, "completed").otherwise("retry"),
            "lease_expires_at": F.lit(None).cast(picked.schema["lease_expires_at"].dataType),
            "attempt_count": F.coalesce(has("attempt_count").cast("long"), F.lit(0).cast("long")) + 1,
            "last_attempt_at": as_of,
            "completed_at": F.when(done, as_of),
            "next_attempt_at": F.when(done, F.col("next_attempt_at")).otherwise(as_of + F.make_dt_interval(mins=F.lit(PAUSE_MINUTES))),
            "last_error": F.when(~done, F.coalesce("reason", F.lit(NO_PAGES))),
        }
    ).drop("fetch_status", "reason", "position")


def run_log(items: DataFrame, sizes: Mapping[str, int], as_of: Column) -> DataFrame:
    """A row of the run log for every task type, those without work included; items: settled ones."""
    spark = items.sparkSession
    asked = spark.createDataFrame([(t, int(n)) for t, n in sizes.items()], "task_type string, requested_batch_size long")
    done, failed = F.count_if(F.col("status") == "completed").alias("succeeded_count"), F.count_if(F.col("status") == "retry").alias("failed_count")
    counted = items.groupBy("task_type").agg(F.count("*").alias("claimed_count"), done, failed)
    rows = asked.join(F.broadcast(counted), "task_type", "left").na.fill(0, ["claimed_count", "succeeded_count", "failed_count"])
    none, lost = F.col("claimed_count") == 0, (F.col("claimed_count") > 0) & (F.col("succeeded_count") == 0)
    notes = F.when(none, "nothing to claim").when(F.col("failed_count") > 0, F.concat(F.col("failed_count").cast("string"), F.lit(" without a usable page")))
    return rows.select(
        stable_id(F.col("task_type"), F.date_format(as_of, "yyyy-MM-dd HH:mm:ss")).alias("run_id"), "task_type", "requested_batch_size", "claimed_count", "succeeded_count", "failed_count",
        F.when(lost, "failed").otherwise("completed").alias("run_status"), notes.alias("run_notes"), as_of.alias("started_at"), as_of.alias("completed_at"),
    )


def cycle_changes(accounts: DataFrame, contacts: DataFrame, relationships: DataFrame, items: DataFrame, pages: DataFrame, as_of: Column, sizes: Mapping[str, int] = params.BATCHES, seed: bool = True) -> dict[str, DataFrame]:
    """The rows that one cycle changes or adds in accounts, contacts, relationships and work_items, and its rows of runs.

    pages: page_id, url, status_code, final_url, html of already collected pages. Accounts claimed for validation or a retry are
    classified from their home page, those for enrichment get the best values of their site's pages, those for
    extraction the people on them; a retry also takes over the final URL. All claimed accounts get the fetch state that their
    pages tell; items whose account has no usable page are to be tried again. Columns that a table lacks are left out.
    """
    start = seeded(accounts, items, as_of) if seed else items.withColumn("work_item_id", F.col("work_item_id").cast("string"))
    start = start.withColumns({c: F.lit(None).cast(t) for c, t in (("attempt_count", "long"), ("last_error", "string")) if c not in start.columns})
    picked = store.staged(work.batch(start, sizes, as_of), "picked")
    chosen = lambda *tasks: F.broadcast(picked.where(F.col("task_type").isin(*tasks)).select("account_key").distinct())
    mine = store.staged(accounts.join(F.broadcast(picked.select("account_key").distinct()), "account_key", "left_semi"), "claimed-accounts")
    seen = visited_pages(mine, pages)
    homes = store.staged(validate.home_visits(mine, seen), "homes")
    outcomes = mine.select("account_key").join(fetch_outcome(seen, "account_key", NO_PAGES), "account_key", "left")
    outcomes = store.staged(outcomes.select("account_key", F.coalesce("fetch_status", F.lit("unavailable")).alias("fetch_status"), F.when(F.col("fetch_status").isNull(), NO_PAGES).otherwise(F.col("reason")).alias("reason")), "outcomes")

    # Fetch state of all claimed accounts.
    attempts = outcomes.select("account_key", F.lit(0).cast("long").alias("attempt_id"), as_of.alias("attempted_at"), F.col("fetch_status").alias("status"), "reason")
    known = mine.withColumns({c: F.lit(None).cast(t) for c, t in (("blocked_reason", "string"), ("blocked_attempt_count", "long")) if c not in mine.columns})
    state = work.fetch_transition(known, work.fold_attempts(attempts))
    changed = merge.apply_updates(mine, state, "account_key", {c: merge.overwrite for c in state.columns if c in mine.columns and c != "account_key"})

    # Classes.
    checked = validate.judged(mine.join(chosen("validate", "retry_blocked"), "account_key", "left_semi"), validate.home_evidence(homes, seen, seen))
    decided = classify.apply_classification(mine.select("account_key", "classification", "classification_confidence"), checked, as_of)
    stamped = [c for c in ("classification", "classification_confidence", "last_checked_at") if c in mine.columns]
    changed = merge.apply_updates(changed, decided.where("last_checked_at IS NOT NULL").select("account_key", *stamped), "account_key", {c: merge.overwrite for c in stamped})

    # Values of the sites' pages: the home page first, then the known paths below it (or below what was resolved).
    usable = homes.where("usable")
    met = seen.where("usable").select(_rooted(F.col("url")).alias("url"), "page_id", "usable", "final_url")
    ordered = usable.select("account_key", F.lit(-1).alias("page_ord"), "page_id", F.col("source_url").alias("final_url"))
    ordered = ordered.unionByName(site_pages(homes.select("account_key", F.col("source_url").alias("home")), met).select("account_key", "page_ord", "page_id", "final_url"))
    once = ordered.groupBy("account_key", "final_url").agg(F.min(F.struct("page_ord", "page_id")).alias("p")).select("account_key", "p.*").join(chosen("enrich"), "account_key", "left_semi")
    valued = once.join(seen.drop("account_key", "url").withColumnRenamed("final_url", "url"), "page_id").withColumn("name", enrich.page_name(F.col("json_ld"), F.col("og_site_name"), F.col("title")))
    brand = enrich.page_brand(F.col("name.value"), F.col("title"), F.col("og_site_name"), F.col("meta_description"), F.col("url"))
    found = enrich.best_values(valued.withColumns({"brand": brand, "place": enrich.page_place(F.col("json_ld"), F.col("html"))}))
    wanted = {"name_confidence": "double", "brand_confidence": "double", "location_confidence": "double", "confidence_score": "double", "website_confidence_score": "double", "website_source_url": "string", "source_type": "string"}
    given = {c: F.lit(0.0 if t == "double" else None).cast(t) for c, t in wanted.items() if c not in changed.columns}
    first = valued.groupBy("account_key").agg(F.min_by("url", "page_ord").alias("website_url")).withColumn("website_confidence_score", F.lit(HOME_CONFIDENCE))
    changed = enrich.apply_enrichment(changed.withColumns(given), found, first).drop(*given)

    # A retry takes over where the home page has moved to.
    moved = usable.join(chosen("retry_blocked"), "account_key", "left_semi").select("account_key", F.col("source_url").alias("website_url"))
    changed = merge.apply_updates(changed, moved, "account_key", {"website_url": merge.overwrite})

    # People: pages that may list them, linked from the home page or guessed below it, and the home page itself.
    links = usable.join(seen.select("page_id", "anchors"), "page_id").select("page_id", F.col("source_url").alias("url"), F.explode("anchors").alias("a")).select("page_id", "url", "a.*")
    listed = people_pages(same_site_links(links), homes.select(F.col("source_url").alias("url")).distinct())
    listed = homes.select("account_key", F.col("source_url").alias("url")).join(listed.select("url", "target", "rank"), "url").select("account_key", F.col("rank").alias("page_ord"), _rooted(F.col("target")).alias("url"))
    reached = listed.join(met, "url").select("account_key", "page_ord", "page_id", "final_url").unionByName(usable.select("account_key", F.lit(0).alias("page_ord"), "page_id", F.col("source_url").alias("final_url")))
    reached = reached.groupBy("account_key", "final_url").agg(F.min(F.struct("page_ord", "page_id")).alias("p")).select("account_key", "p.*")
    on_pages = reached.join(chosen("extract_contacts"), "account_key", "left_semi").join(seen.select("page_id", F.col("final_url").alias("url"), "email_contexts", "text"), "page_id")
    best = people.best_candidates(people.page_candidates(on_pages, mine))
    fresh = people.as_contacts(best)
    old = contacts.join(F.broadcast(fresh.select("contact_id").distinct()), "contact_id", "left_semi")
    new_contacts = merge.merge_web_contacts(old, fresh, as_of)
    bonds = people.as_relationships(best, as_of)
    old_bonds = relationships.join(F.broadcast(bonds.select("relationship_id")), "relationship_id", "left_semi")
    new_bonds = merge.merge_upsert(old_bonds, bonds, ["relationship_id"], {k: r for k, r in merge.RELATIONSHIP_RULES.items() if k in relationships.columns})

    done = store.staged(settled(picked, outcomes, as_of), "settled")
    untouched = start.join(items.select(F.col("work_item_id").cast("string").alias("work_item_id")), "work_item_id", "left_anti").join(F.broadcast(picked.select("work_item_id")), "work_item_id", "left_anti")
    return {"accounts": changed, "contacts": new_contacts, "relationships": new_bonds, "work_items": done.unionByName(untouched, allowMissingColumns=True) if seed else done, "runs": run_log(done, sizes, as_of)}


def run_cycle(accounts: DataFrame, contacts: DataFrame, relationships: DataFrame, items: DataFrame, pages: DataFrame, as_of: Column, sizes: Mapping[str, int] = params.BATCHES, seed: bool = True) -> dict[str, DataFrame]:
    """The tables after one cycle, the run log's new rows and the snapshot row; see :func:`cycle_changes`."""
    changes = cycle_changes(accounts, contacts, relationships, items, pages, as_of, sizes, seed)
    items = items.withColumn("work_item_id", F.col("work_item_id").cast("string"))
    items = items.withColumns({c: F.lit(None).cast(t) for c, t in changes["work_items"].dtypes if c not in items.columns})
    after = {
        "accounts": replaced(accounts, changes["accounts"], ["account_key"]),
        "contacts": replaced(contacts, changes["contacts"], ["contact_id"]),
        "relationships": replaced(relationships, changes["relationships"], ["relationship_id"]),
        "work_items": replaced(items, changes["work_items"], ["work_item_id"]),
    }
    return {**after, "runs": changes["runs"], "snapshot": report.snapshot_row(*after.values(), as_of)}


def write_cycle(spark: SparkSession, folder: str, pages: DataFrame, as_of: Column, sizes: Mapping[str, int] = params.BATCHES, parts: int = store.PARTS) -> dict[str, dict[str, int]]:
    """One cycle over the tables below ``folder``: merges its changes into them, appends to the run log and the snapshots.

    Returns for each table how many rows its write inserted, updated and kept. A cycle that is run again with the same
    clock finds its items claimed and settled, and adds runs under the same ids.
    """
    tables = {t: store.read(spark, folder, t).drop(store.PART) for t in ("accounts", "contacts", "relationships", "work_items")}
    changes = cycle_changes(tables["accounts"], tables["contacts"], tables["relationships"], tables["work_items"], pages, as_of, sizes)
    changes = {t: store.staged(rows, f"{t}-changes") for t, rows in changes.items()}  # they read what is about to be rewritten
    keys = {t: ["work_item_id"] if t == "work_items" else list(KEYS[t]) for t in tables}
    counts = {t: store.upsert(folder, t, changes[t], keys=keys[t], parts=parts) for t in tables}
    counts["runs"] = {"inserted": store.append(folder, "runs", changes["runs"])}
    now = {t: store.read(spark, folder, t).drop(store.PART) for t in tables}
    row = report.snapshot_row(now["accounts"], now["contacts"], now["relationships"], now["work_items"], as_of)
    snapshot = row.select(stable_id(F.date_format(as_of, "yyyy-MM-dd HH:mm:ss")).alias("snapshot_id"), "*", as_of.alias("created_at"))
    counts["snapshots"] = {"inserted": store.append(folder, "snapshots", snapshot)}
    return counts
