"""Tables merged by partition, generations of files, bounded batches, validation and the cycle's branches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rosterworks import params
from rosterworks.operators import cycle as Y
from rosterworks.operators import rollups as U
from rosterworks.operators import validate as V
from rosterworks.operators import work as W
from rosterworks.operators.ranking import top_per_key
from rosterworks.plans import cycle as PC
from rosterworks.sources import store
from rosterworks.sources.schemas import SCHEMAS
from rosterworks.sources.views import view
from rosterworks.streaming import incremental as I

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="module")
def clock(spark):
    globals()["NOW"] = F.expr("TIMESTAMP_NTZ '2001-07-01 12:00:00'")


def files(folder):
    return {os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def rows(frame):
    return sorted(map(str, frame.collect()))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Store -------------------------------------------------------------------------------------------


def test_upsert_counts_and_partitions(spark, tmp_path):
    folder = str(tmp_path)
    first = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("contact_id"), F.lit("old").alias("full_name"))
    assert store.upsert(folder, "contacts", first, parts=16) == {"inserted": 1000, "updated": 0, "kept": 0, "partitions": 16}
    before = files(folder)
    second = spark.createDataFrame([("k1", "new"), ("k2", "new"), ("x1", "new")], "contact_id string, full_name string")
    touched = {r[0] for r in second.select(store.part_of(["contact_id"], 16)).collect()}
    inside = store.read(spark, folder, "contacts").where(F.col(store.PART).isin(*touched)).count()
    got = store.upsert(folder, "contacts", second, parts=16)
    assert got == {"inserted": 1, "updated": 2, "kept": inside - 2, "partitions": len(touched)}
    changed = before ^ files(folder)
    assert changed and all(any(f"{store.PART}={p}/" in f for p in touched) for f in changed)
    table = store.read(spark, folder, "contacts")
    assert table.count() == 1001 and table.where("full_name = 'new'").count() == 3
    after = rows(table)
    assert store.upsert(folder, "contacts", second, parts=16)["updated"] == 3
    assert rows(store.read(spark, folder, "contacts")) == after


def test_empty_batch_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "contact_id string")
    assert store.upsert(str(tmp_path), "contacts", empty) == {"inserted": 0, "updated": 0, "kept": 0, "partitions": 0}
    assert files(tmp_path) == set() and store.read(spark, str(tmp_path), "contacts").count() == 0


def test_two_generations_of_files(spark, tmp_path):
    """Files without later columns, and with a narrower number, are read and merged together with new ones."""
    folder = str(tmp_path)
    old = spark.createDataFrame([("a", "validate", 1), ("b", "enrich", 2)], "work_item_id string, task_type string, priority int").withColumn(store.PART, store.part_of(["work_item_id"], 4))
    old.write.partitionBy(store.PART).parquet(f"{folder}/work_items")
    fresh = spark.createDataFrame([("b", "enrich", "k", 5), ("c", "enrich", "k", 7)], "work_item_id string, task_type string, account_key string, priority long")
    counts = store.upsert(folder, "work_items", fresh, keys=["work_item_id"], parts=4)
    assert (counts["inserted"], counts["updated"]) == (1, 1)
    table = store.read(spark, folder, "work_items")
    assert [f.name for f in table.schema] == [*(f.name for f in SCHEMAS["work_items"]), store.PART]
    assert {(r.work_item_id, r.account_key, r.priority) for r in table.collect()} == {("a", None, 1), ("b", "k", 5), ("c", "k", 7)}


def test_stream_rewrites_touched_partitions_alone(spark, tmp_path):
    raw, folder = view(spark, ROOT, "contact_master"), str(tmp_path / "tables")
    merge = I.merge_batch(folder, NOW, parts=32)
    merge(raw, 0)
    keys = [r.email for r in raw.select("email").distinct().orderBy("email").limit(2).collect()]
    few, before = raw.where(F.col("email").isin(*keys)), files(f"{folder}/contacts")
    table = rows(I.current(spark, folder, "contacts"))
    counts = merge(few, 1)
    ids = U.contact_rollup(U.normalized(few, NOW), NOW).select("contact_id")
    touched = {r[0] for r in ids.select(store.part_of(["contact_id"], 32)).collect()}
    assert counts["contacts"]["partitions"] == len(touched) < 4
    assert all(any(f"{store.PART}={p}/" in f for p in touched) for f in before ^ files(f"{folder}/contacts"))
    assert rows(I.current(spark, folder, "contacts")) == table
    state = files(folder)
    assert merge(few, 1) == {} and files(folder) == state


# Batches -----------------------------------------------------------------------------------------


def test_batches_cut_before_the_shuffle(spark):
    items = view(spark, ROOT, "work_items")
    for size in (5, {"validate": 3, "enrich": 7, "retry_blocked": 0}):
        batch = W.batch(items, size, NOW)
        assert plan(batch).count("WindowGroupLimit") == 2
        most = {t: size if isinstance(size, int) else size.get(t, 0) for t in params.TASKS}
        due = items.where(W.claimable(NOW)).collect()
        want = set()
        for task, n in most.items():
            mine = [r for r in due if r.task_type == task]
            want |= {r.work_item_id for r in sorted(mine, key=lambda r: (-r.priority, r.created_at, r.work_item_id))[:n]}
        assert {r.work_item_id for r in batch.collect()} == want


def test_large_limits_are_cut_by_deals_first(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id"), F.xxhash64("id").alias("v"))
    got = top_per_key(df, ["k"], [F.desc("v"), F.asc("id")], 3000, "place", ["id"])
    assert plan(got).count("Window") >= 2
    want = sorted(df.collect(), key=lambda r: (r.k, -r.v, r.id))
    want = [(k, r.id, place) for k in (0, 1) for place, r in enumerate([r for r in want if r.k == k][:3000], 1)]
    assert sorted((r.k, r.id, r.place) for r in got.collect()) == sorted(want)


# Validation --------------------------------------------------------------------------------------

HOME = "<title>Welcome</title><p>Vehicles of all kinds</p>"


def judge(spark, pages, key="shop.example.net", website=None):
    accounts = spark.createDataFrame([(key, None, None, website)], "account_key string, account_name string, inferred_brand string, website_url string")
    frame = spark.createDataFrame(pages, "page_id long, url string, status_code int, final_url string, html string")
    return V.validate(accounts, frame).first()


def test_first_usable_page_speaks(spark):
    pages = [(1, "https://shop.example.net", 403, None, "<p>Access Denied</p>"), (2, "http://www.shop.example.net/", 200, "http://www.shop.example.net/honda/", HOME)]
    got = judge(spark, pages)
    assert got.source_url == "http://www.shop.example.net/honda/"
    assert judge(spark, pages[:1]).source_url == "https://shop.example.net"
    assert judge(spark, [(3, "https://elsewhere.example/", 200, None, HOME)]).source_url == "https://shop.example.net"
    assert judge(spark, pages, website="http://www.shop.example.net").source_url == "http://www.shop.example.net/honda/"


@pytest.mark.parametrize(("path", "rule"), [("honda/", 10), ("autos/", 11)])
def test_refused_sites_with_stock(spark, path, rule):
    base = f"https://shop.example.net/{path}"
    pages = [(1, "https://shop.example.net/", 403, base, "<p>Access Denied. Vehicles of all kinds</p>"), (2, f"{base}new-inventory", 403, None, None)]
    assert judge(spark, pages).rule_id == rule
    assert judge(spark, pages[:1]).rule_id != rule


def test_stock_links_stay_on_the_site(spark):
    page = lambda href: [(1, "https://shop.example.net/", 200, "https://shop.example.net/ford/", f'{HOME}<a href="{href}">New inventory</a>')]
    assert judge(spark, page("/inventory")).rule_id == 12
    assert judge(spark, page("https://other.example/inventory")).rule_id != 12


def test_rules_of_refused_sites_in_the_view(spark):
    seen = {r[0] for r in PC.site_validation(spark, "/root/testdata/sf0.01").select("rule_id").distinct().collect()}
    assert {10, 11} <= seen and len(seen) >= 8


def test_validation_parses_chosen_pages_once(spark):
    frame = V.validate(view(spark, ROOT, "accounts"), PC.pages(spark, ROOT))
    assert plan(frame).count("MapInPandas") == 1


# Cycle -------------------------------------------------------------------------------------------


def tables(spark):
    contacts = view(spark, ROOT, "contacts").withColumns({c: F.lit(None).cast("string") for c in ("role_type", "source_url", "source_type")})
    return [view(spark, ROOT, "accounts"), contacts, view(spark, ROOT, "relationships"), view(spark, ROOT, "work_items")]


def test_items_without_pages_are_tried_again(spark):
    """No page at all: everything claimed goes to retry with a reason, the accounts are unavailable, the log says failed."""
    after = Y.run_cycle(*tables(spark), PC.pages(spark, ROOT).where("false"), NOW, {"validate": 3, "enrich": 2})
    items = after["work_items"].where("last_error IS NOT NULL").collect()
    assert len(items) == 5 and {(r.status, r.last_error, r.attempt_count, r.lease_expires_at) for r in items} == {("retry", "no_public_html", 1, None)}
    assert {r.next_attempt_at for r in items} == {dt.datetime(2001, 7, 1, 12, 30)}
    keys = {r.account_key for r in items}
    assert {r.fetch_status for r in after["accounts"].where(F.col("account_key").isin(*keys)).collect()} == {"unavailable"}
    assert {(r.task_type, r.run_status, r.failed_count) for r in after["runs"].collect()} == {("validate", "failed", 3), ("enrich", "failed", 2)}


def test_claimed_items_are_not_claimed_again_before_their_pause(spark):
    accounts, contacts, bonds, items = tables(spark)
    after = Y.run_cycle(accounts, contacts, bonds, items, PC.pages(spark, ROOT).where("false"), NOW, {"validate": 3})
    lost = {r.work_item_id for r in after["work_items"].where("last_error IS NOT NULL").collect()}
    again = {r.work_item_id for r in W.batch(after["work_items"], {"validate": 3}, NOW).collect()}
    later = {r.work_item_id for r in W.batch(after["work_items"], {"validate": 1000}, F.expr("TIMESTAMP_NTZ '2001-07-01 12:30:00'")).collect()}
    assert not lost & again and lost <= later


def test_written_cycle(spark, tmp_path):
    """Two cycles over written tables: counts of the writes equal a recount, the second claims other items."""
    folder, names = str(tmp_path), ("accounts", "contacts", "relationships", "work_items")
    accounts, contacts, bonds, items = tables(spark)
    first = dict(zip(names, (accounts, contacts, bonds, items.withColumn("work_item_id", F.col("work_item_id").cast("string"))), strict=True))
    key = {"accounts": "account_id", "contacts": "contact_id", "relationships": "relationship_id", "work_items": "work_item_id"}
    for name, frame in first.items():
        store.upsert(folder, name, frame, keys=[key[name]], parts=4)
    now = F.expr("TIMESTAMP '2001-07-01 12:00:00'")
    before = {n: store.read(spark, folder, n).count() for n in names}
    counts = Y.write_cycle(spark, folder, PC.pages(spark, ROOT), now, parts=4)
    for name in names:
        assert store.read(spark, folder, name).count() == before[name] + counts[name]["inserted"]
    assert counts["runs"] == {"inserted": 4} and counts["snapshots"] == {"inserted": 1}
    runs = store.read(spark, folder, "runs").collect()
    assert sum(r.claimed_count for r in runs) == sum(r.succeeded_count + r.failed_count for r in runs) > 0
    done = {r.work_item_id for r in store.read(spark, folder, "work_items").where("attempt_count = 1").collect()}
    assert len(done) == sum(r.claimed_count for r in runs)
    Y.write_cycle(spark, folder, PC.pages(spark, ROOT), F.expr("TIMESTAMP '2001-07-01 12:10:00'"), parts=4)
    assert {r.work_item_id for r in store.read(spark, folder, "work_items").where("attempt_count > 1").collect()} == set()
    assert store.read(spark, folder, "snapshots").count() == 2
