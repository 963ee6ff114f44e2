"""Properties of merges, cooldowns, sparklines and the stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterworks.functions import exprs as X
from rosterworks.operators import merge as M
from rosterworks.operators import report as R
from rosterworks.operators import rollups as U
from rosterworks.operators import work as W
from rosterworks.sources import schemas as S
from rosterworks.sources.views import view
from rosterworks.streaming import incremental as I

ROOT = "/root/testdata/sf0.001"
@pytest.fixture(autouse=True, scope="module")
def clock(spark):
    globals()["NOW"] = F.expr("TIMESTAMP_NTZ '2001-07-01 12:00:00'")


def rows(frame):
    return sorted(map(str, frame.collect()))


def batches(spark):
    every = U.normalized(view(spark, ROOT, "contact_master"), NOW)
    number = F.substring("contact_id", 2, 20).cast("long")
    return U.account_rollup(every.where(number % 2 == 0), NOW), U.account_rollup(every.where(number % 2 == 1), NOW)


def test_merge_is_idempotent(spark):
    a, b = batches(spark)
    once = M.merge_upsert(a, b, ["account_id"], M.ACCOUNT_RULES)
    assert rows(M.merge_upsert(once, b, ["account_id"], M.ACCOUNT_RULES)) == rows(once)
    assert S.bad_keys(once, ["account_id"]).count() == 0


def test_commuting_columns(spark):
    a, b = batches(spark)
    keep = ["account_id", "confidence_score", "is_personal_domain", "first_seen_at", "last_seen_at"]
    ab, ba = (M.merge_upsert(x, y, ["account_id"], M.ACCOUNT_RULES).select(*keep) for x, y in ((a, b), (b, a)))
    assert rows(ab) == rows(ba)


def test_merge_tags_and_counts(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    s = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    got = {r.k: (r.v, r.how) for r in M.merge_upsert(t, s, ["k"], {"v": M.overwrite}, tag="how").collect()}
    assert got == {1: ("a", "keep"), 2: ("c", "update"), 3: ("d", "insert")}
    assert tuple(M.merge_counts(t, s, ["k"]).first()) == (1, 1, 1)
    assert {r.k for r in M.insert_missing(t, s, ["k"]).collect()} == {1, 2, 3}


def test_suppressed_stays(spark):
    target = spark.createDataFrame([("c", "Suppressed", 0.1)], "contact_id string, contact_status string, confidence_score double")
    found = spark.createDataFrame([("c", "N", 0.9, 1)], "contact_id string, full_name string, confidence_score double, seq int")
    assert M.merge_web_contacts(target, found, NOW).first().contact_status == "Suppressed"


@pytest.mark.parametrize(("attempts", "hours"), [(None, 6), (1, 6), (2, 24), (3, 24), (4, 72)])
def test_cooldown(spark, attempts, hours):
    last = dt.datetime(2020, 1, 1)
    frame = spark.createDataFrame([(last, attempts)], "t timestamp_ntz, n long")
    for offset, due in ((0, True), (-1, False)):
        at = F.lit(last + dt.timedelta(hours=hours, seconds=offset)).cast("timestamp_ntz")
        assert frame.select(X.cooldown_over(F.col("t"), F.col("n"), at)).first()[0] is due


def test_attempts_fold(spark):
    t = lambda k: dt.datetime(2020, 1, 1, k)
    schema = "account_key string, attempt_id long, attempted_at timestamp_ntz, status string, reason string"
    known = spark.createDataFrame([("a", "blocked", 2, "captcha", t(0))], "account_key string, fetch_status string, blocked_attempt_count long, blocked_reason string, last_fetch_attempt_at timestamp_ntz")
    steps = [("blocked", "access denied"), ("success", None), ("unavailable", "x")]
    expected = [("blocked", 3, "access denied"), ("success", 2, None), ("unavailable", 2, "captcha")]
    for (status, reason), want in zip(steps, expected, strict=True):
        folded = W.fold_attempts(spark.createDataFrame([("a", 1, t(1), status, reason)], schema))
        row = W.fetch_transition(known, folded).first()
        assert (row.fetch_status, row.blocked_attempt_count, row.blocked_reason) == want


def test_sparklines(spark):
    frame = spark.createDataFrame([([5],), ([1, 3, 2],)], "v array<long>")
    assert [r[0] for r in frame.select(R.sparkline(F.col("v"))).collect()] == ["0,30 100,30", "0.0,30.0 50.0,6.0 100.0,18.0"]


def test_schemas(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert S.read_or_empty(spark, path, "runs").count() == 0
    S.append_rows(spark.createDataFrame([("r1", "enrich")], "run_id string, task_type string"), path, "runs")
    assert S.read_or_empty(spark, path, "runs").first().task_type == "enrich"
    assert {t: len(s) for t, s in S.SCHEMAS.items()} == {"accounts": 36, "contacts": 21, "relationships": 14, "sync_status": 10, "work_items": 14, "runs": 13, "snapshots": 16}


def test_stream_equals_batch(spark, tmp_path):
    raw = view(spark, ROOT, "contact_master")
    landing, folder = str(tmp_path / "landing"), str(tmp_path / "tables")
    raw.where("CAST(substring(contact_id, 2) AS BIGINT) % 2 = 0").coalesce(1).write.mode("append").parquet(landing)
    I.normalize_landed(spark, landing, folder, raw.schema, NOW).awaitTermination()
    raw.where("CAST(substring(contact_id, 2) AS BIGINT) % 2 = 1").coalesce(1).write.mode("append").parquet(landing)
    I.normalize_landed(spark, landing, folder, raw.schema, NOW).awaitTermination()
    keep = ["account_id", "confidence_score", "first_seen_at", "last_seen_at", "is_personal_domain"]
    whole = U.account_rollup(U.normalized(raw, NOW), NOW).select(*keep)
    assert rows(I.current(spark, folder, "accounts").select(*keep)) == rows(whole)
    before = rows(I.current(spark, folder, "accounts"))
    I.normalize_landed(spark, landing, folder, raw.schema, NOW).awaitTermination()
    assert rows(I.current(spark, folder, "accounts")) == before


def test_running_status_stream(spark, tmp_path):
    attempts = view(spark, ROOT, "attempts")
    attempts.coalesce(2).write.parquet(str(tmp_path / "a"))
    stream = I.running_status(spark.readStream.schema(attempts.schema).parquet(str(tmp_path / "a")))
    running = stream.writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start()
    running.awaitTermination()
    want = W.fold_attempts(attempts).select("account_key", "fetch_status", "blocked_attempt_count", "last_fetch_attempt_at")
    assert rows(spark.table("running")) == rows(want)
