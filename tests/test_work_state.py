"""Work events folded in batch and as a stream, in any order."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rosterworks.operators import work as W
from rosterworks.sources.views import view
from rosterworks.streaming import work_state as S

ROOT = "/root/testdata/sf0.001"
EVENTS = "work_item_id string, event_id long, happened_at timestamp, kind string, error string"
COLUMNS = ["work_item_id", "status", "attempt_count", "failures", "last_error", "last_attempt_at", "completed_at", "lease_expires_at", "next_attempt_at"]


def plain(rows):
    """Each item's events in order, one after the other."""
    out = {}
    for item in {r[0] for r in rows}:
        state = {"status": None, "attempts": 0, "failures": 0, "error": None}
        for _, _, at, kind, error in sorted({r[1]: r for r in rows if r[0] == item}.values(), key=lambda r: (r[2], r[1])):
            if kind == "claim":
                state |= {"status": "in_progress", "attempts": state["attempts"] + 1}
            elif kind == "complete":
                state |= {"status": "completed", "failures": 0, "error": None}
            else:
                state |= {"status": "retry", "failures": state["failures"] + 1, "error": error}
        out[item] = (state["status"], state["attempts"], state["failures"], state["error"])
    return out


def made(n=400, seed=3):
    draw = random.Random(seed)
    start = pd.Timestamp("2020-01-01")
    rows = []
    for k in range(n):
        kind = draw.choice(["claim", "claim", "fail", "complete"])
        rows.append((f"w{draw.randrange(12)}", k, (start + pd.Timedelta(minutes=draw.randrange(200))).to_pydatetime(), kind, f"e{k % 5}" if kind == "fail" else None))
    draw.shuffle(rows)
    return rows + rows[:20]


def test_fold_equals_replay(spark):
    rows = made()
    got = {r.work_item_id: (r.status, r.attempt_count, r.failures, r.last_error) for r in W.fold_work(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got == plain(rows)


def test_transition_keeps_items_without_events(spark):
    items = spark.createDataFrame([("a", "pending", 2), ("b", "pending", None)], "work_item_id string, status string, attempt_count long")
    folded = W.fold_work(spark.createDataFrame([("b", 1, pd.Timestamp("2020-01-01").to_pydatetime(), "claim", None)], EVENTS))
    assert sorted(tuple(r) for r in W.work_transition(items, folded).collect()) == [("a", "pending", 2), ("b", "in_progress", 1)]


@pytest.fixture
def rocks(spark):
    for k, v in S.PROVIDER.items():
        spark.conf.set(k, v)
    yield spark
    for k in S.PROVIDER:
        spark.conf.unset(k)


def run(spark, folder, schema, name):
    stream = S.work_states(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder))
    got = []
    stream.writeStream.outputMode("update").foreachBatch(lambda df, k: got.extend((k, *r) for r in df.collect())).option("checkpointLocation", f"{folder}_{name}").trigger(availableNow=True).start().awaitTermination()
    return got


def test_stream_equals_batch_out_of_order(rocks, tmp_path):
    """Events in shuffled files, some twice: the latest row of each item is that of the batch fold."""
    spark, rows, folder = rocks, made(), str(tmp_path / "events")
    for k in range(3):
        spark.createDataFrame(rows[k::3], EVENTS).coalesce(1).write.mode("append").parquet(folder)
    got = run(spark, folder, EVENTS, "one")
    last = {}
    for _, *row in got:
        last[row[0]] = tuple(row[:9])
    want = {r.work_item_id: tuple(r) for r in W.fold_work(spark.createDataFrame(rows, EVENTS)).select(*COLUMNS).collect()}
    assert last == want


def test_timers_tell_what_is_due(rocks, tmp_path):
    """A lease and a pause that run out are told once the watermark has passed them; a completed item is never due."""
    spark, folder = rocks, str(tmp_path / "events")
    at = lambda day, minute=0: (pd.Timestamp("2020-01-01") + pd.Timedelta(days=day, minutes=minute)).to_pydatetime()
    first = [("leased", 1, at(0), "claim", None), ("failed", 2, at(0), "claim", None), ("failed", 3, at(0, 5), "fail", "x"), ("done", 4, at(0), "claim", None), ("done", 5, at(0, 9), "complete", None)]
    for rows in (first, [("later", 6, at(3), "claim", None)], [("later", 7, at(3, 1), "complete", None)]):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    due = {(r[1], r[2]) for r in run(spark, folder, EVENTS, "two") if r[-1]}
    assert due == {("leased", "in_progress"), ("failed", "retry")}


def test_view_stream_equals_batch(rocks, tmp_path):
    spark, folder = rocks, str(tmp_path / "events")
    events = view(spark, ROOT, "work_events").withColumn("happened_at", F.col("happened_at").cast("timestamp"))
    events.orderBy(F.desc("event_id")).coalesce(2).write.parquet(folder)
    last = {}
    for _, *row in run(spark, folder, events.schema, "three"):
        last[row[0]] = tuple(row[:9])
    assert last == {r.work_item_id: tuple(r) for r in W.fold_work(events).select(*COLUMNS).collect()}
