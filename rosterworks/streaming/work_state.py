"""The state of work items over a stream of their events, with timers for leases and pauses.

The state of an item is what later events can still change it by: its last event, its last completion, the failures since then,
its claims, and the ids of events that the watermark does not rule out yet. It does not grow with the item's history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.work import LEASE_MINUTES, PAUSE_MINUTES

OUTPUT = (
    "work_item_id string, status string, attempt_count long, failures long, last_error string, last_attempt_at timestamp, completed_at timestamp,"
    " lease_expires_at timestamp, next_attempt_at timestamp, due boolean"
)
_EVENT = "struct<at:bigint,id:bigint,kind:string,error:string>"
_STATE = f"last {_EVENT}, done {_EVENT}, claims long, claimed_at long, failed array<{_EVENT}>, recent array<struct<at:bigint,id:bigint>>"
#: The state store that such processors need.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_STATUS = {"claim": "in_progress", "complete": "completed", "fail": "retry"}


def _micros(at: pd.Timestamp) -> int:
    return at.value // 1000


def _time(micros: int | None) -> dt.datetime | None:
    return None if micros is None else pd.Timestamp(micros, unit="us")


class WorkItems(StatefulProcessor):
    """Folds claim, complete and fail events of one item, in any order; a row for every change, and one when its lease or pause is over."""

    def __init__(self, lease_minutes: int = LEASE_MINUTES, pause_minutes: int = PAUSE_MINUTES) -> None:
        self.lease, self.pause = lease_minutes * 60_000_000, pause_minutes * 60_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("item", _STATE)

    def _fold(self, events: list[tuple], watermark: int) -> list:
        last, done, claims, claimed_at, failed, recent = [*self.state.get()] if self.state.exists() else [None, None, 0, None, [], []]
        key = lambda e: (e[0], e[1])
        seen = {tuple(x) for x in recent or []}
        failed = [tuple(x) for x in failed or []]
        for event in events:
            if key(event) in seen:
                continue
            seen.add(key(event))
            if last is None or key(event) > key(last):
                last = event
            if event[2] == "claim":
                claims, claimed_at = claims + 1, max(claimed_at or event[0], event[0])
            elif event[2] == "complete" and (done is None or key(event) > key(done)):
                done = event
            elif event[2] == "fail":
                failed.append(event)
        failed = [f for f in failed if done is None or key(f) > key(done)]
        # Failures before the latest are needed only while a late completion may still take them away.
        return [tuple(last), done and tuple(done), claims, claimed_at, sorted(failed), sorted(x for x in seen if x[0] >= watermark)]

    def _row(self, item: str, state: list, due: bool) -> pd.DataFrame:
        last, done, claims, claimed_at, failed, _ = state
        over = last[0] + (self.lease if last[2] == "claim" else self.pause)
        return pd.DataFrame(
            {
                "work_item_id": [item], "status": [_STATUS[last[2]]], "attempt_count": [claims], "failures": [len(failed)], "last_error": [failed[-1][3] if failed else None], "last_attempt_at": [_time(claimed_at)],
                "completed_at": [_time(done[0] if done else None)], "lease_expires_at": [_time(over if last[2] == "claim" else None)], "next_attempt_at": [_time(over if last[2] == "fail" else None)], "due": [due],
            }
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = [(_micros(r.happened_at), int(r.event_id), r.kind, r.error if isinstance(r.error, str) else None) for batch in rows for r in batch.itertuples(index=False)]
        state = self._fold(events, timerValues.getCurrentWatermarkInMs() * 1000)
        self.state.update(tuple(state))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        last = state[0]
        if last[2] != "complete":
            self.handle.registerTimer((last[0] + (self.lease if last[2] == "claim" else self.pause)) // 1000)
        yield self._row(key[0], state, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self._row(key[0], [*self.state.get()], True)

    def close(self) -> None:
        pass


def work_states(events: DataFrame, delay: str = "1 day", lease_minutes: int = LEASE_MINUTES, pause_minutes: int = PAUSE_MINUTES) -> DataFrame:
    """Running state of work items from a stream of events (work_item_id, event_id, happened_at timestamp, kind, error).

    For update mode, in a session with the settings of ``PROVIDER``. Events may be ``delay`` late. The latest row of an item equals that of
    :func:`~rosterworks.operators.work.fold_work` over all its events; rows with ``due`` say that a lease or a pause has run out.
    """
    timed = events.select("work_item_id", "event_id", "happened_at", "kind", "error").withWatermark("happened_at", delay)
    return timed.groupBy("work_item_id").transformWithStateInPandas(WorkItems(lease_minutes, pause_minutes), OUTPUT, "Update", "EventTime")
