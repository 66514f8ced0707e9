"""Leases on running attempts that heartbeats renew, with event-time timers."""

from __future__ import annotations

import contextlib
import dataclasses
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mapledger.functions import states

ABANDONED = "attempt_id string, dataset_id string, run_id string, started_at timestamp, expired_at timestamp, status string, error_message string"
_STATE = "leases string"
#: Attempts are held in so many lots of their hash. One call and one access to the store serve a lot, not an attempt.
LOTS = 1 << 12
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def state_with_timers(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, for streams started inside."""
    held = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, held)


def chained(deadline: int, beats: list[int], lease: int) -> tuple[int, list[int]]:
    """The deadline after heartbeats, each of which renews a lease that still holds; those beyond it wait for others."""
    waiting = sorted(beats)
    while waiting and waiting[0] <= deadline:
        deadline = max(deadline, waiting.pop(0) + lease)
    return deadline, waiting


@dataclasses.dataclass(slots=True)
class _Held:
    """One attempt: its start, the end of its lease, its finish, and heartbeats that wait for others, in microseconds."""

    dataset_id: str | None = None
    run_id: str | None = None
    started: int | None = None
    deadline: int | None = None
    finished: int | None = None
    beats: list[int] = dataclasses.field(default_factory=list)

    def add(self, kind: str, at: int, dataset_id: str | None, run_id: str | None) -> None:
        if kind == "START" and (self.started is None or at < self.started):
            self.dataset_id, self.run_id, self.started = dataset_id, run_id, at
        elif kind == "FINISH":
            self.finished = at if self.finished is None else min(self.finished, at)
        elif kind == "HEARTBEAT":
            self.beats.append(at)

    def renewed(self, lease: int) -> bool:
        """Moves the end of the lease; whether the attempt is still open."""
        if self.started is None:
            return True
        self.deadline, self.beats = chained(max(self.deadline or 0, self.started + lease), self.beats, lease)
        return self.finished is None or self.finished > self.deadline

    def timer(self, lease: int) -> int:
        """The first millisecond after the end. What comes before its start is kept for a lease."""
        end = self.deadline
        if end is None:
            end = max([*self.beats, *([] if self.finished is None else [self.finished])]) + lease
        return end // 1000 + 1


class _Lease(StatefulProcessor):
    """The open attempts of one lot, with one timer at the first of their ends.

    Nothing is decided before the watermark has passed the end of the lease, so the order of rows does not matter."""

    def __init__(self, lease_us: int) -> None:
        self._lease = lease_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("leases", _STATE)

    def _load(self) -> dict[str, _Held]:
        found = json.loads(self._state.get()[0]) if self._state.exists() else []
        return {attempt: _Held(*rest) for attempt, *rest in found}

    def _store(self, leases: dict[str, _Held]) -> None:
        first = min((held.timer(self._lease) for held in leases.values()), default=None)
        known = list(self._handle.listTimers())
        for set_before in known:
            if set_before != first:
                self._handle.deleteTimer(set_before)
        if first is None:
            self._state.clear()
            return
        if first not in known:
            self._handle.registerTimer(first)
        self._state.update((json.dumps(
            [(k, h.dataset_id, h.run_id, h.started, h.deadline, h.finished, h.beats) for k, h in leases.items()]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        leases, touched = self._load(), set()
        for frame in rows:
            columns = (frame[c].tolist() for c in ("attempt_id", "kind", "at_us", "dataset_id", "run_id"))
            for attempt, kind, at, dataset_id, run_id in zip(*columns, strict=True):
                touched.add(attempt)
                held = leases.get(attempt)
                if held is None:
                    held = leases[attempt] = _Held()
                held.add(kind, at, dataset_id, run_id)
        for attempt in touched:
            if not leases[attempt].renewed(self._lease):
                del leases[attempt]
        self._store(leases)
        return
        yield

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        leases = self._load()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        over = {k: held for k, held in leases.items() if held.timer(self._lease) <= now}
        self._store({k: held for k, held in leases.items() if k not in over})
        out = [(k, h.dataset_id, h.run_id, h.started, h.deadline) for k, h in over.items() if h.started is not None]
        if out:
            attempts, datasets, runs, started, expired = zip(*out, strict=True)
            yield pd.DataFrame({
                "attempt_id": attempts, "dataset_id": datasets, "run_id": runs,
                "started_at": pd.to_datetime(started, unit="us"), "expired_at": pd.to_datetime(expired, unit="us"),
                "status": "ABANDONED", "error_message": states.LEASE_EXPIRED})

    def close(self) -> None:
        pass


def abandoned(events: DataFrame, lease_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Attempts whose lease ran out, as soon as the watermark shows it.

    ``events`` (attempt_id, kind, at, dataset_id, run_id) holds a START for each attempt, HEARTBEATs that renew the lease
    while it holds, and a FINISH. An attempt's state goes when it finishes in time or is emitted. State is held by lots
    of attempts, so a checkpoint of another ``LOTS`` cannot be carried on. The stream has to be started inside
    ``state_with_timers``. Rows without id or time, or of another kind, are passed over.
    """
    known = events.where("attempt_id IS NOT NULL AND at IS NOT NULL AND kind IN ('START', 'HEARTBEAT', 'FINISH')")
    lot = F.pmod(F.xxhash64("attempt_id"), F.lit(LOTS)).cast("int")
    keyed = known.withWatermark("at", delay).select(
        lot.alias("lot"), "attempt_id", "kind", "at", F.unix_micros("at").alias("at_us"), "dataset_id", "run_id")
    return keyed.groupBy("lot").transformWithStateInPandas(
        statefulProcessor=_Lease(lease_seconds * 1_000_000), outputStructType=ABANDONED, outputMode="Append", timeMode="EventTime")
