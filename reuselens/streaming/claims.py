"""A live queue of tasks: runners claim, leases run out, tasks go back, each task is out once.

The state of a queue is one map of open tasks; finished ones leave it. Events
of a batch are taken in order of time and number, and timers in event time end
the leases of silent runners. State and output are committed together, so after
a restart from the checkpoint no task is handed out twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: A lease ends so long after the claim or the last sign of life.
LEASE_MS = 2 * 3_600_000
_OUT = "queue string, seq long, ts timestamp, kind string, task_id long, runner string"


class _Queue(StatefulProcessor):
    """Pending and running tasks of one queue."""

    def __init__(self, lease: int, again: bool) -> None:
        self.lease, self.again = lease, again

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tasks = handle.getMapState("tasks", "task_id long", "mode string, created long, place long, runner string, until long")

    def _put(self, task: int, mode: str, created: int, place: int, runner: str | None, until: int) -> None:
        self.tasks.updateValue((task,), (mode, created, place, runner or "", until))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["ts", "seq"])
        open_ = {int(k[0]): [v[0], int(v[1]), int(v[2]), v[3], int(v[4])] for k, v in self.tasks.iterator()}
        changed, out = set(), []
        for e in events.itertuples(index=False):
            now = int(e.ts.timestamp() * 1000)
            task = None if pd.isna(e.task_id) else int(e.task_id)
            held = open_.get(task)
            kind = None
            if e.kind == "submit":
                kind = "known" if held else "queued"
                if not held:
                    open_[task] = [e.mode, now, int(e.seq), "", 0]
                    changed.add(task)
            elif e.kind == "claim":
                able = set(str(e.mode).split(","))
                free = [(v[1], v[2], t) for t, v in open_.items() if not v[3] and v[0] in able]
                kind = "assigned" if free else "empty"
                if free:
                    task = min(free)[2]
                    open_[task][3:] = [e.runner, now + self.lease]
                    changed.add(task)
            elif held is None or (held[3] != e.runner and e.kind != "requeue"):
                kind = "refused"  # not out, or not with this runner any more
            elif e.kind == "alive":
                held[4] = now + self.lease
                changed.add(task)
            elif e.kind == "requeue":
                kind = "queued" if held[3] else "refused"
                held[3:] = ["", 0]
                changed.add(task)
            else:
                kind = e.kind
                del open_[task]
                changed.add(task)
            if kind:
                out.append((key[0], int(e.seq), e.ts, kind, task, e.runner))
        for task in changed:
            if task in open_:
                self._put(task, *open_[task])
                if open_[task][3]:
                    self.handle.registerTimer(open_[task][4])
            else:
                self.tasks.removeKey((task,))
        yield self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, out = int(expiredTimerInfo.getExpiryTimeInMs()), []
        for k, v in list(self.tasks.iterator()):
            if v[3] and int(v[4]) <= at:  # a later sign of life has a timer of its own
                out.append((key[0], -1, pd.Timestamp(at, unit="ms"), "expired", int(k[0]), v[3]))
                if self.again:
                    self._put(int(k[0]), v[0], int(v[1]), int(v[2]), None, 0)
                else:
                    self.tasks.removeKey(k)
        yield self._rows(out)

    @staticmethod
    def _rows(out: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(out, columns=["queue", "seq", "ts", "kind", "task_id", "runner"])
        return found.astype({"seq": "int64", "ts": "datetime64[ns]", "task_id": "Int64"})

    def close(self) -> None:
        pass


def live_claims(events: DataFrame, lease_ms: int = LEASE_MS, requeue_expired: bool = False, late: str = "1 minute") -> DataFrame:
    """``(queue, seq, ts, kind, task_id, runner)``: what becomes of each event of a stream of queues.

    ``events (queue, seq, ts, kind, task_id, mode, runner)``: ``submit`` a task
    of a mode; ``claim`` by a runner for its modes, divided by commas: the
    oldest pending task of these is ``assigned``, or the queue is ``empty``;
    ``alive`` prolongs a lease, ``done`` and ``failed`` end it, ``requeue``
    makes a running task pending again. A runner that lost its task is
    ``refused``. A lease that runs out gives ``expired`` (seq -1): the task has
    failed, or is pending again with ``requeue_expired``. A task ended or
    failed may be submitted anew. Needs the RocksDB state store.
    """
    own = events.select("queue", "seq", "ts", "kind", F.col("task_id").cast("long").alias("task_id"), "mode", "runner").where("queue is not null")
    return own.withWatermark("ts", late).groupBy("queue").transformWithStateInPandas(_Queue(lease_ms, requeue_expired), _OUT, "append", "eventTime")
