"""Exact distinct accounts over sliding days of event time.

An account is in the window of day D if it has an event on any of the ``days``
days up to D. Its state is the list of its days that can still matter, so what
a new day adds is known at once: the windows that it covers and none of the
older or younger days did, whatever order the events come in. Only these steps
leave the state, and the windows of all accounts are sums of them, so no window
holds its accounts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_DAY_MS = 86_400_000
_STEP = "at timestamp, registrations long, accounts long, target_accounts long, held long"


class _Days(StatefulProcessor):
    """The recent days of one account."""

    def __init__(self, days: int) -> None:
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "days array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came: dict[int, int] = {}
        for b in rows:
            for day, n in b["day"].value_counts().items():
                came[int(day)] = came.get(int(day), 0) + int(n)
        nobody = key[0] is None or pd.isna(key[0])
        before = set() if nobody or not self.seen.exists() else set(self.seen.get()[0])
        covered = {d + k for d in before for k in range(self.days)}
        steps: dict[int, list[int]] = {}  # day of a window: events, accounts, accounts of the day itself, events of the day itself
        for day, n in came.items():
            for k in range(self.days):
                steps.setdefault(day + k, [0, 0, 0, 0])[0] += n
            steps[day][3] += n
            if nobody:
                continue
            steps[day][2] += day not in before
            for d in range(day, day + self.days):
                steps[d][1] += d not in covered
                covered.add(d)
        if not nobody:
            # late events are of the watermark's day or younger: days that reach no window from there on are of no more use
            least = timerValues.getCurrentWatermarkInMs() // _DAY_MS - self.days + 1
            kept = sorted(d for d in before | set(came) if d >= least)
            self.seen.update((kept,))
            self.handle.registerTimer((max(kept) + self.days) * _DAY_MS)
        # the last millisecond of a window's day, which no event that isn't late comes after the watermark of
        at = pd.to_datetime([(d + 1) * _DAY_MS - 1 for d in steps], unit="ms", utc=True)
        yield pd.DataFrame({"at": at, **{c: [v[k] for v in steps.values()] for k, c in enumerate(("registrations", "accounts", "target_accounts", "held"))}})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            at = expiredTimerInfo.getExpiryTimeInMs()
            if (max(self.seen.get()[0]) + self.days) * _DAY_MS <= at:  # a younger day has a timer of its own
                self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def sliding_accounts(events: DataFrame, user: str = "user_id", ts: str = "ts", days: int = 7, late: str = "1 day") -> DataFrame:
    """``(day, registrations, accounts, target_accounts)``: the rows of :func:`..operators.reports.daily_windows` from a stream.

    One row for each day (UTC) with events, once the watermark has passed it:
    all events of the ``days`` days up to it, their distinct accounts, and the
    accounts of the day itself. Events late by ``late`` or more are
    dropped, those without a time too; events without an account count as
    registrations. State: the recent days of each account seen in ``days``
    days and ``late``, and four sums for each open day. Needs the RocksDB state
    store.
    """
    own = events.select(F.col(user).alias("account"), F.col(ts).cast("timestamp").alias("ts")).where("ts is not null")
    dated = own.withWatermark("ts", late).select("account", "ts", F.floor(F.unix_millis("ts") / _DAY_MS).cast("long").alias("day"))
    steps = dated.groupBy("account").transformWithStateInPandas(_Days(days), _STEP, "append", "eventTime", eventTimeColumnName="at")
    whole = steps.groupBy(F.window("at", "1 day").alias("w")).agg(*[F.sum(c).alias(c) for c in ("registrations", "accounts", "target_accounts", "held")])
    return whole.where("held > 0").select(F.to_date("w.start").alias("day"), "registrations", "accounts", "target_accounts")
