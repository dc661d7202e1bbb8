"""Event streams of the workflow: last states, windows of days, alarms for stale tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, folder: str, schema: str, files: int = 16) -> DataFrame:
    """New Parquet files of a folder, ``files`` in each batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def sliding_users(events: DataFrame, ts: str = "ts", days: int = 7, late: str = "1 day") -> DataFrame:
    """Per day: events and about how many accounts in the ``days`` days up to it."""
    w = F.window(ts, f"{days} days", "1 day")
    return events.withWatermark(ts, late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("events"), F.approx_count_distinct("user_id").alias("users")).select("w.start", "w.end", "event_type", "events", "users")


def task_states(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """``(task_id, status, seq, timed_out)`` whenever a task's last status changes; a task that is
    ``running`` and silent for two hours of event time fails. Keeps one row of state for each open task."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            seq, status = state.get
            state.remove()
            if status == "running":
                yield pd.DataFrame({"task_id": [key[0]], "status": ["failed"], "seq": [seq], "timed_out": [True]})
            return
        seq, status = before = state.get if state.exists else (-1, "")
        last = 0
        for b in batches:
            top = b.loc[b["seq"].idxmax()]
            last = max(last, int(b["ts"].max().timestamp() * 1000))
            if int(top["seq"]) > seq:
                seq, status = int(top["seq"]), str(top["status"])
        state.update((seq, status))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + 2 * 3_600_000)
        if (seq, status) != before:
            yield pd.DataFrame({"task_id": [key[0]], "status": [status], "seq": [seq], "timed_out": [False]})

    own = events.select("task_id", "ts", "seq", "status").withWatermark("ts", late)
    return own.groupBy("task_id").applyInPandasWithState(fold, "task_id long, status string, seq long, timed_out boolean", "seq long, status string", "append", GroupStateTimeout.EventTimeTimeout)
