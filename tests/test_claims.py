"""A stream of claims against a plain fold, over a restart, with a lost lease."""

from collections import Counter
from datetime import datetime, timedelta

import pytest

from reuselens.streaming.claims import live_claims

START = datetime(2026, 5, 1, 8)
SCHEMA = "queue string, seq long, ts timestamp, kind string, task_id long, mode string, runner string"


def _at(minutes):
    return START + timedelta(minutes=minutes)


BATCHES = [
    [
        ("q", 1, _at(0), "submit", 11, "pool", None), ("q", 2, _at(0), "submit", 12, "self", None), ("q", 3, _at(1), "submit", 13, "pool", None), ("r", 4, _at(1), "submit", 11, "pool", None),
        ("q", 5, _at(2), "claim", None, "pool", "a"), ("q", 6, _at(2), "claim", None, "pool,self", "b"), ("q", 7, _at(3), "claim", None, "self", "a"), ("q", 8, _at(3), "submit", 11, "pool", None),
    ],
    [("q", 9, _at(60), "alive", 11, None, "a"), ("q", 10, _at(61), "done", 11, None, "b"), ("q", 11, _at(62), "claim", None, "self,pool", "c"), ("q", 12, _at(63), "requeue", 13, None, None), ("q", 13, _at(64), "claim", None, "pool", "d")],
    [("q", 14, _at(150), "done", 11, None, "a"), ("r", 15, _at(151), "claim", None, "pool", "a")],  # b's lease on 12 ended at 122
    [("q", 16, _at(152), "alive", 12, None, "b"), ("q", 17, _at(153), "claim", None, "self", "e"), ("q", 18, _at(154), "done", 13, None, "c"), ("q", 19, _at(155), "done", 13, None, "d")],
]


@pytest.fixture
def states(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("again", [False, True])
def test_two_runners_a_lost_lease_and_a_restart(spark, states, tmp_path, again):
    for k, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        # a new query each time, from the checkpoint of the one before
        stream = live_claims(spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in"), requeue_expired=again)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/c").option("path", f"file://{tmp_path}/out").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None and not query.isActive, k
    found = {(r.queue, r.seq, r.kind, r.task_id, r.runner) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    rows = spark.read.parquet(f"file://{tmp_path}/out").count()
    want = {
        ("q", 1, "queued", 11, None), ("q", 2, "queued", 12, None), ("q", 3, "queued", 13, None), ("r", 4, "queued", 11, None),
        ("q", 5, "assigned", 11, "a"), ("q", 6, "assigned", 12, "b"), ("q", 7, "empty", None, "a"), ("q", 8, "known", 11, None),
        ("q", 10, "refused", 11, "b"), ("q", 11, "assigned", 13, "c"), ("q", 12, "queued", 13, None), ("q", 13, "assigned", 13, "d"),
        ("q", 14, "done", 11, "a"), ("r", 15, "assigned", 11, "a"), ("q", -1, "expired", 12, "b"), ("q", 16, "refused", 12, "b"),
        ("q", 17, "assigned" if again else "empty", 12 if again else None, "e"), ("q", 18, "refused", 13, "c"), ("q", 19, "done", 13, "d"),
    }
    assert found == want and rows == len(want)
    out = Counter((q, t) for q, _, kind, t, _ in found if kind == "assigned")
    assert out == Counter({("q", 11): 1, ("r", 11): 1, ("q", 12): 1 + again, ("q", 13): 2})
