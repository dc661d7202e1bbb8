"""Distinct accounts of a stream's sliding days against the batch form, with late events and restarts."""

import random
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F
from test_claims import states  # noqa: F401  the state store of the tests

from reuselens.operators.reports import daily_windows
from reuselens.streaming.accounts import sliding_accounts

SCHEMA = "user_id string, ts timestamp, extra int"
START = datetime(2026, 3, 1, tzinfo=UTC)


def _run(spark, tmp_path, batches, **how):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        # a new query each time, from the checkpoint of the one before
        stream = sliding_accounts(spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in"), **how)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/c").option("path", f"file://{tmp_path}/out").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
    return sorted(map(tuple, spark.read.schema("day date, registrations long, accounts long, target_accounts long").parquet(f"file://{tmp_path}/out").collect()))


def _want(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).select("user_id", F.to_date("ts").alias("pro_settle_date"))
    return sorted(map(tuple, daily_windows(table).select("day", "registrations", "accounts", "target_accounts").collect()))


def test_same_as_the_batch_form_with_late_events(spark, states, tmp_path):  # noqa: F811
    rng = random.Random(3)
    batches = []
    for k in range(4):
        rows = []
        for _ in range(150):
            day = k * 9 + rng.randint(0, 8)
            late = rng.choice([0, 0, 0, 2]) if k else 0  # within three days of the youngest event so far
            rows.append((rng.choice([None, *"abcdefghij", "ab", "hot", "hot", "hot"]), START + timedelta(days=max(day, k * 9) - late, seconds=rng.choice([0, 86_399, rng.randint(0, 86_399)])), 1))
        rows.append((None if k == 2 else f"once{k}", START + timedelta(days=k * 9 + 4, microseconds=86_399_999_999), 1))
        batches.append(rows)
    every = [r for b in batches for r in b]
    end = (None, START + timedelta(days=400), 1)
    got = _run(spark, tmp_path, [*batches, [end], [(None, None, 1)]], late="12 days")
    assert got == _want(spark, every)  # the day of the last event is still open
    assert len(got) > 25


def test_events_behind_the_watermark_are_dropped(spark, states, tmp_path):  # noqa: F811
    day = lambda n: START + timedelta(days=n, hours=6)
    batches = [[("a", day(0), 1), ("b", day(10), 1)], [("c", day(0), 1), ("c", day(10), 1), ("b", day(9) + timedelta(hours=1), 1), ("d", day(9), 1)], [("a", day(30), 1)], [(None, None, 1)]]
    got = _run(spark, tmp_path, batches, late="1 day", days=3)
    assert [(r[0].day, *r[1:]) for r in got] == [(1, 1, 1, 1), (10, 1, 1, 1), (11, 3, 2, 2)]


def test_an_account_that_comes_back_after_its_state_has_gone(spark, states, tmp_path):  # noqa: F811
    day = lambda n: START + timedelta(days=n)
    rows = [("a", day(0), 1)], [("b", day(20), 1)], [("a", day(21), 1), ("a", day(20), 1)], [("z", day(60), 1)], [(None, None, 1)]
    got = _run(spark, tmp_path, rows)
    assert [tuple(r[1:]) for r in got] == [(1, 1, 1), (2, 2, 2), (3, 2, 1)]
