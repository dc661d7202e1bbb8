"""A stored table under upserts, toggles and replaced runs, with writers at once."""

import random
import threading

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from reuselens.sources.keyed import Conflict, KeyedTable

SCHEMA = StructType().add("id", LongType()).add("run", StringType()).add("x", IntegerType())


def _table(spark, tmp_path, **more):
    return KeyedTable(spark, f"file://{tmp_path}/t", SCHEMA, ["id"], buckets=4, **more)


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _held(df):
    return {r.id: (r.run, r.x) for r in df.collect()}


def test_changes_in_order_equal_a_dict(spark, tmp_path):
    rng, plain = random.Random(2), {}
    t = _table(spark, tmp_path, compact_after=4)
    for step in range(11):
        op = ["put", "add", "drop", "toggle"][step % 4]
        keys = rng.sample(range(12), 5)
        t.apply(_df(spark, [(k, f"r{step % 3}", step) for k in keys]), op)
        for k in keys:
            if op == "put" or (op in ("add", "toggle") and k not in plain):
                plain[k] = (f"r{step % 3}", step)
            elif op in ("drop", "toggle"):
                plain.pop(k, None)
        assert _held(t.read()) == plain
        assert len(t.version().changes) < 4
    asked = t.lookup(spark.createDataFrame([(1,), (5,), (99,)], "id int"))
    assert _held(asked) == {k: v for k, v in plain.items() if k in (1, 5)}


def test_repeated_and_null_keys(spark, tmp_path):
    t = _table(spark, tmp_path)
    assert _held(t.read()) == {}
    t.apply(_df(spark, [(1, "a", 3), (1, "b", 9), (1, "c", 5), (2, None, None)]), order="x")
    t.apply(_df(spark, [(3, "a", 1), (3, "a", 2), (2, "z", 0), (4, "q", 0)]), "toggle", order="x")
    assert _held(t.read()) == {1: ("b", 9), 4: ("q", 0)}
    t.apply(_df(spark, []))
    assert _held(t.read()) == {1: ("b", 9), 4: ("q", 0)}
    with pytest.raises(ValueError):
        t.apply(_df(spark, [(None, "a", 1)]))
    with pytest.raises(ValueError):
        t.apply(_df(spark, [(1, "a", 1)]), "merge")


def test_a_stale_writer_fails_and_retries(spark, tmp_path):
    t, other = _table(spark, tmp_path), _table(spark, tmp_path)
    t.apply(_df(spark, [(1, "a", 1)]))
    stale = other.version()
    t.apply(_df(spark, [(2, "a", 2)]))
    with pytest.raises(Conflict):
        other.commit(stale, stale.base, stale.changes)
    other.apply(_df(spark, [(3, "a", 3)]))
    assert _held(t.read()) == {1: ("a", 1), 2: ("a", 2), 3: ("a", 3)}
    assert _held(t.read(stale)) == {1: ("a", 1)}  # a reader's version stays whole


def test_writers_at_once(spark, tmp_path):
    failed = []

    def write(n):
        try:
            own = _table(spark, tmp_path, compact_after=3)
            for k in range(3):
                own.apply(_df(spark, [(10 * n + k, f"w{n}", k), (999, f"w{n}", k)]))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=write, args=(n,)) for n in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(120)
    t = _table(spark, tmp_path)
    found = _held(t.read())
    assert not failed and set(found) == {10 * n + k for n in range(3) for k in range(3)} | {999}
    assert t._numbers() == list(range(1, t.version().number + 1))


def test_replaced_runs_and_compaction(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.apply(_df(spark, [(1, "w1", 1), (2, "w1", 2), (3, "w2", 3)]))
    t.apply(_df(spark, [(2, "w2", 9)]))  # moves to another run
    t.replace(_df(spark, [(4, "w2", 4), (3, "w2", 33)]), "run", ["w2"])
    want = {1: ("w1", 1), 3: ("w2", 33), 4: ("w2", 4)}
    assert _held(t.read()) == want
    before = t.version()
    assert t.compact().changes == () and _held(t.read()) == want == _held(t.read(before))
    t.vacuum(keep=1, older_than_ms=0)
    assert _held(t.read()) == want and t._numbers() == [before.number + 1]
    with pytest.raises(Exception):
        t.read(before).count()
