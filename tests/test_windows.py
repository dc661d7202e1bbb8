"""Clusters of sliding windows against clustering each window anew."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from reuselens.operators.similarity import cluster_threshold
from reuselens.operators.windows import WindowClusters

FIRST = date(2026, 2, 26)


def _rows(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(20, 6))[rng.integers(0, 20, 180)] + rng.normal(size=(180, 6)) * 0.08
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(k, k % 5, f"u{k % 30}", x.tolist()) for k, x in enumerate(v)] + [(500, 2, "u1", None), (501, 4, "u2", None)]
    return spark.createDataFrame(rows, "row_idx long, n int, user_id string, embedding array<float>")


def test_labels_equal_those_of_whole_windows(spark, tmp_path):
    rows = _rows(spark)
    store = WindowClusters(spark, f"file://{tmp_path}/w", days=3, least=0.97, k=3)
    for n in range(5):
        day = FIRST + timedelta(n)
        store.add_day(rows.where(F.col("n") == n), day)
        store.drop_before(day)
        assert store._held("rows") == store._held("pairs") == [FIRST + timedelta(x) for x in range(max(0, n - 2), n + 1)]
        found = store.labels(day).collect()
        want = cluster_threshold(rows.where(F.col("n").between(n - 2, n)), 0.97, 3)
        assert {(r.row_idx, r.cluster_id) for r in found} == {(r.row_idx, r.cluster_id) for r in want.collect()}
        assert {r.row_idx for r in found if r.source_window == "target_day"} == {r.row_idx for r in rows.where(F.col("n") == n).collect()}
        assert n < 2 or len({r.cluster_id for r in found}) > 5


def test_days_come_in_order_and_may_be_given_again(spark, tmp_path):
    rows = _rows(spark)
    store = WindowClusters(spark, f"file://{tmp_path}/w", days=3, least=0.97, k=3)
    store.add_day(rows.where("n = 0"), FIRST)
    store.add_day(rows.where("n = 2"), FIRST + timedelta(2))
    store.add_day(rows.where("n = 1"), FIRST + timedelta(2))  # replaces the one before; a day between is absent
    want = cluster_threshold(rows.where("n < 2"), 0.97, 3)
    assert {(r.row_idx, r.cluster_id) for r in store.labels(FIRST + timedelta(2)).collect()} == {(r.row_idx, r.cluster_id) for r in want.collect()}
    with pytest.raises(ValueError):
        store.add_day(rows.where("n = 3"), FIRST + timedelta(1))
    with pytest.raises(ValueError):
        store.labels(FIRST + timedelta(1))
    store.add_day(rows.where("false"), FIRST + timedelta(3))
    assert {r.row_idx for r in store.labels(FIRST + timedelta(3)).collect()} == {r.row_idx for r in rows.where("n = 1").collect()}
