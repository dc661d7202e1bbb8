"""Most similar members of pairs of clusters."""

from __future__ import annotations

import numpy as np

from reuselens.operators import merging


def test_member_pairs_are_rows_of_a_batch(spark):
    """Each pair's best members are those of a plain product, ties by the smaller ids, and no pair is a group of its own."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(90, 8))
    v[40], v[41] = v[10], v[10]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = spark.createDataFrame([(k, k % 12 - 1, v[k].tolist()) for k in range(90)], "row_idx long, cluster_id int, embedding array<double>")
    pairs = [(a, b) for a in range(11) for b in range(a + 1, 11)]
    found = merging.best_member_pairs(rows, spark.createDataFrame(pairs, "a long, b long"), 0.5, part=3)
    assert "CoGroups" not in found._jdf.queryExecution().toString()
    expected = {}
    for a, b in pairs:
        own, other = ([k for k in range(90) if k % 12 - 1 == c] for c in (a, b))
        scores = [(-round(float(v[i] @ v[j]), 9), i, j) for i in own for j in other]
        if -min(scores)[0] >= 0.5:
            expected[a, b] = min(scores)[1:]
    assert {(r.a, r.b): (r.src, r.dst) for r in found.collect()} == expected and len(expected) > 10
