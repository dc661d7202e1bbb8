"""Connected components as alternating star contractions over an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize

#: Edges that one step of the local contraction holds (16 bytes each).
_CHUNK = 1 << 18


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least node of its component among these edges."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        before = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, low[a], least)
        np.minimum.at(low, low[b], least)
        low = low[low]
        if np.array_equal(low, before):
            break
    at = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[at], nodes[low[at]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition as stars; holds ``_CHUNK`` edges or so."""
    u = v = np.empty(0, np.int64)
    for b in batches:
        u, v = (np.concatenate([x, b.column(k).to_numpy()]) for k, x in enumerate((u, v)))
        if len(u) >= _CHUNK:
            u, v = _stars(u, v)
            if len(u) >= _CHUNK // 2:  # stars of the chunk are handed on, not merged with the next one's
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                u = v = np.empty(0, np.int64)
    if len(u):
        u, v = _stars(u, v)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node.

    ``component`` is the smallest node id reachable; ids are longs. Self loops
    and nulls are ignored, repeated and reversed edges are the same edge; an
    empty table gives an empty result. First, each partition contracts its own
    edges to stars. Then each round sends every node's larger neighbours to
    its smallest one and its smaller neighbours likewise, so the number of
    rounds grows with the logarithm of the longest path. Minima are taken by
    partial aggregation, and hubs are joined, never gathered. The table of a
    round is dropped when the next one is written.
    """
    pairs = (
        edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .mapInArrow(_contracted, "u long, v long")
        .distinct()
    )
    pairs = materialize(pairs, "cc")
    for _ in range(max_rounds):
        # Stars: no node has two smaller neighbours, and none is both a member and a root.
        ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("m"), F.lit(0).alias("r")), F.struct(F.col("v").alias("n"), F.lit(0).alias("m"), F.lit(1).alias("r")))).alias("e")).select("e.*")
        open_nodes = ends.groupBy("n").agg(F.sum("m").alias("m"), F.max("r").alias("r")).where("m + r > 1").limit(1).count()
        if not open_nodes:
            break
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # pairs have u > v: each larger neighbour u of v, and v itself, go to the least of v's surroundings
        large = pairs.join(low.withColumnRenamed("u", "v"), "v").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .mapInArrow(_contracted, "u long, v long")
            .distinct()
        )
        pairs = materialize(small, "cc", consumed=(pairs,))
    else:
        raise RuntimeError("components did not settle")
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
