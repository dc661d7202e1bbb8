"""Clusters by pixels: verified edges, merges of clusters, and a library of known images."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import centroids
from ..plans.materialize import materialize
from .checks import require_downloads
from .similarity import BLOCK, aligned_pair, candidate_edges, knn_exact, label_clusters, verify_edges, with_images

Align = Callable[[np.ndarray, np.ndarray], np.ndarray | None]
# The side of a block, the share of blocks taken as background and the share taken as the changed part.
_SIDE, _BACKGROUND, _CHANGED = 32, 0.6, 0.2


def near_between(queries: DataFrame, library: DataFrame, k: int | None, id_col: str = "row_idx", vector: str = "embedding", least: float | None = None, block: int = BLOCK) -> DataFrame:
    """``(src, dst, score)``: the ``k`` largest inner products of each query with the library's rows.

    Both sides are dealt into blocks; a group is one block of either side, a
    product of bounded size. Ties go to the smaller ``dst``. Without ``k`` all
    products of ``least`` or more are given, unranked.
    """
    if k is None and least is None:
        raise ValueError("either k or least has to be given")
    own = lambda df, n, other, mine, theirs: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias(mine), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(theirs)).where(F.size("v") > 0)
    n, m = (max(1, math.ceil(df.count() / block)) for df in (queries, library))
    a, b = own(queries, n, m, "p", "q"), own(library, m, n, "q", "p")

    def product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"src": np.empty(0, np.int64), "dst": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(x) or not len(y):
            return none
        size = len(y["v"].iloc[0])
        x, y = (z[z["v"].map(len) == size].sort_values("id") for z in (x, y))
        if not len(x):
            return none
        right, theirs, out = np.stack(y["v"].to_numpy()), y["id"].to_numpy(), []
        for at in range(0, len(x), 512):
            part = x.iloc[at : at + 512]
            scores = np.stack(part["v"].to_numpy()) @ right.T
            if k is None:
                i, j = np.nonzero(scores >= least)
                out.append(pd.DataFrame({"src": part["id"].to_numpy()[i], "dst": theirs[j], "score": scores[i, j]}))
                continue
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            got = np.take_along_axis(scores, top, axis=1)
            i, j = np.nonzero(got >= (-np.inf if least is None else least))
            out.append(pd.DataFrame({"src": part["id"].to_numpy()[i], "dst": theirs[top[i, j]], "score": got[i, j]}))
        return pd.concat(out)

    found = a.groupBy("p", "q").cogroup(b.groupBy("p", "q")).applyInPandas(product, "src long, dst long, score double")
    if k is None:
        return found
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("score"), "dst"))
    return found.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def known_in_library(candidates: DataFrame, library: DataFrame, least: float = 0.85, similar: int = 5, id_col: str = "row_idx") -> DataFrame:
    """Candidates with ``top_score`` (0 without any), ``duplicate`` (``least`` or more) and their ``similar`` nearest ids, the nearest first."""
    near = near_between(candidates, library, similar, id_col)
    best = near.groupBy("src").agg(F.max("score").alias("top_score"), F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "dst"))), lambda x: x["dst"]).alias("similar"))
    out = candidates.select(F.col(id_col).alias("src")).join(best, "src", "left").withColumn("top_score", F.coalesce("top_score", F.lit(0.0)))
    return out.select(F.col("src").alias(id_col), "top_score", (F.col("top_score") >= least).alias("duplicate"), F.coalesce("similar", F.array().cast("array<long>")).alias("similar"))


def cluster_pairs(rows: DataFrame, least: float, vector: str = "embedding") -> DataFrame:
    """``(a, b, score)``: pairs of clusters (a < b) whose centroids of unit length have a cosine of ``least`` or more."""
    means = materialize(centroids(rows.where("cluster_id >= 0").where(F.size(vector) > 0), "cluster_id", vector, normalised=True).select(F.col("cluster_id").cast("long").alias("row_idx"), F.col("centroid").alias("embedding")), "centroids")
    return candidate_edges(knn_exact(means, None, least=least), least).select(F.col("src").alias("a"), F.col("dst").alias("b"), "score")


def best_member_pairs(rows: DataFrame, pairs: DataFrame, least: float, id_col: str = "row_idx", vector: str = "embedding", part: int = 512) -> DataFrame:
    """``(a, b, src, dst, score)``: for each pair of clusters its two most similar members, where their cosine is ``least`` or more.

    Members of a cluster are dealt into parts of about ``part`` rows, each a
    row of its own; a pair of parts is one row of a batch, not a group of its
    own, so that very many pairs of small clusters cost their products alone.
    """
    size = rows.where("cluster_id >= 0").where(F.size(vector) > 0).groupBy("cluster_id").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    own = rows.where(F.size(vector) > 0).join(size, "cluster_id").select(F.col("cluster_id").cast("long").alias("c"), F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.pmod(F.xxhash64(id_col), "parts").cast("int").alias("part"))
    parts = size.select(F.col("cluster_id").cast("long").alias("c"), "parts")
    grid = pairs.select("a", "b").join(parts.select(F.col("c").alias("a"), F.col("parts").alias("pa")), "a").join(parts.select(F.col("c").alias("b"), F.col("parts").alias("pb")), "b")
    grid = grid.select("a", "b", F.explode(F.sequence(F.lit(0), F.col("pa") - 1)).alias("pa"), "pb").select("a", "b", "pa", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)).alias("pb"))
    packed = own.groupBy("c", "part").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("m"))  # a row a part
    side = lambda c, p, m: packed.select(F.col("c").alias(c), F.col("part").alias(p), F.col("m").alias(m))
    met = grid.join(side("a", "pa", "x"), ["a", "pa"]).join(side("b", "pb", "y"), ["b", "pb"]).select("a", "b", "x", "y")

    def opened(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets of the rows' members, their ids, and their vectors one after the other."""
        ids, v = column.flatten().flatten()
        v = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
        sizes = np.asarray(column.value_lengths())
        return np.r_[0, np.cumsum(sizes)], ids.to_numpy(zero_copy_only=False), v

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            (i, src, x), (j, dst, y) = opened(b.column("x")), opened(b.column("y"))
            out = []
            for k in range(b.num_rows):
                scores = x[i[k] : i[k + 1]] @ y[j[k] : j[k + 1]].T
                at = int(scores.argmax())
                p, q = divmod(at, scores.shape[1])
                out.append((src[i[k] + p], dst[j[k] + q], scores[p, q]))
            columns = [np.array(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), *(pa.array(c) for c in columns)], names=["a", "b", "src", "dst", "score"])

    found = met.mapInArrow(best, "a long, b long, src long, dst long, score double")
    top = found.groupBy("a", "b").agg(F.min(F.struct((-F.col("score")).alias("s"), "src", "dst")).alias("m"))
    return top.select("a", "b", "m.src", "m.dst", (-F.col("m.s")).alias("score")).where(F.col("score") >= least)


def background_measure(x: np.ndarray, y: np.ndarray | None) -> tuple[bool, float, float]:
    """``(measurable, background, concentration)`` of two images that lie on each other.

    Blocks of 32 pixels square have a mean absolute difference; the background
    is the median of the lowest 60 % of these, the concentration the share of
    the highest 20 % in their sum. Without alignment, or with fewer than two
    blocks a side, there is no measure. It never rejects a pair by its value.
    """
    rows, columns = (x.shape[0] // _SIDE, x.shape[1] // _SIDE) if y is not None else (0, 0)
    if rows < 2 or columns < 2:
        return False, -1.0, -1.0
    gap = np.abs(x.astype(np.int16) - y.astype(np.int16)).mean(axis=2)[: rows * _SIDE, : columns * _SIDE]
    blocks = np.sort(gap.reshape(rows, _SIDE, columns, _SIDE).mean(axis=(1, 3)).ravel())
    background = float(np.median(blocks[: max(1, int(len(blocks) * _BACKGROUND))]))
    total = blocks.sum()
    if total <= 0:
        return True, 0.0, 1.0
    return True, background, float(blocks[-max(1, int(len(blocks) * _CHANGED)) :].sum() / total)


def borderline(edges: DataFrame, images: DataFrame, align: Align | None = None) -> DataFrame:
    """Edges with ``measurable``, ``background`` and ``concentration`` of their images; an absent image is not measurable."""
    columns = edges.columns
    joined = with_images(materialize(edges, "borderline-edges"), images, ("src", "dst"), ("x", "y")).select(*columns, "x", "y")

    def one(a: dict | None, b: dict | None) -> tuple[bool, float, float]:
        pair = aligned_pair(a, b, align)
        return (False, -1.0, -1.0) if pair is None else background_measure(*pair)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [one(*r) for r in zip(b["x"], b["y"])]
            yield b[columns].assign(**{c: [f[k] for f in found] for k, c in enumerate(("measurable", "background", "concentration"))})

    schema = ", ".join(f"`{c}` {kind}" for c, kind in edges.dtypes) + ", measurable boolean, background double, concentration double"
    return joined.mapInPandas(run, schema)


def merge_edges(rows: DataFrame, images: DataFrame, least: float = 0.97, rate: float = 0.85, low: float = 0.90, align: Align | None = None) -> DataFrame:
    """Edges between clusters: the most similar members of near clusters, if their pixels agree.

    Pairs of a rate of ``rate`` or more count, and those of ``low`` or more if
    they are measurable (:func:`borderline`). Alignment is never skipped here.
    """
    pairs = best_member_pairs(rows, cluster_pairs(rows, least), least).select("src", "dst", "score")
    checked = materialize(verify_edges(pairs, images, rate, sure=2.0, align=align), "merge-checked")
    sure = checked.where("kept").select("src", "dst", "score")
    asked = checked.where(~F.col("kept") & (F.col("pixel_rate") >= low)).select("src", "dst", "score")
    return sure.unionByName(borderline(asked, images, align).where("measurable").select("src", "dst", "score"))


def merge_clusters(rows: DataFrame, edges: DataFrame, images: DataFrame, least: float = 0.97, rate: float = 0.85, low: float = 0.90, align: Align | None = None) -> DataFrame:
    """``rows`` labelled again after the clusters of ``edges`` have been merged by :func:`merge_edges`."""
    more = materialize(merge_edges(rows, images, least, rate, low, align), "merge-edges")
    return label_clusters(rows, edges.select("src", "dst").unionByName(more.select("src", "dst")))


def cluster_pixels(df: DataFrame, images: DataFrame, near: float = 0.80, rate: float = 0.85, k: int = 20, tolerance: int = 10, sure: float = 0.99, merge: float | None = 0.97, low: float = 0.90, align: Align | None = None) -> DataFrame:
    """Clusters by pixels, end to end: neighbours, download guard, verified edges, components, merges.

    ``images (row_idx, h, w, data[, cached])``; rows of candidates without an
    image count as failed downloads.
    """
    edges = materialize(candidate_edges(knn_exact(df, k, least=near), near), "pixel-candidates")
    needed = edges.select(F.col("src").alias("row_idx")).union(edges.select(F.col("dst").alias("row_idx"))).distinct()
    cached = F.coalesce("cached", F.lit(False)) if "cached" in images.columns else F.lit(False)
    there = images.select("row_idx", F.col("data").isNotNull().alias("_ok"), cached.alias("cached"))
    require_downloads(needed.join(there, "row_idx", "left").select(F.coalesce("cached", F.lit(False)).alias("cached"), F.coalesce("_ok", F.lit(False)).alias("ok")))
    kept = materialize(verify_edges(edges, images, rate, tolerance, sure, align).where("kept"), "pixel-edges")
    rows = label_clusters(df, kept)
    return rows if merge is None else merge_clusters(materialize(rows, "pixel-clusters"), kept, images, merge, rate, low, align)

