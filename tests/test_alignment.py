"""Made images, moved and laid back; and the pixel mode that uses it."""

import numpy as np
import pytest

from reuselens.functions import alignment as A
from reuselens.operators.similarity import verify_edges


def _image(seed, h=220, w=260):
    """Smooth shades with rectangles on them."""
    rng = np.random.default_rng(seed)
    out = A.resized(rng.integers(60, 200, (6, 7, 3)).astype(float), h, w)
    for _ in range(90):
        y, x = rng.integers(0, h - 8), rng.integers(0, w - 8)
        out[y : y + rng.integers(6, 40), x : x + rng.integers(6, 40)] = rng.integers(0, 256, 3)
    return np.rint(out).astype(np.uint8)


def _matrix(turn=0.0, scale=1.0, dx=0.0, dy=0.0, tilt=0.0, centre=(130, 110)):
    c, s = scale * np.cos(turn), scale * np.sin(turn)
    back = np.array([[1, 0, centre[0] + dx], [0, 1, centre[1] + dy], [0, 0, 1.0]])
    return back @ np.array([[c, -s, 0], [s, c, 0], [tilt, 0, 1]]) @ np.array([[1, 0, -centre[0]], [0, 1, -centre[1]], [0, 0, 1.0]])


MOVES = {
    "none": {}, "shift": {"dx": 9, "dy": -6}, "half pixels": {"dx": 3.5, "dy": 2.5}, "turn": {"turn": 0.3}, "quarter turn": {"turn": np.pi / 2}, "smaller": {"scale": 0.8},
    "larger": {"scale": 1.25}, "all": {"turn": -0.2, "scale": 1.1, "dx": 5, "dy": 4}, "tilt": {"tilt": 3e-4},
}


@pytest.mark.parametrize("move", MOVES)
def test_moves_are_found_within_a_pixel(move):
    image = _image(1)
    m = _matrix(**MOVES[move])
    moved = A.warped(image, m, *image.shape[:2])
    (px, dx), (py, dy) = A.features(image), A.features(moved)
    i, j = A.matched(dx, dy)
    h, agree = A.homography(py[j], px[i])
    assert agree.sum() >= A.MIN_INLIERS and agree.mean() >= A.MIN_SHARE
    y, x = np.meshgrid(np.arange(60, 160, 10), np.arange(80, 180, 10), indexing="ij")
    p = np.stack([x.ravel(), y.ravel()], axis=1).astype(float)
    off = np.hypot(*(A._moved(h, A._moved(m, p)) - p).T)
    assert off.max() < 1.0
    laid = A.orb_align()(image, moved)
    inside = np.s_[70:150, 90:170]
    assert (np.abs(laid[inside].astype(int) - image[inside]).max(axis=2) <= 40).mean() > 0.9


def test_other_images_are_refused():
    align = A.orb_align()
    assert align(_image(1), _image(2)) is None
    assert align(_image(1), np.full((220, 260, 3), 128, np.uint8)) is None
    assert align(np.zeros((20, 20, 3), np.uint8), np.zeros((20, 20, 3), np.uint8)) is None
    noise = np.random.default_rng(0).integers(0, 256, (120, 120, 3)).astype(np.uint8)
    assert align(noise, noise[::-1].copy()) is None


def test_too_few_that_agree():
    rng = np.random.default_rng(1)
    p = rng.uniform(0, 200, (40, 2))
    q = p + 7
    q[8:] = rng.uniform(0, 200, (32, 2))
    h, agree = A.homography(p, q)
    assert 8 <= agree.sum() < 40 * A.MIN_SHARE + 4 and np.allclose(A._moved(h, p[:8]), q[:8], atol=6)
    h, agree = A.homography(p[:3], q[:3])
    assert h is None


def test_verified_edges_are_aligned(spark):
    image = _image(5)
    shifted = A.warped(image, _matrix(dx=12, dy=8), *image.shape[:2])
    rows = [(0, image), (1, shifted), (2, _image(6))]
    images = spark.createDataFrame([(k, x.shape[0], x.shape[1], bytearray(x.tobytes())) for k, x in rows], "row_idx long, h int, w int, data binary")
    edges = spark.createDataFrame([(0, 1, 0.9), (0, 2, 0.9), (0, 3, 0.9), (1, 2, 0.999)], "src long, dst long, score double")
    plain = {(r.src, r.dst): r for r in verify_edges(edges, images).collect()}
    found = {(r.src, r.dst): r for r in verify_edges(edges, images, align=A.orb_align()).collect()}
    assert not plain[0, 1].kept and plain[0, 1].status == "skipped"
    assert found[0, 1].kept and found[0, 1].status == "aligned" and found[0, 1].pixel_rate > 0.85
    assert (found[0, 2].status, found[0, 2].pixel_rate, found[0, 2].kept) == ("align_failed", 0.0, False)
    assert found[0, 3].status == "no_image" and found[1, 2].status == "skipped" and not found[1, 2].kept


def test_pixel_clusters_of_moved_images(spark):
    from reuselens import registry
    from reuselens.operators import similarity as C
    from reuselens.plans.catalogue import _vectors

    sf = "/root/testdata/sf0.001"
    found = {r.row_idx: r.cluster_id for r in registry.QUERIES["cluster_pixel_aligned"](spark, sf).collect()}
    near = C.candidate_edges(C.knn_exact(_vectors(spark, sf), 10, least=0.4), 0.4)
    labels = {r.vec_id: r.label for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    edges = [(r.src, r.dst) for r in near.collect()]
    up = {i: i for i in labels}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if labels[a] == labels[b]:
            up[find(a)] = find(b)
    want, got = {}, {}
    for i in labels:
        want.setdefault(find(i), set()).add(i)
        got.setdefault(found[i] if found[i] >= 0 else ("alone", i), set()).add(i)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values())) and len(edges) > 10


def test_images_are_not_broadcast(spark):
    """As stored these images are a few KB, in memory 60 MB; each pair of contents is compared once."""
    from pyspark.sql import functions as F

    from reuselens.operators.similarity import with_images
    from reuselens.plans.materialize import materialize

    data = F.unhex(F.repeat(F.when(F.col("id") % 2 == 0, "00").otherwise("FF"), 100 * 100 * 3))
    images = materialize(spark.range(2000).select(F.col("id").alias("row_idx"), F.lit(100).alias("h"), F.lit(100).alias("w"), data.alias("data")), "same-images")
    edges = materialize(spark.range(5000).select((F.col("id") % 1999).alias("src"), (F.col("id") % 1999 + 1 + F.col("id") % 2).alias("dst"), F.lit(0.9).alias("score")), "same-edges")
    plan = with_images(edges, images, ("src", "dst"), ("a", "b"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2
    got = {(r.src, r.dst, r.pixel_rate, r.status, r.kept) for r in verify_edges(edges, images).collect()}
    want = {(i % 1999, j, float((i % 1999 - j) % 2 == 0), "skipped", (i % 1999 - j) % 2 == 0) for i in range(5000) if (j := i % 1999 + 1 + i % 2) < 2000}
    assert want <= got and {g[3] for g in got - want} <= {"no_image"}
    calls = spark.sparkContext.accumulator(0)

    def align(x, y):
        calls.add(1)
        return y

    assert verify_edges(edges, images, align=align).where("status = 'aligned'").count() == len(edges.where("dst < 2000").collect())
    assert calls.value <= 4
