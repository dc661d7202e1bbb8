"""Further hand-made cases: reports over weeks, sources and sinks, images, merges, queues."""

import datetime as dt
import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from reuselens.functions import normalise as N
from reuselens.functions import statistics as S
from reuselens.functions import vectors as V
from reuselens.operators import boards, checks, merging, reports, review, similarity, workflow
from reuselens.operators.graph import connected_components
from reuselens.sources import blobs, sinks, tables
from reuselens.streaming import stages


def _cell(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


# -- small expressions


def test_short_flags_and_names(spark):
    assert [_cell(spark, w, N.flag_short) for w in ("1", " TRUE ", "yes", "", None)] == [True, True, False, False, False]
    assert [_cell(spark, w, N.retry_name) for w in ("a", "a-retry", "a-retry-retry")] == ["a-retry"] * 3
    assert [_cell(spark, x, N.number, "double") for x in (1.5, float("nan"), None)] == [1.5, None, None]
    day = spark.createDataFrame([(dt.date(2024, 1, 10),), (dt.date(2024, 1, 8),)], "d date").select(*S.previous_week(F.col("d")))
    assert {tuple(r) for r in day.collect()} == {(dt.date(2024, 1, 1), dt.date(2024, 1, 7), "20240107")}


def test_vectors_as_json_and_dimensions(spark):
    assert [_cell(spark, t, V.parse_embedding_json) for t in ("[1, 2.5]", "nan", " None ", "", None)] == [[1.0, 2.5], None, None, None, None]
    df = spark.createDataFrame([(3, [1.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0]), (0, None)], "k int, embedding array<double>")
    assert {r.k for r in V.same_dimension(df, "k").collect()} == {1, 2}
    means = {r.g: r.centroid for r in V.centroids(spark.createDataFrame([("a", [3.0, 4.0]), ("a", [3.0, 4.0])], "g string, embedding array<double>"), "g", normalised=True).collect()}
    assert np.allclose(means["a"], [0.6, 0.8])


# -- reports over weeks


def test_moves_trend_and_changes(spark):
    w = spark.createDataFrame([("w1", "a", 100, 10), ("w2", "a", 100, 12), ("w1", "b", 10, 1), ("w2", "b", 10, 1), ("w2", "c", 5, 5), ("w1", "d", 0, 0), ("w2", "d", 4, 1)], "week string, industry string, sampled long, violated long")
    moved = reports.concentration_moves(w, "w2", "w1").collect()
    assert [(r.industry, r.current, r.previous, r.delta) for r in moved] == [("d", 0.25, 0.0, 0.25), ("a", 0.12, 0.1, 0.02)]
    m = spark.createDataFrame([("w1", "all_sample_v2", 0.1), ("w2", "all_v1_sample", 0.2), ("w2", "other", 0.9), ("w3", "fin", 0.3)], "week string, sample_group string, concentration double")
    got = [tuple(r) for r in reports.trend(m, {"all": "overall", "fin": "finance"}, weeks=2).collect()]
    assert got == [("w2", 20.0, None), ("w3", None, 30.0)]
    p = spark.createDataFrame([("g", 1, 10.0), ("g", 2, 10.004), ("g", 3, 9.0)], "g string, w int, x double")
    assert [(r.previous, r.is_flat) for r in reports.prev_value(p, "g", "w", "x").orderBy("w").collect()] == [(None, None), (10.0, True), (10.004, False)]
    assert boards.previous_of(w.limit(0), "w2").count() == 0


def test_audits_fold(spark):
    pair = json.dumps([{"query_img_url": "q", "sim_img_url": "s", "pixel_similarity": 0.5, "cosine_similarity": 0.9, "type_name": "t"}])
    rows = [("u", "o", 1, "stop", "x", pair, 1), ("u", "o", 1, "pass", "y", "[]", 2), ("u", "o", 2, None, None, None, 3)]
    got = {r.audit_ms: r for r in reports.fold_audits(spark.createDataFrame(rows, "user_id string, order_id string, audit_ms long, action string, tag string, pairs_json string, seq int")).collect()}
    assert got[1].actions == ["pass", "stop"] and got[1].tags == ["x", "y"] and got[1].pairs[0].sim_img_url == "s"
    assert got[2].actions == [] and got[2].pairs is None


def test_tasks_to_resume(spark):
    now = dt.datetime(2024, 1, 1, 12)
    rows = [(1, "pending", None), (2, "running", now - dt.timedelta(seconds=61)), (3, "running", now - dt.timedelta(seconds=59)), (4, "running", None), (5, "done", None)]
    df = spark.createDataFrame(rows, "task_id int, status string, heartbeat_at timestamp_ntz")
    assert {r.task_id for r in review.to_resume(df, F.lit(now).cast("timestamp_ntz")).collect()} == {1, 2, 4}


def test_sliding_days(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("2024-01-01 10:00:00", "u1", "a"), ("2024-01-02 10:00:00", "u2", "a"), ("2024-01-20 00:00:00", "u3", "a")]
    spark.createDataFrame(rows, "ts string, user_id string, event_type string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(src)
    extra = spark.createDataFrame([("2024-02-20 00:00:00", "u9", "a")], "ts string, user_id string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    extra.coalesce(1).write.mode("append").parquet(src)
    events = stages.read_events(spark, src, "ts timestamp, user_id string, event_type string", files=1)
    q = stages.sliding_users(events).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = {str(r.start)[:10]: (r.events, r.users) for r in spark.read.parquet(out).collect()}
    assert got["2024-01-01"] == (2, 2) and got["2023-12-26"] == (1, 1)


# -- sources and sinks


def test_partitions_and_targets(spark):
    df = spark.createDataFrame([("20240101", 1), ("20240103", 2)], "dtm string, x int")
    assert tables.latest_partition(df) == "20240103" and tables.latest_partition(df, since="20240104") is None
    assert tables.first_filled_partition(df, ["20240105", "20240103", "20240101"]) == "20240103" and tables.first_filled_partition(df, ["1"]) is None
    images = spark.createDataFrame([("a", "u1", dt.date(2024, 1, 1), "e"), ("b", "u2", dt.date(2024, 1, 2), "e"), ("a", "u1", dt.date(2024, 1, 2), "f"), ("c", "u3", dt.date(2023, 1, 1), "g")], "user_id string, qualification_url string, settle_date date, embeds string")
    got = {(r.user_id, r.is_target_user) for r in tables.fetch_targets(images, spark.createDataFrame([("a",), ("a",)], "user_id string"), ("2024-01-01", "2024-01-05")).collect()}
    assert got == {("a", True), ("b", False)}


def test_written_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'x "y"'), (2, None)], "a int, b string")
    sinks.write_csv(df, str(tmp_path / "c"), bom=True)
    first = next((tmp_path / "c").glob("part-*")).read_bytes()
    assert first.startswith("﻿".encode())
    got = tables.read_delimited(spark, str(tmp_path / "c"))
    assert got.columns == ["a", "b"] and {(r.a, r.b) for r in got.collect()} == {("1", 'x "y"'), ("2", None)}
    sinks.write_views(df, {str(tmp_path / "v1"): ["a"], str(tmp_path / "v2"): ["b", "a"]})
    assert spark.read.parquet(str(tmp_path / "v1")).columns == ["a"] and spark.read.parquet(str(tmp_path / "v2")).count() == 2
    sinks.write_stats(df, str(tmp_path / "s"))
    assert {r.a for r in spark.read.json(str(tmp_path / "s")).collect()} == {1, 2}


def test_sheet_blocks(spark):
    kind = "period string, g string, v double, n long"
    sheet = spark.createDataFrame([("w1", "a", 0.1, 1), ("w2", "a", 0.2, 2), ("w2", "b", 0.3, 3)], kind)
    block = spark.createDataFrame([("w2", "a", 0.2 + 1e-13, 2), ("w2", "b", 0.35, 3), ("w2", "c", 0.4, 4)], kind)
    out = sinks.merged_block(sheet, block, ["period", "g"], ["v", "n"])
    assert {(r.period, r.g): (r.v, r.change) for r in out.collect()} == {("w1", "a"): (0.1, "kept"), ("w2", "a"): (0.2, "kept"), ("w2", "b"): (0.35, "rewritten"), ("w2", "c"): (0.4, "appended")}
    assert sinks.unread_cells(out, block, ["period", "g"], "v").count() == 0 and sinks.unread_cells(sheet, block, ["period", "g"], "v").count() == 2


def test_pipe_tables_and_uploads(spark, tmp_path):
    (tmp_path / "t.md").write_text("note\n| a | b |\n|---|---|\n| 1 | x y |\n| 2 |\nend\n")
    got = tables.read_pipe_table(spark, str(tmp_path / "t.md"))
    assert got.columns == ["a", "b"] and [tuple(r) for r in got.collect()] == [("1", "x y"), ("2", None)]
    (tmp_path / "u.csv").write_text(' a ,b\n" 1 ", x \n')
    assert tables.read_upload(spark, str(tmp_path / "u.csv")).first().asDict() == {"a": "1", "b": "x"}


def _pixmap(image):
    return b"P6 %d %d 255\n" % image.shape[1::-1] + image.tobytes()


def test_a_stored_cache_resumes(spark, tmp_path):
    rng = np.random.default_rng(5)
    made = {f"http://i/{k}": rng.integers(0, 256, (6 + k, 8, 3), dtype=np.uint8) for k in range(12)}
    wanted = spark.createDataFrame([(u,) for u in [*made, "http://i/none", "http://i/0", None]], "url string")
    held = spark.createDataFrame([(u, _pixmap(x)) for u, x in made.items()] + [("http://i/none", b"junk")], "url string, content binary")
    path, asked = f"file://{tmp_path}/cache", []

    def fetch(misses, breaks_at=None):
        if len(asked) == breaks_at:
            raise OSError("gone")
        asked.append(sorted(r.url for r in misses.collect()))
        return misses.join(held, "url")

    with pytest.raises(OSError):
        blobs.fill_cache(wanted, path, lambda m: fetch(m, 3), pieces=4)
    first = sum(asked, [])
    assert blobs.stored_images(spark, path).count() == len(set(first) - {"http://i/none"})
    asked.clear()
    blobs.fill_cache(wanted, path, fetch, pieces=4)
    assert sorted(set(first) | set(sum(asked, []))) == sorted([*made, "http://i/none"]) and not (set(first) - {"http://i/none"}) & set(sum(asked, []))
    stored = {r.key: r for r in blobs.stored_images(spark, path).collect()}
    assert len(stored) == 12 and all(bytes(stored[hashlib.sha1(f"Lorig|{u}".encode()).hexdigest()].data) == x.tobytes() for u, x in made.items())
    asked.clear()
    blobs.fill_cache(wanted, path, fetch, pieces=4)
    assert sum(asked, []) == ["http://i/none"] and blobs.stored_images(spark, path).count() == 12
    hits = blobs.cached_images(wanted, blobs.stored_images(spark, path), fetch)
    assert hits.where("cached").count() == 12


def test_counts_of_parsed_cells(spark):
    cells = [(3, "[1, 2]"), (1, "x"), (2, "['1','2']"), (4, " "), (5, None), (6, "1,2,3"), (7, "[]"), (0, "")]
    assert tuple(V.parse_counts(spark.createDataFrame(cells, "k int, embeds string"), "k").first()) == (8, 2, 3, 3, 2)
    none = spark.createDataFrame([], "k int, embeds string")
    assert tuple(V.parse_counts(none, "k").first()) == (0, 0, 0, 0, None)
    assert tuple(V.parse_counts(spark.createDataFrame([(1, "x"), (2, None)], "k int, embeds string"), "k").first()) == (2, 0, 1, 1, None)


def test_attribution_by_row(spark):
    mine = spark.createDataFrame([("a", "u1", 1), ("a", "u1", 2), ("a", "u2", 3), ("b", "u3", 4), ("c", "u4", 5), (None, "u5", 6)], "user_id string, qualification_url string, k int")
    audits = spark.createDataFrame([("a", [("u1",), ("u9",)]), ("a", None), ("b", [("u8",)]), ("c", []), (None, [("u5",)])], "user_id string, pairs array<struct<query_img_url string>>")
    got = {r.k: (r.n_fake, r.n_audited, r.n_same, r.n_orders, r.match) for r in reports.attribute_rows(mine, audits).collect()}
    assert got == {1: (2, 2, 1, 2, "same"), 2: (2, 2, 1, 2, "same"), 3: (2, 2, 1, 2, "same"), 4: (1, 1, 0, 1, "diff"), 5: (1, 0, 0, 1, "nofactor"), 6: (0, 0, 0, 0, "nofactor")}


def test_images_and_their_cache(spark, tmp_path):
    rng = np.random.default_rng(3)
    made = {f"http://i/{k}": rng.integers(0, 256, (10 + k, 20, 3), dtype=np.uint8) for k in range(3)}
    wanted = spark.createDataFrame([(u,) for u in [*made, "http://i/none", "http://i/0"]], "url string")
    held = spark.createDataFrame([(u, _pixmap(x)) for u, x in made.items()] + [("http://i/none", b"junk")], "url string, content binary")
    asked = []

    def fetch(misses):
        asked.append(sorted(r.url for r in misses.collect()))
        return misses.join(held, "url")

    first = {r.url: r for r in blobs.cached_images(wanted, None, fetch, longest=10).collect()}
    assert len(first) == 4 and first["http://i/none"].data is None and not first["http://i/0"].cached
    assert first["http://i/0"].key == hashlib.sha1(b"L10|http://i/0").hexdigest()
    assert (first["http://i/1"].h, first["http://i/1"].w) == (6, 10) and bytes(first["http://i/1"].data) == blobs.shrunk(made["http://i/1"], 10).tobytes()
    cache = spark.createDataFrame([(r.key, r.h, r.w, bytes(r.data)) for r in first.values() if r.data is not None][:2], "key string, h int, w int, data binary")
    again = {r.url: r.cached for r in blobs.cached_images(wanted, cache, fetch, longest=10).collect()}
    assert sum(again.values()) == 2 and len(asked[-1]) == 2
    for u, x in made.items():
        (tmp_path / f"{u[-1]}.ppm").write_bytes(_pixmap(x))
    read = blobs.read_images(spark, str(tmp_path), "*.ppm").collect()
    assert {(r.h, r.w) for r in read} == {(10, 20), (11, 20), (12, 20)}
    store = str(tmp_path / "store")
    blobs.add_artifacts(store, spark.createDataFrame([(1, "s", "a.csv", "text/csv", b"x,y"), (2, "s", "b.bin", "bin", b"")], "run_id int, stage string, filename string, content_type string, content binary"))
    ids = {r.filename: r.artifact_id for r in spark.read.parquet(store).collect()}
    assert bytes(blobs.read_artifact(spark, store, ids["a.csv"]).first().content) == b"x,y" and blobs.read_artifact(spark, store, "none").count() == 0


# -- pixels and merges


def test_background_measure():
    x = np.full((96, 128, 3), 90, np.uint8)
    y = x.copy()
    y[:32, :32] += 60
    assert merging.background_measure(x, x) == (True, 0.0, 1.0)
    ok, background, share = merging.background_measure(x, y)
    assert ok and background == 0.0 and share == 1.0
    assert merging.background_measure(x, None) == (False, -1.0, -1.0) and not merging.background_measure(x[:40], y[:40])[0]


def test_clusters_by_pixels(spark):
    """Two clusters of one template whose edges were cut off by k are merged by their most similar members."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=16)
    groups = [base + 0.05 * rng.normal(size=16), base + 0.05 * rng.normal(size=16), rng.normal(size=16)]
    rows, images = [], []
    template = rng.integers(0, 256, (64, 64, 3), dtype=np.uint8)
    other = rng.integers(0, 256, (64, 64, 3), dtype=np.uint8)
    for k in range(12):
        v = groups[k // 4] + 0.001 * rng.normal(size=16)
        rows.append((k, [float(a) for a in v / np.linalg.norm(v)]))
        image = (template if k < 8 else other).copy()
        image[: 4 + (4 if 4 <= k < 8 else 0), :8] = 20 * k  # a changed part
        images.append((k, 64, 64, image.tobytes()))
    df = spark.createDataFrame(rows, "row_idx long, embedding array<double>")
    pixels = spark.createDataFrame(images, "row_idx long, h int, w int, data binary")
    apart = {r.row_idx: r.cluster_id for r in merging.cluster_pixels(df, pixels, near=0.9, rate=0.9, k=2, merge=None).collect()}
    assert len({apart[k] for k in range(4)}) == 1 and apart[0] != apart[4] and apart[8] not in (apart[0], apart[4])
    joined = {r.row_idx: r.cluster_id for r in merging.cluster_pixels(df, pixels, near=0.9, rate=0.9, k=2, merge=0.9).collect()}
    assert len({joined[k] for k in range(8)}) == 1 and joined[8] != joined[0] and min(joined.values()) == 0
    low = merging.cluster_pixels(df, pixels, near=0.9, rate=0.9999, k=2, merge=0.9, low=0.9).collect()  # all pairs are borderline
    assert {r.cluster_id for r in low} == {-1}
    with pytest.raises(RuntimeError, match="downloads failed"):
        merging.cluster_pixels(df, pixels.where("row_idx < 3"), near=0.9, k=2)


def test_borderline_pairs_without_alignment(spark):
    images = spark.createDataFrame([(k, 64, 64, bytes([k]) * 12288) for k in range(2)], "row_idx long, h int, w int, data binary")
    edges = spark.createDataFrame([(0, 1, 1.0), (0, 5, 1.0)], "src long, dst long, score double")
    got = {r.dst: (r.measurable, r.background) for r in merging.borderline(edges, images).collect()}
    assert got == {1: (True, 1.0), 5: (False, -1.0)}
    assert not merging.borderline(edges, images, align=lambda x, y: None).where("measurable").count()


def test_known_images(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.8, 0.6]), (2, [0.0, 1.0]), (3, None)], "row_idx long, embedding array<double>")
    got = {r.row_idx: r for r in merging.known_in_library(v.where("row_idx in (0, 2, 3)"), v.where("row_idx = 1")).collect()}
    assert (got[0].duplicate, got[0].similar, round(got[0].top_score, 6)) == (False, [1], 0.8) and (got[3].top_score, got[3].similar) == (0.0, [])
    assert merging.known_in_library(v.where("row_idx = 1"), v.where("row_idx = 1")).first().duplicate
    assert merging.known_in_library(v, v.limit(0)).where("duplicate").count() == 0


def test_spherical_kmeans_labels_every_row(spark):
    rng = np.random.default_rng(4)
    centres = np.eye(6)
    vectors = np.tile(centres, (20, 1)) + 0.05 * rng.normal(size=(120, 6))
    rows = [(k, [float(x) for x in v / np.linalg.norm(v)]) for k, v in enumerate(vectors)]
    got = similarity.cluster_kmeans(spark.createDataFrame(rows, "row_idx int, embedding array<double>"), 6, 20, (1, 2, 3)).collect()
    by = {}
    for r in got:
        by.setdefault(r.cluster_id, set()).add(r.row_idx % 6)
    assert len(got) == 120 and sorted(by) == list(range(6)) and all(len(x) == 1 for x in by.values())


def test_long_paths_settle(spark):
    edges = spark.range(0, 3000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")).repartition(7)
    got = connected_components(edges)
    assert got.count() == 3001 and got.where("component <> 0").count() == 0


# -- queues


def test_requeue_retry_and_claims(spark):
    t = spark.createDataFrame([(1, "a（重试3）", "failed", "x", 1, "m"), (2, "b", "done", "x", 2, "m"), (3, "c", "running", None, 3, "n"), (4, "d", "pending", "x", 4, "m"), (5, "e", "pending", "x", 5, "n")], "task_id int, title string, status string, content string, created_at int, mode string")
    t = t.withColumns({c: F.lit("v") for c in ("started_at", "finished_at", "detail")})
    ids = t.select("task_id")
    got = {r.task_id: (r.status, r.refused, r.detail) for r in workflow.requeued(t, ids.where("task_id < 4")).collect()}
    assert got == {1: ("pending", None, None), 2: ("done", "state", "v"), 3: ("running", "content", "v"), 4: ("pending", None, "v"), 5: ("pending", None, "v")}
    assert [(r.retry_of, r.title) for r in workflow.retried(t, ids).collect()] == [(1, "a（重试）")]
    people = spark.createDataFrame([("all", ["m", "n"]), ("only_n", ["n"])], "worker string, modes array<string>")
    assert {(r.worker, r.task_id) for r in workflow.next_tasks(t, people).collect()} == {("only_n", 5), ("all", 4)}
    assert workflow.next_tasks(t, people.limit(0)).count() == 0


def test_guards(spark):
    a = spark.createDataFrame([("u1",), ("u2",), ("",), (None,)], "user_id string")
    assert checks.same_accounts(a, a).first().repeated and not checks.same_accounts(a, a.limit(1)).first().repeated
    assert not checks.same_accounts(a.limit(0), a.limit(0)).first().repeated
    few = spark.createDataFrame([(False, False)] * 4 + [(True, True)] * 96, "cached boolean, ok boolean")
    assert checks.download_guard(few).first().verdict == "pass"  # four failures among a hundred images
    checks.require_downloads(few)


def test_answers_of_a_classifier(spark):
    answers = ['{"is_electronic": true, "confidence": "High", "reason": "r"}', 'x ```json\n{"is_electronic": false}\n``` y', 'so {"is_electronic": true} it is', "nothing", "{broken", None]
    got = [(r.is_electronic, r.confidence, r.reason) for r in workflow.parsed_answers(spark.createDataFrame([(a,) for a in answers], "answer string")).collect()]
    assert got == [(True, "high", "r"), (False, "low", ""), (True, "low", ""), (False, "low", "parse_fail: nothing"), (False, "low", "parse_fail: {broken"), (False, "low", "parse_fail: ")]
