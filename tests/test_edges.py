"""Hand-made cases of the operators that the shared tables don't hold."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reuselens.functions import normalise as N
from reuselens.functions import statistics as S
from reuselens.functions import vectors as V
from reuselens.operators import checks, reports, review, sampling, similarity
from reuselens.operators.graph import connected_components
from reuselens.plans.ordering import global_index
from reuselens.schemas import require_columns, resolve_column
from reuselens.sources import sinks, tables
from reuselens.streaming import stages

ROWS = "row_idx long, user_id string, qualification_url string, trade_first_name string, trade_second_name string, is_target_user boolean, cluster_id int"


def _cell(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(("text", "want"), [("[3,4]", [0.6, 0.8]), ("['3', '4']", [0.6, 0.8]), ("3,4", [0.6, 0.8]), ("0,0", [0.0, 0.0]), ("", None), ("abc", None), ("1,x", None), (None, None)])
def test_embedding_texts(spark, text, want):
    got = _cell(spark, text, V.parse_embedding)
    assert (got is None and want is None) or np.allclose(got, want)


def test_flags_and_ids(spark):
    words = ["1", " TRUE ", "t", "Yes", "y", "是", "0", "no", "", None]
    assert [_cell(spark, w, N.flag_words) for w in words] == [True] * 6 + [False] * 4
    assert [_cell(spark, w, N.flag_exact) for w in ("True", "true", None)] == [True, False, False]
    assert [_cell(spark, w, N.cluster_id) for w in ("7", " 3.0 ", "x", None, "-1")] == [7, 3, -1, -1, -1]
    assert [_cell(spark, w, N.uid) for w in (" a ", " ", None)] == ["a", None, None]
    assert _cell(spark, "a|b, a;;c/ d", N.groups) == ["a", "b", "c", "d"]
    with pytest.raises(Exception, match="not a cluster id"):
        _cell(spark, "x", N.cluster_id_strict)


def test_hosts_and_names(spark):
    allow = lambda c: N.host_allowed(c, ["a.example"])
    assert [_cell(spark, u, allow) for u in ("https://a.example/x", "http://b.a.example/", "https://ba.example/", "ftp://a.example/", "junk", None)] == [True, True, False, False, False, False]
    name = lambda c: N.file_name(F.lit("20240101"), F.lit("up-x"), c, F.lit("user123456"), F.lit(7))
    assert _cell(spark, "up-x-17", name) == "20240101_up-x_17_123456_007"


def test_sample_sizes(spark):
    assert abs(_cell(spark, 0.995, S.normal_quantile, "double") - 2.576236) < 1e-5
    assert [_cell(spark, p, S.default_margin, "double") for p in (0.2999, 0.3)] == [0.02, 0.05]
    size = lambda p, n: _cell(spark, p, lambda c: S.sample_size(c, F.lit(n)), "double")
    assert size(0.0, 100) == 0 and size(0.5, 1) == 1 and size(0.0723, 14320) < 14320 and size(0.1, 0) == size(0.1, 10**12)


def test_hash_sample_is_crc32(spark):
    ids = [f"u{k}" for k in range(300)]
    got = [r[0] for r in sampling.hash_sample(spark.createDataFrame([(i,) for i in ids * 2], "user_id string"), 20).collect()]
    assert got == sorted(ids, key=lambda u: (zlib.crc32(f"{u}_seed42".encode()), u))[:20]


def test_expansion(spark):
    row = lambda k, u, url, c: (k, u, url, "a", "b", False, c)
    rows = spark.createDataFrame([row(0, "s1", "x", 1), row(1, "o1", "y", 1), row(2, "s2", "z", 2), row(3, "s2", "w", 2), row(4, "s3", "v", -1), row(5, "o2", "q", 3), row(6, "s1", "x", 2), row(7, "o3", "t", -1)], ROWS)
    samples = spark.createDataFrame([(" s1",), ("s2",), ("s3",), ("s9",), ("",)], "user_id string")
    got = {(r.user_id, r.qualification_url, r.cluster_id, r.is_sample_user) for r in sampling.expand_clusters(rows, samples).collect()}
    assert got == {("s1", "x", 1, True), ("o1", "y", 1, False), ("s2", "z", -1, True), ("s2", "w", -1, True), ("s3", "v", -1, True)}
    # cluster 2 has two accounts, but one url of it went to cluster 1: the last check says so
    assert {r.code: r.detail for r in checks.expansion_checks(rows, samples, sampling.expand_clusters(rows, samples)).collect() if not r.ok} == {"A10_only_single_accounts_dropped": 1}
    broken = sampling.expand_clusters(rows, samples).where("user_id <> 'o1'")
    assert {"A6_no_account_missing", "A7_no_row_missing", "A9_no_single_account"} <= {r.code for r in checks.expansion_checks(rows, samples, broken).collect() if not r.ok}
    assert sampling.expand_clusters(rows, samples, keep_solo=True).where("cluster_id = 2").count() == 2
    assert sampling.expand_clusters(rows.limit(0), samples).count() == 0


def test_neighbours_in_blocks(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(90, 8)).astype(np.float32)
    v[40:60] = v[40]  # more equal vectors than neighbours
    df = spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(v)] + [(900, None), (901, [])], "row_idx long, embedding array<float>")
    got = {}
    for r in similarity.knn_exact(df, 5, block=32).collect():
        got.setdefault(r.src, []).append((r.dst, r.score))
    scores = v.astype(np.float64) @ v.T.astype(np.float64)
    np.fill_diagonal(scores, -np.inf)
    assert sorted(got) == list(range(90))
    for k, found in got.items():
        assert np.allclose(sorted(s for _, s in found), np.sort(scores[k])[-5:]) and k not in {d for d, _ in found}
    assert similarity.knn_exact(df.limit(0), 5).count() == 0


def test_components_and_labels(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (8, 9, 1.0), (9, 8, 1.0), (4, 4, 1.0), (6, 5, 1.0)], "src long, dst long, score double")
    assert dict(connected_components(edges).collect()) == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 5: 5, 6: 5}
    rows = spark.range(10).withColumnRenamed("id", "row_idx")
    got = {r.row_idx: r.cluster_id for r in similarity.label_clusters(rows, edges).collect()}
    assert got == {0: -1, 1: 0, 2: 0, 3: 0, 4: -1, 5: 1, 6: 1, 7: -1, 8: 2, 9: 2}


def test_pixels(spark):
    a = np.full((4, 4, 3), 100, np.uint8)
    b, c, d = a.copy(), a.copy(), np.full((8, 8, 3), 105, np.uint8)
    b[0, 0, 1], c[:2] = 150, 200
    images = spark.createDataFrame([(k, *x.shape[:2], x.tobytes()) for k, x in enumerate((a, b, c, d))], "row_idx long, h int, w int, data binary")
    edges = spark.createDataFrame([(0, 1, 1.0), (0, 2, 1.0), (0, 3, 0.9), (0, 7, 1.0)], "src long, dst long, score double")
    got = {r.dst: (r.pixel_rate, r.status, r.kept) for r in similarity.verify_edges(edges, images).collect()}
    assert got == {1: (15 / 16, "skipped", True), 2: (0.5, "skipped", False), 3: (1.0, "skipped", True), 7: (0.0, "no_image", False)}
    failed = similarity.verify_edges(edges.where("dst = 3"), images, align=lambda x, y: None).first()
    assert (failed.status, failed.kept) == ("align_failed", False)


def test_labels_and_decisions(spark):
    data = [(0, "u", N.CLEAN), (1, "u", N.CONFIRMED), (2, "w", N.AFFILIATED), (3, "w", N.CLEAN), (4, "z", None)]
    got = {r.user_id: r.remark_first for r in reports.first_label(spark.createDataFrame(data, "row_idx long, user_id string, remark_first string")).collect()}
    assert got == {"u": N.CONFIRMED, "w": N.CLEAN, "z": None}
    c = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")], "cluster_id string, qualification_url string")
    v = spark.createDataFrame([("a", True, "high"), ("b", True, "low"), ("c", True, "high")], "qualification_url string, is_electronic boolean, confidence string")
    r = spark.createDataFrame([("3", "keep"), ("2", "auto")], "cluster_id string, decision string")
    got = {x.cluster_id: (x.shown, x.submitted) for x in review.decisions(c, v, r).collect()}
    assert got == {"1": ("drop", "drop"), "2": ("drop", "keep"), "3": ("keep", "keep"), "4": ("keep", "keep")}


def test_batches_round_trip(spark):
    rows = global_index(spark.createDataFrame([(f"u{k:02d}",) for k in range(23)], "qualification_url string"), [F.asc("qualification_url")])
    assert sorted(r["index"] for r in rows.collect()) == list(range(23))
    made = review.batches(rows, 10).withColumn("results", F.expr("array(named_struct('idx', 2L, 'is_electronic', true, 'confidence', 'high'))"))
    got = {r.qualification_url for r in review.batch_verdicts(made).where("is_electronic").collect()}
    assert got == {"u01", "u11", "u21"} and made.count() == 3


def test_id_columns_and_headers(spark):
    uid, order = [c * 24 for c in "ab"], ["123456", "1234567"]
    found = lambda columns, *cells: {(r.column, r.kind, r.chosen) for r in review.detect_id_columns(spark.createDataFrame(list(zip(*cells)), [*columns])).collect()}
    assert found(["Uid", "x"], uid, order) == {("Uid", "uid", True)}  # no hint in the second header
    assert found(["uid", "task_id"], uid, order) == {("uid", "uid", False), ("task_id", "audit_order", True)}
    assert found(["task_id", "user_id"], order, uid) == {("task_id", "audit_order", False), ("user_id", "uid", True)}
    assert found(["uid", "task_id", "history_id"], uid, order, order) == {("uid", "uid", False), ("task_id", "audit_order", True), ("history_id", "audit_order", False)}
    assert found(["uid", "task_id"], order, ["1", "123456"]) == set()
    df = spark.createDataFrame([("a", "b")], "Who string, order string")
    assert resolve_column(df, ["uid", "who"]) == "Who" and resolve_column(df, ["nothing"]) is None
    with pytest.raises(ValueError, match="lacks embeds"):
        require_columns(df, ["embeds"])


def test_text_files(spark, tmp_path):
    text = '﻿user_id,sample_group\n" a ","x, y"\nb,\n'
    (tmp_path / "one.csv").write_text(text, encoding="utf-8")
    (tmp_path / "two.csv").write_bytes("user_id,名称\nc,未知\n".encode("gbk"))
    (tmp_path / "urls.txt").write_text(" http://a\nno\nhttps://b\n")
    got = sorted(tuple(r) for r in tables.read_samples(spark, [str(tmp_path / n) for n in ("one.csv", "two.csv")]).collect())
    assert got == [("a", "x, y", "one"), ("b", "one", "one"), ("c", "two", "two")]
    assert tables.read_table(spark, str(tmp_path / "two.csv")).first()["名称"] == "未知"
    assert [r.url for r in tables.read_urls(spark, str(tmp_path / "urls.txt")).collect()] == ["http://a", "https://b"]
    chunks = spark.createDataFrame([("u", 1, "bG8="), ("u", 0, "aGVs")], "upload_id string, index int, chunk string")
    assert bytes(tables.joined_chunks(chunks).first().content) == b"hello"


def test_changed_cells(spark):
    kind = "k string, v double"
    old, new = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], kind), spark.createDataFrame([("a", 1.0 + 1e-12), ("b", 2.1), ("d", 4.0)], kind)
    assert {r.k for r in sinks.changed_cells(old, new, ["k"], "v").collect()} == {"b", "c", "d"}


def test_stream_of_states(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(1, 0, "pending", "2024-01-01 00:00:00"), (1, 1, "running", "2024-01-01 00:10:00"), (2, 2, "done", "2024-01-01 00:20:00")]
    spark.createDataFrame(rows, "task_id long, seq long, status string, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(src)
    events = stages.read_events(spark, src, "task_id long, seq long, status string, ts timestamp")
    q = stages.task_states(events).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.task_id, r.status) for r in spark.read.parquet(out).collect()}
    assert got == {(1, "running"), (2, "done")}


def test_newest_file(spark, tmp_path):
    from reuselens.sources.tables import newest_file

    assert newest_file(spark, f"file://{tmp_path}") is None
    for name in ("annotated_x.csv", "annotated_old.csv", "other.csv"):
        (tmp_path / name).write_text("a")
    assert newest_file(spark, f"file://{tmp_path}").endswith("/annotated_x.csv")
    for name in ("annotated_w09.csv", "annotated_w10.csv"):
        (tmp_path / name).write_text("a")
    assert newest_file(spark, f"file://{tmp_path}").endswith("/annotated_w10.csv")


def test_keyed_digest(spark):
    import hashlib
    import hmac

    from reuselens.functions.normalise import hmac_sha256

    texts = ["", "a", "é漢" * 100, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for key in (b"", b"secret", bytes(range(64)), b"k" * 200):
        got = [r[0] for r in df.select(hmac_sha256(key, F.col("t"))).collect()]
        assert got == [None if t is None else hmac.new(key, t.encode(), hashlib.sha256).hexdigest() for t in texts]
