"""Queries of the weekly board, its checks and the pixel mode, each beside its SQL."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions import statistics as S
from ..functions import vectors as V
from ..functions.alignment import orb_align
from ..operators import boards as B
from ..operators import checks as K
from ..operators import merging as M
from ..operators import reports as R
from ..operators import review as W
from ..operators import sampling as P
from ..operators import similarity as C
from ..operators.search import search_indexed, write_search_index
from ..operators.windows import WindowClusters
from ..sources import tables
from ..sources.keyed import KeyedTable
from . import fixtures as X
from .catalogue import ANN, BAD3, ORACLE_SQL, CHECKED, EXPAND_B, LABELS, PER_USER, REG, SCOPE, SOURCES, SPLIT, _cluster_annotations, _inputs, _registered, _vectors, cert_method, parse_embedding, query, violation_dist
from .materialize import materialize, new_path
from .ordering import global_index

# -- distributions and shares

DIST = f"""{X.ANNOTATED_SQL}, {X.SAMPLE_SQL}, {PER_USER}, ind AS (SELECT user_id, min_by(trade_first_name, row_idx) AS i1, min_by(trade_second_name, row_idx) AS i2 FROM fx_cluster GROUP BY user_id),
dist AS (SELECT i1 AS industry1, i2 AS industry2, count(*) AS sampled, count(*) FILTER (s AND NOT r) + count(*) FILTER (r) AS violated FROM fx_sample JOIN ind USING (user_id) LEFT JOIN lab USING (user_id) GROUP BY 1, 2),
d1 AS (SELECT industry1 AS industry, CAST(sum(violated) AS BIGINT) AS violated FROM dist GROUP BY 1)"""


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(violation_dist(spark, sf_dir).withColumn("violated", F.col("confirmed") + F.col("suspected")), "dist")


@query(f"WITH {DIST} SELECT industry, violated, round(violated / (SELECT sum(violated) FROM d1), 4) AS violated_share FROM d1 WHERE violated > 0")
def l1_share(spark, sf_dir):
    return B.industry_share(_levels(spark, sf_dir).where("level = 1").select(F.col("industry1").alias("industry"), "violated"))


@query(f"WITH {DIST} SELECT industry2, violated, row_number() OVER (ORDER BY violated DESC, industry2) - 1 AS place FROM dist WHERE industry1 = 'en' AND violated > 0")
def l2_drill(spark, sf_dir):
    return B.second_level(_levels(spark, sf_dir).where("level = 2"), "en")


AUTH = f"""{X.ANNOTATED_SQL}, {REG}, org AS (SELECT concat('u', CAST(c_custkey AS VARCHAR)) AS user_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS t FROM customer),
a AS (SELECT first_trade_name AS industry, coalesce(t, '{N.MISSING_AUTH}') AS method, count(*) AS registered FROM reg LEFT JOIN org USING (user_id) GROUP BY ALL),
bad AS (SELECT user_id, min_by(trade_first_name, row_idx) AS industry FROM fx_annotated WHERE remark_first = '{N.CONFIRMED}' GROUP BY 1),
b AS (SELECT industry, coalesce(t, '{N.MISSING_AUTH}') AS method, count(*) AS confirmed FROM bad LEFT JOIN org USING (user_id) GROUP BY ALL),
cert AS (SELECT industry, method, coalesce(registered, 0) AS registered, coalesce(confirmed, 0) AS confirmed FROM a FULL JOIN b USING (industry, method) WHERE method <> '{N.MISSING_AUTH}')"""


@query(f"""WITH {AUTH}, t AS (SELECT industry, sum(registered) AS r, sum(confirmed) AS c FROM cert GROUP BY 1)
SELECT industry, method, registered, confirmed, coalesce(round(CASE WHEN r > 0 THEN 100 * registered / r END, 1), 0) AS registered_pct, coalesce(round(CASE WHEN c > 0 THEN 100 * confirmed / c END, 1), 0) AS confirmed_pct FROM cert JOIN t USING (industry)""")
def cert_share(spark, sf_dir):
    return B.method_shares(materialize(cert_method(spark, sf_dir), "cert"))


@query(f"""WITH {AUTH}, den AS (SELECT method, sum(registered) AS n FROM a GROUP BY 1), num AS (SELECT method, sum(confirmed) AS n FROM b GROUP BY 1), e AS (SELECT count(*) AS n FROM bad)
SELECT 'K1_numerator_has_methods' AS code, CASE WHEN coalesce(sum(n) FILTER (method = '{N.MISSING_AUTH}'), 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS level, CAST(coalesce(sum(n) FILTER (method = '{N.MISSING_AUTH}'), 0) AS DOUBLE) AS detail FROM num
UNION ALL SELECT 'K2_no_ghost_methods', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) AS DOUBLE) FROM num WHERE n > 0 AND method NOT IN (SELECT method FROM den WHERE n > 0)
UNION ALL SELECT 'K3_numerator_complete', CASE WHEN coalesce(sum(n), 0) <> (SELECT n FROM e) THEN 'FAIL' ELSE 'PASS' END, CAST(abs(coalesce(sum(n), 0) - (SELECT n FROM e)) AS DOUBLE) FROM num
UNION ALL SELECT 'K4_denominator_has_methods', CASE WHEN coalesce(sum(n) FILTER (method = '{N.MISSING_AUTH}'), 0) / sum(n) > 0.05 THEN 'WARN' ELSE 'PASS' END, CAST(coalesce(round(coalesce(sum(n) FILTER (method = '{N.MISSING_AUTH}'), 0) / sum(n), 4), 0) AS DOUBLE) FROM den""")
def cert_checks(spark, sf_dir):
    _, annotated, _ = _inputs(spark, sf_dir)
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    org = c.select(F.concat(F.lit("u"), "c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("t"))
    by = lambda df: df.select("user_id").distinct().join(org, "user_id", "left").groupBy(N.auth_method(F.col("t")).alias("method")).agg(F.count("*").alias("n"))
    bad = materialize(annotated.where(F.col("remark_first") == N.CONFIRMED).select("user_id").distinct(), "bad")
    return K.auth_checks(by(_registered(spark, sf_dir)), by(bad), bad.count())


CHANNEL_SQL = "(SELECT industry, 'professional' AS channel, professional AS n FROM {0} UNION ALL SELECT industry, 'shop', shop FROM {0} UNION ALL SELECT industry, 'ad', ad FROM {0})"
LATER = f"{SOURCES}, {SPLIT}, reg_split AS (SELECT * FROM sums WHERE NOT is_overall), bad_split AS (SELECT first_trade_name AS industry, count(*) FILTER (apply_source = 'SELLER_PASS') AS shop, count(*) FILTER (apply_source = 'AD_PASS') AS ad, count(*) FILTER (apply_source NOT IN ('SELLER_PASS', 'AD_PASS')) AS professional FROM latest WHERE certificate_type = 4 GROUP BY 1)"


@query(f"""WITH {LATER}, j AS (SELECT r.industry, r.channel, r.n AS registered, coalesce(v.n, 0) AS violated FROM {CHANNEL_SQL.format('reg_split')} r LEFT JOIN {CHANNEL_SQL.format('bad_split')} v ON r.industry = v.industry AND r.channel = v.channel),
t AS (SELECT *, sum(registered) OVER (PARTITION BY industry) AS rt, sum(violated) OVER (PARTITION BY industry) AS vt FROM j)
SELECT industry, channel, registered, violated, round(CASE WHEN rt > 0 THEN 100 * registered / rt ELSE 0 END, 1) AS registered_pct, round(CASE WHEN vt > 0 THEN 100 * violated / vt ELSE 0 END, 1) AS violated_pct,
round(CASE WHEN registered > 0 AND vt > 0 THEN (100 * violated / vt) / (100 * registered / rt) END, 2) AS lift FROM t""")
def source_drill(spark, sf_dir):
    s = X.settlement(spark, sf_dir)
    split = R.source_split(R.registered_sources(s)).where("not is_overall")
    last = R.latest_registration(s).where("certificate_type = 4")
    channel = N.source_bucket(F.col("apply_source"))
    bad = last.groupBy(F.col("first_trade_name").alias("industry")).agg(*[F.count_if(channel == c).alias(c) for c in B.CHANNELS])
    return B.source_lift(split, bad)


@query(f"""WITH {SOURCES}, {SPLIT}, o AS (SELECT * FROM sums WHERE is_overall) SELECT channel, n AS accounts, round(100 * n / (SELECT professional + shop + ad FROM o), 1) AS percent, whole FROM
(SELECT 'professional' AS channel, professional AS n FROM o UNION ALL SELECT 'shop', shop FROM o UNION ALL SELECT 'ad', ad FROM o), (VALUES (true), (false)) w(whole)""")
def source_share(spark, sf_dir):
    split = materialize(R.source_split(R.registered_sources(X.settlement(spark, sf_dir))), "split")
    return B.channel_shares(split).withColumn("whole", F.lit(True)).unionByName(B.channel_shares(split.where("not is_overall")).withColumn("whole", F.lit(False)))


# -- baselines

POOLED = f"""{X.ANNOTATED_SQL}, sus AS (SELECT cluster_id FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1 HAVING count(user_id) >= 3), fx_full AS (SELECT * FROM fx_cluster WHERE trade_second_name <> 'blog'),
pool AS (SELECT * FROM fx_cluster WHERE cluster_id >= 0 AND cluster_id IN (SELECT cluster_id FROM fx_cluster GROUP BY 1 HAVING bool_or(is_target_user) AND count(DISTINCT user_id) >= 2)),
u AS (SELECT user_id FROM fx_full UNION SELECT user_id FROM fx_cluster WHERE cluster_id >= 0),
f1 AS (SELECT user_id, min_by(trade_first_name, row_idx) AS a, min_by(trade_second_name, row_idx) AS b FROM fx_full GROUP BY 1), t1 AS (SELECT user_id, min_by(trade_first_name, row_idx) AS a, min_by(trade_second_name, row_idx) AS b FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1),
flags AS (SELECT CASE WHEN f1.user_id IS NOT NULL THEN f1.a ELSE t1.a END AS industry, CASE WHEN f1.user_id IS NOT NULL THEN f1.b ELSE t1.b END AS industry2, u.user_id IN (SELECT user_id FROM fx_cluster WHERE cluster_id >= 0) AS c,
  u.user_id IN (SELECT user_id FROM fx_cluster JOIN sus USING (cluster_id)) AS s, u.user_id IN (SELECT user_id FROM pool) AS p, u.user_id IN (SELECT user_id FROM fx_annotated WHERE remark_first = '{N.CONFIRMED}') AS v FROM u LEFT JOIN f1 USING (user_id) LEFT JOIN t1 USING (user_id))"""
COUNTED = "count(*) AS registered, count(*) FILTER (c) AS clustered, count(*) FILTER (s) AS suspected, count(*) FILTER (p) AS annotated, count(*) FILTER (v) AS confirmed FROM flags"


def _pooled(spark: SparkSession, sf_dir: str, level: int) -> DataFrame:
    rows, annotated, _ = _inputs(spark, sf_dir)
    return R.pool_baseline(rows.where("trade_second_name <> 'blog'"), rows, C.suspect_clusters(rows, least=3), W.annotation_task(rows), annotated, level)


@query(f"WITH {POOLED} SELECT industry, {COUNTED} GROUP BY 1")
def industry_baseline_l1(spark, sf_dir):
    return _pooled(spark, sf_dir, 1)


@query(f"WITH {POOLED} SELECT industry, industry2, {COUNTED} GROUP BY 1, 2")
def industry_baseline_l2(spark, sf_dir):
    return _pooled(spark, sf_dir, 2)


@query(f"WITH {POOLED}, b AS (SELECT industry, {COUNTED} GROUP BY 1), r AS (SELECT industry, annotated, confirmed, round(100 * confirmed / annotated, 2) AS rate FROM b WHERE annotated > 0) SELECT *, row_number() OVER (ORDER BY rate DESC, industry) - 1 AS place FROM r")
def accuracy_rank(spark, sf_dir):
    return B.accuracy_rank(_pooled(spark, sf_dir, 1))


# -- weeks

WEEK_SQL = f"{X.SETTLEMENT_SQL}, w AS (SELECT strftime(date_trunc('week', pro_settle_date), '%Y-%m-%d') AS week, first_trade_name AS industry, count(*) AS sampled, count(*) FILTER (apply_source = 'AD_PASS') AS violated FROM fx_settlement GROUP BY ALL)"


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = X.settlement(spark, sf_dir).withColumn("week", F.date_format(F.date_trunc("week", "pro_settle_date"), "yyyy-MM-dd"))
    return s.groupBy("week", F.col("first_trade_name").alias("industry")).agg(F.count("*").alias("sampled"), F.count_if(F.col("apply_source") == "AD_PASS").alias("violated"))


WEEK_A, WEEK_B = "1996-01-08", "1996-01-01"


@query(f"""WITH {WEEK_SQL}, c AS (SELECT industry, sampled AS n FROM w WHERE week = '{WEEK_A}'), p AS (SELECT industry, sampled AS n FROM w WHERE week = '{WEEK_B}'), b AS (SELECT industry, coalesce(c.n, 0) AS current, coalesce(p.n, 0) AS previous FROM c FULL JOIN p USING (industry))
SELECT industry, current, previous, current - previous AS delta, round(CASE WHEN previous <> 0 THEN (current - previous) / previous END, 4) AS delta_share, least(current, previous) AS base, greatest(current - previous, 0) AS increase FROM b""")
def registered_stack(spark, sf_dir):
    w = _weeks(spark, sf_dir)
    return B.stacked_change(R.compare_weeks(w.where(F.col("week") == WEEK_A), w.where(F.col("week") == WEEK_B), "industry", "sampled"))


@query(f"""WITH {WEEK_SQL}, t AS (SELECT CAST(coalesce(sum(sampled) FILTER (week = '{WEEK_A}'), 0) AS BIGINT) AS current, CAST(coalesce(sum(sampled) FILTER (week = '{WEEK_B}'), 0) AS BIGINT) AS previous FROM w)
SELECT *, current - previous AS delta, round(CASE WHEN previous <> 0 THEN 100 * (current - previous) / previous END, 1) AS delta_pct FROM t""")
def registered_overall(spark, sf_dir):
    w = _weeks(spark, sf_dir)
    return B.overall_change(R.compare_weeks(w.where(F.col("week") == WEEK_A), w.where(F.col("week") == WEEK_B), "industry", "sampled"))


@query(f"WITH {WEEK_SQL} SELECT max(week) AS week, 'known' AS asked FROM w WHERE week < '{WEEK_A}' UNION ALL SELECT max(week), 'unknown' FROM w")
def prev_week(spark, sf_dir):
    w = _weeks(spark, sf_dir)
    return B.previous_of(w, WEEK_A).withColumn("asked", F.lit("known")).unionByName(B.previous_of(w, "0000").withColumn("asked", F.lit("unknown")))


@query(f"""WITH {WEEK_SQL}, a AS (SELECT industry, violated / sampled AS s FROM w WHERE week = '{WEEK_A}'), b AS (SELECT industry, violated / sampled AS s FROM w WHERE week = '{WEEK_B}')
SELECT industry, round(a.s, 6) AS current, round(b.s, 6) AS previous, round(a.s - b.s, 6) AS delta FROM a JOIN b USING (industry) WHERE abs(a.s - b.s) >= 0.0001""")
def conc_compare(spark, sf_dir):
    return R.concentration_moves(_weeks(spark, sf_dir), WEEK_A, WEEK_B)


@query(f"""WITH {WEEK_SQL}, m AS (SELECT week, industry, violated / sampled AS c FROM w WHERE industry IN ('BUILDING', 'MACHINERY')) SELECT week, round(100 * max(c) FILTER (industry = 'BUILDING'), 2) AS overall, round(100 * max(c) FILTER (industry = 'MACHINERY'), 2) AS finance FROM m GROUP BY week ORDER BY week DESC LIMIT 12""")
def trend(spark, sf_dir):
    m = _weeks(spark, sf_dir).select("week", F.concat("industry", F.lit("_sample_v2")).alias("sample_group"), (F.col("violated") / F.col("sampled")).alias("concentration"))
    return R.trend(m, {"BUILDING": "overall", "MACHINERY": "finance"}).select("week", "overall", "finance")


@query(f"""WITH {WEEK_SQL}, t AS (SELECT week, 100.0 * sum(violated) / sum(sampled) AS pct FROM w GROUP BY 1), l AS (SELECT week, round(pct, 6) AS pct, lag(pct) OVER (ORDER BY week) AS p, pct AS x FROM t)
SELECT week, pct, round(p, 6) AS previous, round(x - p, 6) AS delta, abs(x - p) < 0.005 AS is_flat FROM l""")
def kpi_delta(spark, sf_dir):
    t = _weeks(spark, sf_dir).groupBy("week").agg((100 * F.sum("violated") / F.sum("sampled")).alias("pct")).withColumn("one", F.lit(1))
    return R.prev_value(t, "one", "week", "pct").select("week", *[F.round(c, 6).alias(c) for c in ("pct", "previous", "delta")], "is_flat")


@query(f"WITH {WEEK_SQL}, k AS (SELECT DISTINCT week FROM w ORDER BY week DESC LIMIT 3) SELECT w.* FROM w JOIN k USING (week)")
def last_n_weeks(spark, sf_dir):
    return B.last_weeks(_weeks(spark, sf_dir), 3)


@query(f"""WITH {WEEK_SQL}, t AS (SELECT week, CAST(sum(sampled) AS BIGINT) AS n, min(sampled) < 5 AS is_baseline FROM w GROUP BY 1) SELECT week, n FROM t WHERE NOT is_baseline ORDER BY week DESC LIMIT 5""")
def list_limit(spark, sf_dir):
    t = _weeks(spark, sf_dir).groupBy("week").agg(F.sum("sampled").alias("n"), (F.min("sampled") < 5).alias("is_baseline"))
    return B.recent(t, ["week"], 5, without="is_baseline").select("week", "n")


@query(f"WITH {SOURCES}, {SPLIT} SELECT industry, row_number() OVER (ORDER BY is_overall DESC, professional DESC, industry) - 1 AS place FROM sums")
def sort_overall_first(spark, sf_dir):
    return B.overall_first(R.source_split(R.registered_sources(X.settlement(spark, sf_dir))), "professional").select("industry", "place")


@query("SELECT event_id, row_number() OVER (ORDER BY CASE WHEN value > 50 THEN value END DESC NULLS LAST, event_id) - 1 AS place FROM events")
def sort_nulls_last(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.when(F.col("value") > 50, F.col("value")).alias("v"))
    return B.nulls_last(e, "v", "event_id").select("event_id", "place")


@query("""WITH r AS (SELECT event_id AS tag, CASE WHEN event_type = 'view' THEN 'upload' ELSE 'cluster' END AS kind, ts AS created_at FROM events)
SELECT tag, row_number() OVER (ORDER BY kind = 'upload' DESC, CASE WHEN kind = 'upload' THEN created_at END DESC NULLS LAST, tag DESC) - 1 AS place FROM r""")
def run_list_sort(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("tag"), F.when(F.col("event_type") == "view", "upload").otherwise("cluster").alias("kind"), F.col("ts").alias("created_at"))
    return B.run_order(e).select("tag", "place")


def _run_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    w = _weeks(spark, sf_dir).withColumn("run_id", F.col("week"))
    runs = w.select("run_id", "week").distinct()
    metrics = w.select("run_id", F.col("industry").alias("sample_group"), F.round(F.col("violated") / F.col("sampled"), 4).alias("concentration"))
    return {"runs": runs, "metrics": metrics, "sample_distribution": w.select("run_id", "industry", F.col("sampled").alias("count")), "violation_distribution": w.select("run_id", "industry", F.col("violated").alias("violated_count"))}


@query(f"WITH {WEEK_SQL} SELECT week AS run_id, week, industry AS sample_group, round(violated / sampled, 4) AS concentration FROM w")
def join_run_metric(spark, sf_dir):
    t = _run_tables(spark, sf_dir)
    return B.run_metrics(t["runs"], t["metrics"])


@query(f"""WITH {WEEK_SQL}, o AS (SELECT *, row_number() OVER (ORDER BY industry) - 1 AS place FROM w WHERE week = '{WEEK_A}') SELECT 'runs' AS list, 0 AS place, concat('{{"week":"', '{WEEK_A}', '"}}') AS row
UNION ALL SELECT 'sample_distribution', place, concat('{{"industry":"', industry, '","count":', CAST(sampled AS VARCHAR), '}}') FROM o UNION ALL SELECT 'violation_distribution', place, concat('{{"industry":"', industry, '","violated_count":', CAST(violated AS VARCHAR), '}}') FROM o""")
def run_detail(spark, sf_dir):
    t = _run_tables(spark, sf_dir)
    del t["metrics"]  # its numbers are written in another form by either side
    return B.run_detail(t, WEEK_A, {"runs": ["week"], "sample_distribution": ["industry"], "violation_distribution": ["industry"]})


# -- extracts


@query(f"""WITH {X.SETTLEMENT_SQL}, d AS (SELECT max(pro_settle_date) AS day FROM fx_settlement WHERE {SCOPE}), base AS (SELECT DISTINCT user_id, pro_settle_date, pro_settle_date = day AS is_target_user, CASE WHEN pro_settle_date = day THEN 'target_day' ELSE 'history_7d' END AS source_window FROM fx_settlement, d WHERE {SCOPE} AND pro_settle_date BETWEEN day - 6 AND day),
trade AS (SELECT DISTINCT user_id, first_trade_name AS trade_first_name, apply_source AS trade_second_name FROM fx_settlement),
one AS (SELECT CAST(vec_id AS VARCHAR) AS user_id, concat('v/', CAST(vec_id % 400 AS VARCHAR)) AS qualification_url, max(CAST(label AS VARCHAR)) AS embeds FROM embeddings GROUP BY 1, 2)
SELECT user_id, pro_settle_date, is_target_user, source_window, trade_first_name, trade_second_name, qualification_url, embeds FROM base LEFT JOIN trade USING (user_id) JOIN one USING (user_id) WHERE embeds <> ''""")
def join_window_extract(spark, sf_dir):
    s = X.settlement(spark, sf_dir)
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    images = e.select(F.col("vec_id").cast("string").alias("user_id"), F.concat(F.lit("v/"), F.col("vec_id") % 400).alias("qualification_url"), F.col("label").cast("string").alias("embeds"))
    day = s.where("user_apply_type = 'initAudit' and certificate_type in (2, 4)").agg(F.max("pro_settle_date")).first()[0]
    return R.extract_window(s, s.select("user_id", "first_trade_name", F.col("apply_source").alias("second_trade_name")), images, F.lit(day))


@query(f"""WITH {X.SETTLEMENT_SQL}, s AS (SELECT user_id, pro_settle_date FROM fx_settlement WHERE certificate_type = 2), days AS (SELECT DISTINCT pro_settle_date AS day FROM s)
SELECT day, count(*) AS registrations, count(DISTINCT user_id) AS accounts, count(DISTINCT user_id) FILTER (pro_settle_date = day) AS target_accounts FROM days JOIN s ON pro_settle_date BETWEEN day - 6 AND day GROUP BY 1""")
def window_7d_daily(spark, sf_dir):
    return R.daily_windows(X.settlement(spark, sf_dir).where("certificate_type = 2"))


@query(f"""WITH {X.SETTLEMENT_SQL}, p AS (SELECT DISTINCT strftime(pro_settle_date, '%Y%m%d') AS dtm FROM fx_settlement) SELECT (SELECT max(dtm) FROM p) AS latest, (SELECT max(dtm) FROM p WHERE dtm >= '19980101') AS since, CASE WHEN '19960105' IN (SELECT dtm FROM p) THEN '19960105' WHEN '19960104' IN (SELECT dtm FROM p) THEN '19960104' END AS probed""")
def scan_partitions(spark, sf_dir):
    p = X.settlement(spark, sf_dir).select(F.date_format("pro_settle_date", "yyyyMMdd").alias("dtm"))
    found = (tables.latest_partition(p), tables.latest_partition(p, since="19980101"), tables.first_filled_partition(p, ["19960105", "19960104"]))
    return spark.createDataFrame([found], "latest string, since string, probed string")


@query("""WITH i AS (SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS qualification_url, CAST(ts AS DATE) AS settle_date, event_id AS embeds FROM events), asked AS (SELECT DISTINCT user_id FROM i WHERE user_id LIKE '%7'),
x AS (SELECT *, true AS t FROM i WHERE user_id IN (SELECT user_id FROM asked) UNION ALL SELECT *, false FROM i WHERE settle_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-03')
SELECT user_id, qualification_url, bool_or(t) AS is_target_user FROM x GROUP BY 1, 2""")
def fetch_emb_targets(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("qualification_url"), F.to_date("ts").alias("settle_date"), F.col("event_id").alias("embeds"))
    return tables.fetch_targets(e, e.where("user_id like '%7'"), ("2024-01-02", "2024-01-03")).select("user_id", "qualification_url", "is_target_user")


@query("""SELECT user_id, event_type AS order_id, list_sort(list_distinct(list(CASE WHEN value > 50 THEN 'stop' ELSE 'pass' END))) AS actions, list_sort(list_distinct(list(concat('t', CAST(event_id % 3 AS VARCHAR))))) AS tags,
max_by(event_id, event_id) FILTER (value > 80) AS last_pair FROM events GROUP BY 1, 2""")
def audit_fold(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    pair = F.concat(F.lit('[{"query_img_url": "'), F.col("event_id"), F.lit('", "pixel_similarity": 0.5}]'))
    records = e.select("user_id", F.col("event_type").alias("order_id"), F.lit(0).cast("long").alias("audit_ms"), F.when(F.col("value") > 50, "stop").otherwise("pass").alias("action"), F.concat(F.lit("t"), F.col("event_id") % 3).alias("tag"), F.when(F.col("value") > 80, pair).otherwise("[]").alias("pairs_json"), F.col("event_id").alias("seq"))
    return R.fold_audits(records).select("user_id", "order_id", "actions", "tags", F.try_element_at("pairs", F.lit(1))["query_img_url"].cast("long").alias("last_pair"))


# -- checks


def _expanded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows, _, samples = _inputs(spark, sf_dir)
    return rows, samples, materialize(P.expand_clusters(rows, samples), "expanded")


def _checks_sql(table: str) -> str:
    """The ten checks recomputed over ``table``, a variant of ``expanded``."""
    bad = {
        "A1_clusters_are_those_hit": f"abs((SELECT count(DISTINCT cluster_id) FROM {table} WHERE cluster_id >= 0) - (SELECT count(*) FROM h2))",
        "A2_samples_are_those_matched": f"abs((SELECT count(DISTINCT user_id) FROM {table} WHERE is_sample_user) - (SELECT count(*) FROM mt))",
        "A3_matched_and_absent_are_all": "abs((SELECT count(*) FROM mt) + (SELECT count(DISTINCT user_id) FROM fx_sample WHERE user_id NOT IN (SELECT user_id FROM fx_cluster)) - (SELECT count(DISTINCT user_id) FROM fx_sample))",
        "A4_no_sample_as_expanded": f"(SELECT count(DISTINCT user_id) FROM {table} WHERE is_sample_user AND user_id IN (SELECT user_id FROM {table} WHERE NOT is_sample_user))",
        "A5_rows_once": f"(SELECT count(*) - count(DISTINCT (user_id, qualification_url)) FROM {table})",
        "A6_no_account_missing": f"(SELECT count(DISTINCT user_id) FROM fx_cluster WHERE cluster_id IN (SELECT cluster_id FROM h2) AND user_id NOT IN (SELECT user_id FROM {table}))",
        "A7_no_row_missing": f"(SELECT count(DISTINCT (user_id, qualification_url)) FROM fx_cluster c WHERE cluster_id IN (SELECT cluster_id FROM h2) AND NOT EXISTS (SELECT 1 FROM {table} t WHERE t.user_id = c.user_id AND t.qualification_url = c.qualification_url))",
        "A8_canonical_order": "0",
        "A9_no_single_account": f"(SELECT count(*) FROM (SELECT cluster_id FROM {table} WHERE cluster_id >= 0 GROUP BY 1 HAVING count(DISTINCT user_id) = 1))",
        "A10_only_single_accounts_dropped": "(SELECT count(*) FROM solo WHERE cluster_id NOT IN (SELECT cluster_id FROM one))",
    }
    rows = " UNION ALL ".join(f"SELECT '{code}' AS code, CAST({sql} AS BIGINT) AS detail" for code, sql in bad.items())
    return f"SELECT code, detail = 0 AS ok, detail FROM ({rows})"


HITS = f"{EXPAND_B}, one AS (SELECT cluster_id FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1 HAVING count(DISTINCT user_id) = 1), h2 AS (SELECT cluster_id FROM hit WHERE cluster_id NOT IN (SELECT cluster_id FROM solo)), mt AS (SELECT DISTINCT user_id FROM fx_sample WHERE user_id IN (SELECT user_id FROM fx_cluster))"
BROKEN = "broken AS (SELECT * FROM expanded WHERE cluster_id <> 0 OR is_sample_user UNION ALL SELECT * FROM expanded WHERE cluster_id = 1 UNION ALL SELECT * REPLACE (NOT is_sample_user AS is_sample_user) FROM expanded WHERE cluster_id = 2)"


@query(f"WITH {HITS} {_checks_sql('expanded')}")
def expansion_checks(spark, sf_dir):
    return K.expansion_checks(*_expanded(spark, sf_dir))


@query(f"WITH {HITS}, {BROKEN} {_checks_sql('broken')}")
def expansion_checks_broken(spark, sf_dir):
    """Rows of one cluster missing, of another twice, of a third with the wrong flag."""
    rows, samples, good = _expanded(spark, sf_dir)
    wrong = good.where("cluster_id = 2").withColumn("is_sample_user", ~F.col("is_sample_user"))
    broken = good.where("cluster_id <> 0 or is_sample_user").unionByName(good.where("cluster_id = 1")).unionByName(wrong)
    return K.expansion_checks(rows, samples, materialize(broken, "broken"))


WEEKLY = f"""{X.SETTLEMENT_SQL}, {CHECKED}, {EXPAND_B.replace(X.CLUSTER_SQL + ', ' + X.SAMPLE_SQL + ', ', '')}, {PER_USER}, result AS (SELECT e.*, a.remark_first, CASE WHEN a.remark_first = '{N.CLEAN}' THEN '{N.PASSED}' ELSE '{N.VIOLATION}' END AS image_label FROM expanded e JOIN fx_annotated a USING (row_idx)),
bad2 AS (SELECT DISTINCT user_id FROM result WHERE cluster_id <> -1 AND remark_first = '{N.CONFIRMED}'),
again AS (SELECT sample_group, count(*) AS d, count(bad2.user_id) AS n, round(count(bad2.user_id) / count(*), 4) AS c FROM den LEFT JOIN bad2 USING (user_id) GROUP BY 1),
ind AS (SELECT user_id, min_by(trade_first_name, row_idx) AS i1, min_by(trade_second_name, row_idx) AS i2 FROM fx_cluster GROUP BY user_id),
s2 AS (SELECT i1, i2, count(*) AS sampled, count(bad2.user_id) AS violated FROM (SELECT DISTINCT user_id FROM fx_sample WHERE sample_group = 'overall') JOIN ind USING (user_id) LEFT JOIN bad2 USING (user_id) GROUP BY 1, 2),
accounts AS (SELECT user_id, bool_or(cluster_id >= 0) AS c, user_id IN (SELECT user_id FROM expanded WHERE cluster_id >= 0) AS p, user_id IN (SELECT user_id FROM bad2) AS v FROM fx_cluster GROUP BY 1),
sums AS (SELECT count(*) FILTER (p) AS ann, count(*) FILTER (v) AS cfm FROM accounts)"""


def _week(spark: SparkSession, sf_dir: str) -> dict:
    """What the checks of a week take."""
    rows, annotated, samples = _inputs(spark, sf_dir)
    pool = materialize(P.expand_clusters(rows, samples), "pool")
    result = pool.join(annotated.select("row_idx", "remark_first"), "row_idx").withColumn("image_label", N.image_label(F.col("remark_first"), F.lit(None).cast("string")))
    result = materialize(result, "result")
    confirmed = result.where("cluster_id <> -1").where(F.col("remark_first") == N.CONFIRMED).select("user_id").distinct().withColumn("v", F.lit(True))
    overall = samples.where("sample_group = 'overall'").select("user_id").distinct().join(R.first_industry(rows), "user_id").join(confirmed, "user_id", "left")
    level2 = materialize(overall.groupBy("industry1", "industry2").agg(F.count("*").alias("count"), F.count_if("v").alias("violated_count")), "dist")
    level1 = level2.groupBy("industry1").agg(F.sum("count").alias("count"), F.sum("violated_count").alias("violated_count"))
    base = [R.pool_baseline(rows, rows, C.suspect_clusters(rows), pool.where("cluster_id >= 0"), result.where("cluster_id <> -1"), k) for k in (1, 2)]
    cert = X.settlement(spark, sf_dir).groupBy(F.col("first_trade_name").alias("industry"), "apply_source").agg(F.count("*").alias("registered"), (F.count("*") + 1).alias("confirmed"))
    board = {"metrics": R.concentration_checked(samples, rows, annotated), "sample": level1, "violation": level1, "sample_l2": level2, "violation_l2": level2, "baseline": base[0], "baseline_l2": base[1], "cert": cert}
    before = spark.range(1).select(F.lit(4).alias("annotated"), F.lit(1).alias("confirmed"))
    return {"samples": samples, "rows": rows, "annotated": result, "pool": pool, "board": board, "previous": before}


@query(f"""WITH {WEEKLY}, l AS (SELECT count(DISTINCT image_label) AS labels, count(remark_first) AS remarks FROM result WHERE cluster_id <> -1), e AS (SELECT count(DISTINCT user_id) AS everyone, count(DISTINCT user_id) FILTER (cluster_id <> -1) AS inside FROM expanded),
c AS (SELECT first_trade_name, apply_source, count(*) AS r FROM fx_settlement GROUP BY 1, 2)
SELECT 'C1_labelled_by_hand' AS code, CASE WHEN labels <= 1 OR remarks = 0 THEN 'FAIL' ELSE 'PASS' END AS level, CAST(labels AS DOUBLE) AS detail FROM l
UNION ALL SELECT 'C2_pool_is_result', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(n AS DOUBLE) FROM (SELECT abs((SELECT count(*) FROM expanded) - (SELECT count(*) FROM result)) + (SELECT count(DISTINCT user_id) FROM expanded WHERE user_id NOT IN (SELECT user_id FROM result)) AS n)
UNION ALL SELECT 'C3_recomputed', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) AS DOUBLE) FROM again LEFT JOIN checked USING (sample_group) WHERE coalesce(abs(checked.concentration - again.c) > 1e-4, true)
UNION ALL SELECT concat('C4_', t, '_total'), CASE WHEN got <> want THEN 'FAIL' ELSE 'PASS' END, CAST(abs(got - want) AS DOUBLE) FROM (SELECT t, CASE WHEN t LIKE 'sample%' THEN (SELECT sum(sampled) FROM s2) ELSE (SELECT sum(violated) FROM s2) END AS got, CASE WHEN t LIKE 'sample%' THEN (SELECT d FROM again WHERE sample_group = 'overall') ELSE (SELECT n FROM again WHERE sample_group = 'overall') END AS want FROM (VALUES ('sample'), ('violation'), ('sample_l2'), ('violation_l2')) x(t))
UNION ALL SELECT concat('C5_', t, '_subset'), CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(n AS DOUBLE) FROM (SELECT 'baseline' AS t, (SELECT count(*) FROM (SELECT i1 FROM accounts JOIN ind USING (user_id) GROUP BY i1 HAVING count(*) FILTER (p) > count(*) FILTER (c))) AS n UNION ALL SELECT 'baseline_l2', (SELECT count(*) FROM (SELECT i1, i2 FROM accounts JOIN ind USING (user_id) GROUP BY i1, i2 HAVING count(*) FILTER (p) > count(*) FILTER (c))))
UNION ALL SELECT 'C6_annotated_in_clusters', CASE WHEN everyone > inside AND ann = everyone THEN 'FAIL' WHEN ann <> inside THEN 'WARN' ELSE 'PASS' END, CAST(abs(ann - inside) AS DOUBLE) FROM e, sums
UNION ALL SELECT 'C7_accuracy_drift', CASE WHEN coalesce(abs(cfm / ann - 1 / 4) > 0.1, true) THEN 'WARN' ELSE 'PASS' END, round(abs(cfm / ann - 1 / 4), 4) FROM sums
UNION ALL SELECT 'C8a_no_ghost_rows', CASE WHEN count(*) FILTER (r = 0) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) FILTER (r = 0) AS DOUBLE) FROM c
UNION ALL SELECT 'C8b_numerator_within', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) AS DOUBLE) FROM (SELECT first_trade_name FROM c GROUP BY 1 HAVING sum(r + 1) > sum(r))""")
def weekly_checks(spark, sf_dir):
    return K.weekly_checks(**_week(spark, sf_dir))


@query(f"""WITH {WEEKLY}, uploaded AS (SELECT * FROM expanded WHERE user_id <> (SELECT min(user_id) FROM expanded)), l AS (SELECT count(DISTINCT image_label) AS labels, count(remark_first) AS remarks FROM result WHERE cluster_id <> -1), e AS (SELECT count(DISTINCT user_id) AS everyone, count(DISTINCT user_id) FILTER (cluster_id <> -1) AS inside FROM uploaded),
c AS (SELECT first_trade_name, apply_source, count(*) AS r FROM fx_settlement GROUP BY 1, 2)
SELECT 'C1_labelled_by_hand' AS code, CASE WHEN labels <= 1 OR remarks = 0 THEN 'FAIL' ELSE 'PASS' END AS level, CAST(labels AS DOUBLE) AS detail FROM l
UNION ALL SELECT 'C2_pool_is_result', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(n AS DOUBLE) FROM (SELECT abs((SELECT count(*) FROM uploaded) - (SELECT count(*) FROM result)) + (SELECT count(DISTINCT user_id) FROM result WHERE user_id NOT IN (SELECT user_id FROM uploaded)) AS n)
UNION ALL SELECT 'C3_recomputed', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) AS DOUBLE) FROM again LEFT JOIN checked USING (sample_group) WHERE coalesce(abs(checked.concentration + CASE WHEN sample_group = 'overall' THEN 0.01 ELSE 0 END - again.c) > 1e-4, true)
UNION ALL SELECT concat('C4_', t, '_total'), CASE WHEN got <> want THEN 'FAIL' ELSE 'PASS' END, CAST(abs(got - want) AS DOUBLE) FROM (SELECT t, CASE t WHEN 'sample' THEN (SELECT sum(sampled) + 1 FROM s2) WHEN 'sample_l2' THEN (SELECT sum(sampled) FROM s2) WHEN 'violation' THEN (SELECT sum(violated) FROM s2) ELSE (SELECT sum(violated) + 3 FROM s2) END AS got, CASE WHEN t LIKE 'sample%' THEN (SELECT d FROM again WHERE sample_group = 'overall') ELSE (SELECT n FROM again WHERE sample_group = 'overall') END AS want FROM (VALUES ('sample'), ('violation'), ('sample_l2'), ('violation_l2')) x(t))
UNION ALL SELECT concat('C5_', t, '_subset'), CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(n AS DOUBLE) FROM (SELECT 'baseline' AS t, (SELECT count(*) FROM (SELECT i1 FROM accounts JOIN ind USING (user_id) GROUP BY i1 HAVING count(*) FILTER (p) > count(*) FILTER (c))) AS n UNION ALL SELECT 'baseline_l2', (SELECT count(*) FROM (SELECT i1, i2 FROM accounts JOIN ind USING (user_id) GROUP BY i1, i2 HAVING count(*) FILTER (p) > count(*) FILTER (c))))
UNION ALL SELECT 'C6_annotated_in_clusters', CASE WHEN everyone > inside AND ann = everyone THEN 'FAIL' WHEN ann <> inside THEN 'WARN' ELSE 'PASS' END, CAST(abs(ann - inside) AS DOUBLE) FROM e, sums
UNION ALL SELECT 'C7_accuracy_drift', CASE WHEN coalesce(abs(cfm / ann - 1 / 4) > 0.1, true) THEN 'WARN' ELSE 'PASS' END, round(abs(cfm / ann - 1 / 4), 4) FROM sums
UNION ALL SELECT 'C8a_no_ghost_rows', CASE WHEN count(*) FILTER (r = 0) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) FILTER (r = 0) AS DOUBLE) FROM c
UNION ALL SELECT 'C8b_numerator_within', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) AS DOUBLE) FROM (SELECT first_trade_name FROM c GROUP BY 1 HAVING sum(r + 1) > sum(r))""")
def weekly_checks_broken(spark, sf_dir):
    """An account that was never uploaded, and three figures on the board that are not those of the week."""
    week = _week(spark, sf_dir)
    pool, board = week["pool"], week["board"]
    first = pool.agg(F.min("user_id").alias("user_id"))
    more = lambda df, column, n: df.select(column).unionByName(spark.range(1).select(F.lit(n).cast("long").alias(column)))
    off = F.col("concentration") + F.when(F.col("sample_group") == "overall", 0.01).otherwise(0.0)
    wrong = {"metrics": board["metrics"].withColumn("concentration", off), "sample": more(board["sample"], "count", 1), "violation_l2": more(board["violation_l2"], "violated_count", 3)}
    return K.weekly_checks(**week | {"pool": pool.join(F.broadcast(first), "user_id", "left_anti"), "board": board | wrong})  # one row


# -- pixels and the library of known images


@query("""WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT a.id AS row_idx, b.id AS dst, list_cosine_similarity(a.e, b.e) AS score FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0 AND b.id % 50 <> 0),
k AS (SELECT *, row_number() OVER (PARTITION BY row_idx ORDER BY score DESC, dst) AS r FROM s) SELECT row_idx, round(max(score), 4) AS top_score, max(score) >= 0.45 AS duplicate, list(dst ORDER BY r) AS similar FROM k WHERE r <= 5 GROUP BY 1""")
def dedupe_library(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    found = M.known_in_library(v.where("row_idx % 50 = 0"), v.where("row_idx % 50 <> 0"), least=0.45)
    return found.withColumn("top_score", F.round("top_score", 4))


MEANS = f"""{LABELS}, m AS (SELECT cluster_id, i, avg(x) AS x FROM (SELECT cluster_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(64)) AS i FROM (SELECT labels.cluster_id, list_transform(e, lambda q: q / sqrt(list_dot_product(e, e))) AS embedding FROM labels JOIN v ON v.id = labels.row_idx WHERE cluster_id >= 0)) GROUP BY 1, 2),
cent AS (SELECT cluster_id, list(x ORDER BY i) AS c FROM m GROUP BY 1), cp AS (SELECT a.cluster_id AS a, b.cluster_id AS b, list_cosine_similarity(a.c, b.c) AS score FROM cent a JOIN cent b ON a.cluster_id < b.cluster_id WHERE list_cosine_similarity(a.c, b.c) >= 0.3)"""


@query(f"WITH RECURSIVE {MEANS} SELECT a, b, round(score, 4) AS score FROM cp")
def cluster_pair_join(spark, sf_dir):
    rows = materialize(C.cluster_threshold(_vectors(spark, sf_dir), 0.4, 10), "labelled")
    return M.cluster_pairs(rows, 0.3).select("a", "b", F.round("score", 4).alias("score"))


@query(f"""WITH RECURSIVE {MEANS}, l AS (SELECT labels.cluster_id AS c, v.id, e FROM labels JOIN v ON v.id = labels.row_idx WHERE cluster_id >= 0), x AS (SELECT a, b, p.id AS src, q.id AS dst, list_cosine_similarity(p.e, q.e) AS score FROM cp JOIN l p ON p.c = a JOIN l q ON q.c = b)
SELECT a, b, src, dst, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY score DESC, src, dst) AS r FROM x) WHERE r = 1 AND score >= 0.3""")
def cluster_member_pairs(spark, sf_dir):
    rows = materialize(C.cluster_threshold(_vectors(spark, sf_dir), 0.4, 10), "labelled")
    return M.best_member_pairs(rows, M.cluster_pairs(rows, 0.3), 0.3, part=64).select("a", "b", "src", "dst", F.round("score", 4).alias("score"))


def _images(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    """64 x 64 images that vectors of one label share, but for the rows at the top that are each one's own."""
    own = (F.col("row_idx") % 4) * 60
    data = F.unhex(F.concat(F.repeat(F.md5(F.col("row_idx").cast("string")), own.cast("int")), F.repeat(F.md5(F.col("label").cast("string")), (768 - own).cast("int"))))
    return vectors.select("row_idx").join(labels, "row_idx").select("row_idx", F.lit(64).alias("h"), F.lit(64).alias("w"), data.alias("data"))


@query()
def cluster_pixel_match(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("row_idx"), "label")
    return M.cluster_pixels(v, _images(v, labels), near=0.3, rate=0.9, k=10, sure=0.99, merge=0.3, low=0.7).select("row_idx", "cluster_id")


def _moved_images(labelled: DataFrame) -> DataFrame:
    """120 x 120 views of one larger picture a label, each row's a few pixels away from the next one's."""

    def run(batches):
        for b in batches:
            out = []
            for row, label in zip(b["row_idx"].tolist(), b["label"].tolist()):
                rng = np.random.default_rng(label)
                picture = rng.integers(0, 256, (14, 14, 3)).astype(np.uint8).repeat(10, axis=0).repeat(10, axis=1)
                for x, y, side in rng.integers(0, 124, (60, 3)):
                    picture[y : y + 4 + side % 12, x : x + 4 + side % 9] = rng.integers(0, 256, 3)
                out.append(picture[row % 4 : row % 4 + 120, row % 3 * 2 : row % 3 * 2 + 120].tobytes())
            yield b.assign(h=120, w=120, data=out)[["row_idx", "h", "w", "data"]]

    return labelled.select("row_idx", "label").mapInPandas(run, "row_idx long, h int, w int, data binary")


@query()
def cluster_pixel_aligned(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("row_idx"), "label")
    images = materialize(_moved_images(labels), "moved-images")
    return M.cluster_pixels(_vectors(spark, sf_dir), images, near=0.4, k=10, merge=None, align=orb_align(300)).select("row_idx", "cluster_id")


@query("""WITH RECURSIVE v AS (SELECT vec_id AS id, vec_id % 8 AS d, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), w AS (SELECT unnest(range(6, 8)) AS day),
p AS (SELECT a.id AS src, b.id AS dst, a.d AS ad, b.d AS bd, list_cosine_similarity(a.e, b.e) AS score FROM v a JOIN v b ON a.id <> b.id WHERE list_cosine_similarity(a.e, b.e) >= 0.4),
k AS (SELECT * FROM (SELECT day, src, dst, row_number() OVER (PARTITION BY day, src ORDER BY score DESC, dst) AS r FROM p JOIN w ON ad BETWEEN day - 6 AND day AND bd BETWEEN day - 6 AND day) WHERE r <= 10),
b AS (SELECT day, src AS x, dst AS y FROM k UNION SELECT day, dst, src FROM k), reach(day, x, y) AS (SELECT day, x, x FROM b UNION SELECT reach.day, reach.x, b.y FROM reach JOIN b ON reach.day = b.day AND reach.y = b.x),
comp AS (SELECT day, x, min(y) AS c FROM reach GROUP BY day, x), sz AS (SELECT day, c, row_number() OVER (PARTITION BY day ORDER BY count(*) DESC, c) - 1 AS cid FROM comp GROUP BY day, c)
SELECT CAST(DATE '2026-03-01' + CAST(w.day AS INTEGER) AS DATE) AS day, v.id AS row_idx, CASE WHEN v.d = w.day THEN 'target_day' ELSE 'history_7d' END AS source_window, CAST(coalesce(cid, -1) AS INTEGER) AS cluster_id
FROM w JOIN v ON v.d BETWEEN w.day - 6 AND w.day LEFT JOIN comp ON comp.day = w.day AND comp.x = v.id LEFT JOIN sz ON sz.day = comp.day AND sz.c = comp.c""")
def window_clusters(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    days = [date(2026, 3, 1) + timedelta(k) for k in range(8)]
    store = WindowClusters(spark, new_path(spark, "windows"), least=0.4)
    found = []
    for k, day in enumerate(days):
        store.add_day(v.where(F.col("row_idx") % 8 == k), day)
        if k >= 6:  # whole weeks; the second one has lost a day and won one
            found.append(materialize(store.labels(day).select(F.lit(day).alias("day"), "row_idx", "source_window", "cluster_id"), "window-labels"))
    return found[0].unionByName(found[1])


@query(f"""WITH {X.SETTLEMENT_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id, apply_id % 5 ORDER BY apply_id DESC) AS r, count(*) OVER (PARTITION BY user_id, apply_id % 5) AS c FROM fx_settlement),
u AS (SELECT DISTINCT user_id FROM fx_settlement), b AS (SELECT u.user_id, p0.apply_id AS a0, p1.apply_id AS a1, p2.apply_id AS a2, p3.apply_id AS a3, p4.apply_id AS a4, coalesce(p3.c % 2 = 1, false) AS odd
  FROM u LEFT JOIN n p0 ON p0.user_id = u.user_id AND p0.apply_id % 5 = 0 AND p0.r = 1 LEFT JOIN n p1 ON p1.user_id = u.user_id AND p1.apply_id % 5 = 1 AND p1.r = 1 LEFT JOIN n p2 ON p2.user_id = u.user_id AND p2.apply_id % 5 = 2 AND p2.r = 1
  LEFT JOIN n p3 ON p3.user_id = u.user_id AND p3.apply_id % 5 = 3 AND p3.r = 1 LEFT JOIN n p4 ON p4.user_id = u.user_id AND p4.apply_id % 5 = 4 AND p4.r = 1),
s1 AS (SELECT *, coalesce(a2, a0, a1) AS x FROM b), s2 AS (SELECT *, CASE WHEN odd AND x IS NULL THEN a3 WHEN odd THEN NULL ELSE x END AS y FROM s1), z AS (SELECT user_id, CASE WHEN a4 IS NULL THEN y END AS apply_id FROM s2)
SELECT user_id, apply_id, apply_source, pro_settle_date FROM z JOIN fx_settlement USING (user_id, apply_id)""")
def stored_upserts(spark, sf_dir):
    """Registrations by account: put, added, put over, toggled, dropped, each a commit; compaction comes in between."""
    s = X.settlement(spark, sf_dir).select("user_id", "apply_id", "apply_source", "pro_settle_date")
    table = KeyedTable(spark, new_path(spark, "keyed"), s.schema, ["user_id"], compact_after=3)
    for k, operation in enumerate(("put", "add", "put", "toggle", "drop")):
        table.apply(s.where(F.col("apply_id") % 5 == k), operation, order="apply_id")
    return table.read()


@query(f"WITH {X.CLUSTER_SQL}, h AS (SELECT cluster_id FROM fx_cluster WHERE cluster_id <> -1 AND user_id ILIKE '%u1%') SELECT DISTINCT cluster_id, (SELECT count(*) FROM h) AS total FROM h ORDER BY cluster_id LIMIT 500")
def search_uid_indexed(spark, sf_dir):
    path = new_path(spark, "search")
    write_search_index(X.clusters(spark, sf_dir), path, buckets=16)
    return search_indexed(spark, path, "U1", buckets=16)


# -- samples and vectors, again in SQL

CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda z: ascii(z)::BIGINT)), lambda c, z: list_reduce(list_concat([xor(c, z)], [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT)"
RANKS = f"ranks AS (SELECT user_id, row_number() OVER (ORDER BY {CRC.format(chr(39).join(['concat(user_id, ', '_seed42', ')']))}, user_id) AS rank FROM (SELECT DISTINCT user_id FROM fx_cluster))"


@query(f"WITH {X.CLUSTER_SQL}, {RANKS} SELECT user_id, rank FROM ranks")
def hash_rank_sample(spark, sf_dir):
    return P.hash_rank(X.clusters(spark, sf_dir)).select("user_id", "rank")


@query(f"""SELECT CAST(c_custkey AS INTEGER) AS row_idx, c_mktsegment AS word, CASE WHEN c_custkey % 3 = 0 THEN true ELSE false END AS flag_short, CASE WHEN c_custkey % 3 < 2 THEN true ELSE false END AS flag_words, CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE CAST(c_custkey % 7 AS INTEGER) END AS cluster_id, CASE WHEN c_custkey % 4 <> 0 THEN round(c_acctbal, 2) END AS number FROM customer""")
def normalisers(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    flag = F.when(k % 3 == 0, " TRUE ").when(k % 3 == 1, "Yes").otherwise("no")
    cell = F.when(k % 5 == 0, "x").otherwise(F.concat(F.lit(" "), (k % 7).cast("string"), F.lit(".0")))
    number = F.when(k % 4 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal").cast("double"))
    return c.select(k.cast("int").alias("row_idx"), N.uid(F.concat(F.lit(" "), "c_mktsegment", F.lit("　"))).alias("word"), N.flag_short(flag).alias("flag_short"), N.flag_words(flag).alias("flag_words"), N.cluster_id(cell).alias("cluster_id"), F.round(N.number(number), 2).alias("number"))


@query(f"""WITH {X.SETTLEMENT_SQL}, w AS (SELECT DISTINCT pro_settle_date AS d FROM fx_settlement) SELECT d, CAST(date_trunc('week', d) AS DATE) - 7 AS monday, CAST(date_trunc('week', d) AS DATE) - 1 AS sunday, strftime(CAST(date_trunc('week', d) AS DATE) - 1, '%Y%m%d') AS dtm FROM w""")
def week_range(spark, sf_dir):
    d = X.settlement(spark, sf_dir).select(F.col("pro_settle_date").alias("d")).distinct()
    monday, sunday, dtm = S.previous_week(F.col("d"))
    return d.select("d", monday.alias("monday"), sunday.alias("sunday"), dtm.alias("dtm"))


@query(f"""WITH {X.ANNOTATED_SQL}, {ANN} SELECT DISTINCT remark_first FROM ann WHERE remark_first IN {BAD3}""")
def label_words(spark, sf_dir):
    rows, annotated, _ = _inputs(spark, sf_dir)
    return _cluster_annotations(annotated).where(F.col("remark_first").isin(*R.counts_for("all"))).select("remark_first").distinct()


@query("SELECT page_id, row_number() OVER (ORDER BY url DESC, page_id) - 1 AS place FROM pages")
def global_order(spark, sf_dir):
    return global_index(spark.read.parquet(f"{sf_dir}/pages.parquet"), [F.desc("url"), F.asc("page_id")], "place").select("page_id", "place")


# -- SQL of queries registered before, which take the pieces above

_CRC_OF_ID = CRC.format("concat(user_id, '_seed42')")
ORACLE_SQL["hash_sample"] = f"WITH {X.SETTLEMENT_SQL} SELECT user_id, {_CRC_OF_ID} AS hash FROM (SELECT DISTINCT user_id FROM fx_settlement) ORDER BY hash, user_id LIMIT 500"
HITS_SQL = f"""{X.CLUSTER_SQL}, {RANKS}, t AS (SELECT sqrt(-2 * ln(1 - (1 - (1 - 0.99) / 2))) AS t), z AS (SELECT t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1 + t * (1.432788 + t * (0.189269 + t * 0.001308))) AS z FROM t),
sizes AS (SELECT CAST(m AS DOUBLE) AS margin, CAST(ceil(z * z * 0.09 / (m * m) * n / (z * z * 0.09 / (m * m) + n - 1)) AS BIGINT) AS n FROM (VALUES (0.02), (0.025), (0.03), (0.035), (0.04), (0.05)) x(m), z, (SELECT count(DISTINCT user_id) AS n FROM fx_cluster)),
per AS (SELECT cluster_id, min(CASE WHEN user_id = 'u7' THEN 0 ELSE rank END) AS rank FROM fx_cluster JOIN ranks USING (user_id) WHERE cluster_id >= 0 GROUP BY 1),
hits AS (SELECT margin, n, (SELECT count(*) FROM per WHERE rank <= n) AS clusters FROM sizes)"""
ORACLE_SQL["predict_hits"] = f"WITH {HITS_SQL} SELECT * FROM hits"
ORACLE_SQL["choose_margin"] = f"""WITH {HITS_SQL}, o AS (SELECT *, clusters > 40 AS alarm, CASE WHEN clusters <= 40 AND margin = 0.02 THEN 0 WHEN clusters <= 40 AND margin = 0.03 THEN 1 WHEN clusters <= 40 THEN 2 ELSE 3 END AS o FROM hits)
SELECT margin, n, clusters, alarm FROM o ORDER BY o, CASE WHEN o = 3 THEN -margin ELSE margin END LIMIT 1"""
ORACLE_SQL["pick_representative"] = f"""WITH RECURSIVE {MEANS}, near AS (SELECT labels.cluster_id, row_idx, labels.user_id, concat('v/', CAST(row_idx AS VARCHAR)) AS qualification_url, list_cosine_similarity(v.e, c) AS s FROM labels JOIN v ON v.id = row_idx JOIN cent ON cent.cluster_id = labels.cluster_id),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(s, 9) DESC, row_idx) AS p, count(*) OVER (PARTITION BY cluster_id) AS cluster_size FROM near)
SELECT cluster_id, max(row_idx) FILTER (p = 1) AS row_idx, max(user_id) FILTER (p = 1) AS user_id, max(qualification_url) FILTER (p = 1) AS qualification_url, round(max(s) FILTER (p = 1), 4) AS similarity, list(qualification_url ORDER BY p) FILTER (p <= 5) AS ranked_urls, max(cluster_size) AS cluster_size FROM r GROUP BY 1"""


@query("""SELECT vec_id, len(embedding) AS dims, round(sqrt(list_dot_product(n, n)), 4) AS norm, list_position(embedding, list_max(embedding)) AS at, round(list_max(n), 3) AS largest
FROM (SELECT vec_id, embedding, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS n FROM embeddings)""")
def parse_embedding_figures(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return parse_embedding(spark, sf_dir).select("vec_id", F.size(v).alias("dims"), F.round(norm, 4).alias("norm"), F.array_position(v, F.array_max(v)).cast("int").alias("at"), F.round(F.array_max(v), 3).alias("largest"))


@query("SELECT first_trade_name, population, CASE WHEN first_trade_name IN ('BUILDING', 'MACHINERY') THEN population ELSE sample END AS sample FROM (" + ORACLE_SQL["sample_size"] + ")")
def full_take(spark, sf_dir):
    """Sample sizes where two industries are taken whole."""
    s = X.settlement(spark, sf_dir)
    g = s.groupBy("first_trade_name").agg(F.count_distinct("user_id").alias("population"), F.avg(F.when(F.col("apply_source") == "AD_PASS", 1.0).otherwise(0.0)).alias("p"))
    whole = F.col("first_trade_name").isin("BUILDING", "MACHINERY")
    return g.select("first_trade_name", "population", S.sample_size(F.col("p"), F.col("population"), take_all=whole).alias("sample"))


@query(f"WITH {X.SETTLEMENT_SQL} SELECT method, count(*) AS registrations FROM (SELECT CASE trim(apply_source) WHEN 'SELLER_PASS' THEN 'shops' WHEN 'AD_PASS' THEN 'advertising' WHEN '' THEN '{N.MISSING_AUTH}' ELSE trim(apply_source) END AS method FROM fx_settlement) GROUP BY 1")
def map_method(spark, sf_dir):
    """Registrations by the shown name of a type: named, as it is, or marked as absent."""
    shown = N.auth_method(F.col("apply_source"), {"SELLER_PASS": "shops", "AD_PASS": "advertising"})
    return X.settlement(spark, sf_dir).groupBy(shown.alias("method")).agg(F.count("*").alias("registrations"))


SKIPS = "c AS (SELECT vec_id, CASE WHEN vec_id % 11 = 3 THEN 0 WHEN vec_id % 13 = 5 THEN 1 WHEN vec_id % 17 = 6 THEN 2 ELSE 3 END AS k, len(embedding) AS n FROM embeddings)"


@query(f"""WITH {SKIPS} SELECT count(*) AS rows, count(*) FILTER (k = 3) AS valid, count(*) FILTER (k = 0) AS skipped_empty, count(*) FILTER (k IN (1, 2)) AS skipped_parse, CAST(max(n) AS INTEGER) AS dimension FROM c""")
def parse_embedding_skips(spark, sf_dir):
    """Cells that are blank, broken or one number short are counted."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    k, whole = F.col("vec_id"), F.to_json("embedding")
    cell = F.when(k % 11 == 3, F.when(k % 2 == 0, " ")).when(k % 13 == 5, F.concat(whole, F.lit(",x"))).when(k % 17 == 6, F.regexp_replace(whole, r",[^,]*\]$", "]")).otherwise(whole)
    return V.parse_counts(e.select("vec_id", cell.alias("embeds")), "vec_id")


@query(f"""WITH {X.ANNOTATED_SQL}, m AS (SELECT row_idx, user_id, qualification_url AS url FROM fx_annotated WHERE remark_first = '{N.CONFIRMED}'), a AS (SELECT user_id, qualification_url AS url, row_idx FROM fx_cluster WHERE row_idx % 4 = 0 AND row_idx % 61 < 50),
f AS (SELECT user_id, count(DISTINCT m.url) AS n_fake, (SELECT count(DISTINCT a.url) FROM a WHERE a.user_id = m.user_id AND a.row_idx % 8 = 0) AS n_audited, count(DISTINCT m.url) FILTER (m.url IN (SELECT url FROM a WHERE row_idx % 8 = 0)) AS n_same, (SELECT count(*) FROM a WHERE a.user_id = m.user_id) AS n_orders FROM m GROUP BY user_id)
SELECT row_idx, m.user_id, n_fake, n_audited, n_same, n_orders, CASE WHEN n_audited = 0 THEN 'nofactor' WHEN n_same > 0 THEN 'same' ELSE 'diff' END AS match FROM m JOIN f USING (user_id)""")
def miss_attribution_rows(spark, sf_dir):
    """A row for each confirmed image; half of the audits compared nothing."""
    rows, annotated, _ = _inputs(spark, sf_dir)
    pair = F.struct(F.col("qualification_url").alias("query_img_url"))
    audits = rows.where("row_idx % 4 = 0 and row_idx % 61 < 50").select("user_id", F.when(F.col("row_idx") % 8 == 0, F.array(pair)).alias("pairs"))
    return R.attribute_rows(annotated.where(F.col("remark_first") == N.CONFIRMED), audits).select("row_idx", "user_id", "n_fake", "n_audited", "n_same", "n_orders", "match")
