"""The library's queries over the shared tables, each beside the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions import statistics as S
from ..functions import vectors as V
from ..functions.let import let
from ..operators import density as D
from ..operators import reports as R
from ..operators import review as W
from ..operators import sampling as P
from ..operators import similarity as C
from ..sources import sinks, tables
from . import fixtures as X
from .materialize import materialize, new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if there is one."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


BAD3 = f"('{N.CONFIRMED}', '{N.SUSPECTED}', '{N.AFFILIATED}')"
SCOPE = "user_apply_type = 'initAudit' AND certificate_type IN (2, 4)"
LATEST = f"latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pro_settle_tms DESC, apply_id DESC) AS rn FROM fx_settlement WHERE {SCOPE}) WHERE rn = 1)"
SOURCES = f"{X.SETTLEMENT_SQL}, {LATEST}, src AS (SELECT coalesce(nullif(trim(first_trade_name), ''), '未知') AS first_trade_name, apply_source, count(DISTINCT user_id) AS uid_cnt FROM latest GROUP BY ALL)"
PER_USER = f"""lab AS (SELECT user_id, coalesce(bool_or(remark_first = '{N.CONFIRMED}'), false) AS r, coalesce(bool_or(remark_first = '{N.SUSPECTED}'), false) AS s FROM fx_annotated GROUP BY user_id)"""


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = X.clusters(spark, sf_dir)
    return rows, X.annotated(spark, sf_dir, rows), X.samples(rows)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("row_idx"), F.concat(F.lit("u"), F.col("vec_id") % 150).alias("user_id"), F.concat(F.lit("v/"), F.col("vec_id")).alias("qualification_url"), V.l2_normalize(F.col("embedding")).alias("embedding"))


# -- extraction and registrations


@query(f"WITH {X.SETTLEMENT_SQL}, {LATEST} SELECT user_id, apply_id, pro_settle_date, apply_source, first_trade_name FROM latest")
def latest_per_user(spark, sf_dir):
    return R.latest_registration(X.settlement(spark, sf_dir)).select("user_id", "apply_id", "pro_settle_date", "apply_source", "first_trade_name")


@query(f"WITH {SOURCES} SELECT * FROM src")
def agg_distinct_source(spark, sf_dir):
    return R.registered_sources(X.settlement(spark, sf_dir))


SPLIT = """sums AS (SELECT grouping(first_trade_name) = 1 AS is_overall, CASE WHEN grouping(first_trade_name) = 1 THEN 'overall' ELSE first_trade_name END AS industry,
  CAST(sum(CASE WHEN apply_source = 'SELLER_PASS' THEN uid_cnt ELSE 0 END) AS BIGINT) AS shop, CAST(sum(CASE WHEN apply_source = 'AD_PASS' THEN uid_cnt ELSE 0 END) AS BIGINT) AS ad,
  CAST(sum(CASE WHEN apply_source NOT IN ('SELLER_PASS', 'AD_PASS') THEN uid_cnt ELSE 0 END) AS BIGINT) AS professional FROM src GROUP BY ROLLUP (first_trade_name))"""


@query(f"WITH {SOURCES}, {SPLIT} SELECT * FROM sums")
def registered_source(spark, sf_dir):
    return R.source_split(R.registered_sources(X.settlement(spark, sf_dir)))


@query(f"WITH {SOURCES}, {SPLIT} SELECT *, CASE WHEN is_overall THEN greatest(500 - shop - ad - professional, 0) ELSE 0 END AS missing FROM sums")
def violation_source(spark, sf_dir):
    total = spark.range(1).select(F.lit(500).cast("long").alias("confirmed"))
    return R.source_split(R.registered_sources(X.settlement(spark, sf_dir)), total)


@query(f"""WITH {X.SETTLEMENT_SQL}, base AS (SELECT user_id, max(pro_settle_date) AS pro_settle_date FROM fx_settlement WHERE {SCOPE} GROUP BY user_id),
trade AS (SELECT user_id, max(first_trade_name) AS trade_first_name, max(second_trade_name) AS trade_second_name FROM fx_settlement GROUP BY user_id),
img AS (SELECT CAST(vec_id % 150 AS VARCHAR) AS user_id, concat('v/', CAST(vec_id % 400 AS VARCHAR)) AS qualification_url, CAST(label AS VARCHAR) AS embeds FROM embeddings),
one AS (SELECT user_id, qualification_url, max(embeds) AS embeds FROM img WHERE trim(embeds) <> '' GROUP BY ALL)
SELECT user_id, pro_settle_date, trade_first_name, trade_second_name, qualification_url, embeds FROM base LEFT JOIN trade USING (user_id) JOIN one USING (user_id)""")
def join_daily_extract(spark, sf_dir):
    s = X.settlement(spark, sf_dir)
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    images = e.select((F.col("vec_id") % 150).cast("string").alias("user_id"), F.concat(F.lit("v/"), F.col("vec_id") % 400).alias("qualification_url"), F.col("label").cast("string").alias("embeds"))
    return R.extract_daily(s, s, images)


@query(f"""WITH {X.SETTLEMENT_SQL} SELECT pro_settle_date, count(*) AS registrations FROM fx_settlement
WHERE pro_settle_date BETWEEN (SELECT max(pro_settle_date) FROM fx_settlement) - 6 AND (SELECT max(pro_settle_date) FROM fx_settlement) GROUP BY ALL""")
def window_7d_batch(spark, sf_dir):
    s = X.settlement(spark, sf_dir)
    last = s.agg(F.max("pro_settle_date")).first()[0]
    flagged = s.withColumn("source_window", S.target_or_history(F.col("pro_settle_date"), last))
    return flagged.where("source_window is not null").groupBy("pro_settle_date").agg(F.count("*").alias("registrations"))


@query()
def parse_embedding(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.to_json("embedding").alias("embeds"))
    return e.select("vec_id", V.parse_embedding(F.col("embeds")).alias("embedding"))


# -- vectors and clusters

PAIRS = "v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT a.id AS src, b.id AS dst, list_cosine_similarity(a.e, b.e) AS score FROM v a JOIN v b ON a.id <> b.id)"
KNN = f"{PAIRS}, k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS r FROM s) WHERE r <= 10)"
EDGES = f"{KNN}, e AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(score) AS score FROM k WHERE score >= 0.4 GROUP BY ALL)"
LABELS = f"""{EDGES}, b AS (SELECT src AS x, dst AS y FROM e UNION SELECT dst, src FROM e),
reach(x, y) AS (SELECT x, x FROM b UNION SELECT reach.x, b.y FROM reach JOIN b ON reach.y = b.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x), sz AS (SELECT c, row_number() OVER (ORDER BY count(*) DESC, c) - 1 AS cid FROM comp GROUP BY c),
labels AS (SELECT v.id AS row_idx, concat('u', CAST(v.id % 150 AS VARCHAR)) AS user_id, CAST(coalesce(cid, -1) AS INTEGER) AS cluster_id FROM v LEFT JOIN comp ON v.id = comp.x LEFT JOIN sz ON sz.c = comp.c)"""


@query(f"WITH {KNN} SELECT src, dst, round(score, 4) AS score FROM k")
def knn_exact(spark, sf_dir):
    return C.knn_exact(_vectors(spark, sf_dir), 10).select("src", "dst", F.round("score", 4).alias("score"))


@query(f"WITH {EDGES} SELECT src, dst, round(score, 4) AS score FROM e")
def candidate_edges(spark, sf_dir):
    return C.candidate_edges(C.knn_exact(_vectors(spark, sf_dir), 10, least=0.4), 0.4).select("src", "dst", F.round("score", 4).alias("score"))


@query(f"WITH RECURSIVE {LABELS} SELECT * FROM labels")
def cluster_threshold(spark, sf_dir):
    return C.cluster_threshold(_vectors(spark, sf_dir), 0.4, 10).select("row_idx", "user_id", "cluster_id")


@query()
def cluster_hdbscan(spark, sf_dir):
    return D.cluster_hdbscan(_vectors(spark, sf_dir), 16).select("row_idx", "cluster_id")


@query()
def cluster_kmeans(spark, sf_dir):
    return C.cluster_kmeans(_vectors(spark, sf_dir), 20, 10, (42,)).select("row_idx", "cluster_id")


@query()
def pick_representative(spark, sf_dir):
    rows = materialize(C.cluster_threshold(_vectors(spark, sf_dir), 0.4, 10).drop("embedding"), "labelled")
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("row_idx"), let(V.norm(F.col("embedding")), lambda n: F.transform("embedding", lambda x: x.cast("double") / n)).alias("embedding"))
    return C.representatives(rows.join(e, "row_idx")).withColumn("similarity", F.round("similarity", 4))


@query(f"WITH {X.CLUSTER_SQL} SELECT * FROM fx_cluster")
def component_rank(spark, sf_dir):
    return X.clusters(spark, sf_dir)


@query(f"WITH {X.CLUSTER_SQL} SELECT cluster_id, count(user_id) AS cluster_size, count(DISTINCT user_id) AS n_unique_user_id FROM fx_cluster WHERE cluster_id >= 0 GROUP BY cluster_id HAVING count(user_id) >= 2")
def suspect_clusters(spark, sf_dir):
    return C.suspect_clusters(X.clusters(spark, sf_dir))


@query(f"""WITH {X.CLUSTER_SQL}, n AS (SELECT count(*) AS n FROM fx_cluster WHERE cluster_id >= 0 GROUP BY cluster_id), bins(low, high) AS (VALUES (2, 3), (3, 5), (5, 10), (10, 20), (20, 50), (50, 100), (100, 2000000000))
SELECT low, count(n) AS clusters FROM bins LEFT JOIN n ON n >= low AND n < high GROUP BY low""")
def size_histogram(spark, sf_dir):
    return C.size_histogram(X.clusters(spark, sf_dir))


@query(f"""WITH {X.CLUSTER_SQL}, n AS (SELECT cluster_id, count(*) AS n FROM fx_cluster GROUP BY cluster_id)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (cluster_id >= 0), 0) AS BIGINT) AS clustered, count(*) FILTER (cluster_id >= 0) AS clusters, coalesce(max(n) FILTER (cluster_id >= 0), 0) AS largest,
round(coalesce(avg(n) FILTER (cluster_id >= 0), 0), 4) AS mean_size, round(coalesce(sum(n) FILTER (cluster_id >= 0), 0) / sum(n), 4) AS clustered_share FROM n""")
def cluster_overview(spark, sf_dir):
    return C.cluster_overview(X.clusters(spark, sf_dir))


# -- sampling and expansion


@query()
def hash_sample(spark, sf_dir):
    return P.hash_sample(X.settlement(spark, sf_dir), 500)


@query(f"""WITH {X.SETTLEMENT_SQL}, g AS (SELECT first_trade_name, count(DISTINCT user_id) AS n, avg(CASE WHEN apply_source = 'AD_PASS' THEN 1.0 ELSE 0.0 END) AS p FROM fx_settlement GROUP BY 1),
m AS (SELECT *, CASE WHEN p < 0.3 THEN 0.02 ELSE 0.05 END AS e, sqrt(-2 * ln(1 - (1 - (1 - 0.99) / 2))) AS t FROM g),
z AS (SELECT *, t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1 + t * (1.432788 + t * (0.189269 + t * 0.001308))) AS z FROM m)
SELECT first_trade_name, n AS population, CAST(ceil((z * z * p * (1 - p) / (e * e)) * n / ((z * z * p * (1 - p) / (e * e)) + n - 1)) AS BIGINT) AS sample FROM z""")
def sample_size(spark, sf_dir):
    s = X.settlement(spark, sf_dir)
    g = s.groupBy("first_trade_name").agg(F.count_distinct("user_id").alias("population"), F.avg(F.when(F.col("apply_source") == "AD_PASS", 1.0).otherwise(0.0)).alias("p"))
    return g.select("first_trade_name", "population", S.sample_size(F.col("p"), F.col("population")).alias("sample"))


@query()
def predict_hits(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    users = rows.agg(F.count_distinct("user_id").alias("n"))
    margins = F.explode(F.array(*[F.lit(m) for m in P.MARGINS])).alias("margin")
    sizes = users.select("n", margins).select("margin", S.sample_size(F.lit(0.1), F.col("n"), F.col("margin")).alias("n"))
    fixed = rows.where("user_id = 'u7'")
    return P.predicted_hits(rows, sizes, fixed)


@query()
def choose_margin(spark, sf_dir):
    return P.choose_margin(predict_hits(spark, sf_dir), 0.02, ceiling=40)


@query(f"WITH {X.CLUSTER_SQL}, {X.SAMPLE_SQL} SELECT user_id, string_agg(DISTINCT sample_group, ',' ORDER BY sample_group) AS sample_groups, string_agg(DISTINCT sample_group, ',' ORDER BY sample_group) AS source_files FROM fx_sample GROUP BY user_id")
def dedup_sample(spark, sf_dir):
    return P.merged_samples(X.samples(X.clusters(spark, sf_dir)).withColumn("source_file", F.col("sample_group")))


@query(f"""WITH {X.CLUSTER_SQL}, {X.SAMPLE_SQL}, h AS (SELECT DISTINCT cluster_id, user_id, sample_group FROM fx_cluster JOIN fx_sample USING (user_id) WHERE cluster_id >= 0),
t AS (SELECT cluster_id, count(DISTINCT user_id) AS n_trigger_users, string_agg(DISTINCT user_id, ',' ORDER BY user_id) AS trigger_users, string_agg(DISTINCT sample_group, ',' ORDER BY sample_group) AS trigger_groups FROM h GROUP BY cluster_id)
SELECT fx_cluster.*, n_trigger_users, trigger_users, trigger_groups, user_id IN (SELECT user_id FROM fx_sample) AS is_sample_user FROM fx_cluster JOIN t USING (cluster_id)""")
def expand_a(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    merged = P.merged_samples(X.samples(rows).withColumn("source_file", F.col("sample_group")))
    return P.expand_matches(rows, merged).select(*rows.columns, "n_trigger_users", "trigger_users", "trigger_groups", "is_sample_user")


EXPAND_B = f"""{X.CLUSTER_SQL}, {X.SAMPLE_SQL}, f AS (SELECT *, user_id IN (SELECT user_id FROM fx_sample) AS is_sample_user FROM fx_cluster),
hit AS (SELECT DISTINCT cluster_id FROM f WHERE is_sample_user AND cluster_id >= 0), out_u AS (SELECT user_id FROM f WHERE is_sample_user GROUP BY user_id HAVING max(cluster_id) < 0),
taken AS (SELECT * FROM f WHERE cluster_id IN (SELECT cluster_id FROM hit) UNION ALL SELECT * FROM f WHERE user_id IN (SELECT user_id FROM out_u)),
solo AS (SELECT cluster_id FROM taken WHERE cluster_id >= 0 GROUP BY 1 HAVING count(DISTINCT user_id) = 1), kept AS (SELECT * FROM taken WHERE cluster_id NOT IN (SELECT cluster_id FROM solo)),
gone AS (SELECT DISTINCT user_id FROM taken WHERE is_sample_user AND cluster_id IN (SELECT cluster_id FROM solo) AND user_id NOT IN (SELECT user_id FROM kept)),
expanded AS (SELECT * FROM kept UNION ALL SELECT * REPLACE (-1 AS cluster_id) FROM f WHERE user_id IN (SELECT user_id FROM gone))"""


@query(f"WITH {EXPAND_B} SELECT row_idx, user_id, qualification_url, trade_first_name, trade_second_name, is_target_user, CAST(cluster_id AS INTEGER) AS cluster_id, is_sample_user FROM expanded")
def expand_b(spark, sf_dir):
    rows, _, samples = _inputs(spark, sf_dir)
    return P.canonical_order(P.expand_clusters(rows, samples).select(*[c for c in rows.columns if c != "cluster_id"], "cluster_id", "is_sample_user"))


# -- concentrations and distributions


@query(f"""WITH {X.ANNOTATED_SQL}, {X.SAMPLE_SQL}, u AS (SELECT s.sample_group, s.user_id, bool_or(a.remark_first IN {BAD3}) AS bad FROM fx_sample s JOIN fx_annotated a USING (user_id) WHERE remark_first IS NOT NULL GROUP BY ALL)
SELECT sample_group, count(*) AS annotated, count(*) FILTER (bad) AS violated, round(count(*) FILTER (bad) / count(*), 4) AS concentration FROM u GROUP BY sample_group""")
def concentration_csv(spark, sf_dir):
    rows, annotated, samples = _inputs(spark, sf_dir)
    cell = samples.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("sample_group")), "|").alias("sample_groups"))
    own = annotated.join(cell, "user_id").select("user_id", "sample_groups", F.lit("true").alias("is_sample_user"), F.col("remark_first").alias("annotation_result"))
    return R.concentration_by_group(own)


@query(f"""WITH {X.ANNOTATED_SQL}, {X.SAMPLE_SQL},
d AS (SELECT user_id, remark_first FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE remark_first WHEN '{N.CONFIRMED}' THEN 0 WHEN '{N.SUSPECTED}' THEN 1 WHEN '{N.CLEAN}' THEN 2 ELSE 3 END, row_idx) AS rn FROM fx_annotated) WHERE rn = 1)
SELECT sample_group, count(*) FILTER (user_id IN (SELECT user_id FROM fx_cluster)) AS denominator, count(*) FILTER (remark_first = '{N.CONFIRMED}') AS numerator,
round(count(*) FILTER (remark_first = '{N.CONFIRMED}') / count(*) FILTER (user_id IN (SELECT user_id FROM fx_cluster)), 4) AS concentration FROM fx_sample LEFT JOIN d USING (user_id) GROUP BY sample_group""")
def concentration_restore(spark, sf_dir):
    rows, annotated, samples = _inputs(spark, sf_dir)
    return R.concentration_restored(samples, rows, annotated)


CHECKED = f"""{X.ANNOTATED_SQL}, {X.SAMPLE_SQL}, bad AS (SELECT DISTINCT user_id FROM fx_annotated WHERE cluster_id <> -1 AND remark_first = '{N.CONFIRMED}'),
den AS (SELECT DISTINCT sample_group, user_id FROM fx_sample WHERE user_id IN (SELECT user_id FROM fx_cluster)),
checked AS (SELECT sample_group, count(*) AS denominator, count(bad.user_id) AS numerator, round(count(bad.user_id) / count(*), 4) AS concentration FROM den LEFT JOIN bad USING (user_id) GROUP BY sample_group)"""


@query(f"WITH {CHECKED} SELECT * FROM checked")
def concentration_check(spark, sf_dir):
    rows, annotated, samples = _inputs(spark, sf_dir)
    return R.concentration_checked(samples, rows, annotated)


@query(f"""WITH {X.ANNOTATED_SQL}, {X.SAMPLE_SQL}, {PER_USER}, ind AS (SELECT user_id, min_by(trade_first_name, row_idx) AS i1, min_by(trade_second_name, row_idx) AS i2 FROM fx_cluster GROUP BY user_id),
j AS (SELECT i1, i2, r, s FROM fx_sample JOIN ind USING (user_id) LEFT JOIN lab USING (user_id))
SELECT CAST(2 - grouping(i1) - grouping(i2) AS INTEGER) AS level, i1 AS industry1, i2 AS industry2, count(*) AS sampled, count(*) FILTER (r) AS confirmed, count(*) FILTER (s AND NOT r) AS suspected FROM j GROUP BY ROLLUP (i1, i2)""")
def violation_dist(spark, sf_dir):
    rows, annotated, samples = _inputs(spark, sf_dir)
    return R.violation_distribution(samples, rows, annotated)


REG = f"{X.SETTLEMENT_SQL}, reg AS (SELECT concat('u', CAST(CAST(user_id AS INTEGER) % 70 AS VARCHAR)) AS user_id, max(first_trade_name) AS first_trade_name FROM fx_settlement WHERE {SCOPE} GROUP BY 1)"


def _registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = X.settlement(spark, sf_dir).where("user_apply_type = 'initAudit' and certificate_type in (2, 4)")
    return s.groupBy(F.concat(F.lit("u"), F.col("user_id").cast("int") % 70).alias("user_id")).agg(F.max("first_trade_name").alias("first_trade_name"))


@query(f"""WITH {X.ANNOTATED_SQL}, {REG}, t AS (SELECT user_id, min_by(trade_first_name, row_idx) AS own, bool_or(cluster_id >= 0) AS c FROM fx_cluster GROUP BY 1),
l AS (SELECT user_id, bool_or(remark_first IS NOT NULL) AS a, coalesce(bool_or(remark_first = '{N.CONFIRMED}'), false) AS v FROM fx_annotated GROUP BY 1),
j AS (SELECT coalesce(first_trade_name, own, '{N.UNKNOWN_INDUSTRY}') AS industry, c, a, v FROM reg FULL JOIN t USING (user_id) LEFT JOIN l USING (user_id))
SELECT industry, count(*) AS registered, count(*) FILTER (c) AS clustered, count(*) FILTER (a) AS annotated, count(*) FILTER (v) AS confirmed, coalesce(round(count(*) FILTER (v) / nullif(count(*) FILTER (a), 0), 4), 0) AS accuracy FROM j GROUP BY industry""")
def industry_baseline(spark, sf_dir):
    rows, annotated, _ = _inputs(spark, sf_dir)
    return R.industry_baseline(_registered(spark, sf_dir), rows, annotated)


@query(f"""WITH {X.ANNOTATED_SQL}, {REG}, org AS (SELECT concat('u', CAST(c_custkey AS VARCHAR)) AS user_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS t FROM customer),
a AS (SELECT first_trade_name AS industry, coalesce(t, '{N.MISSING_AUTH}') AS method, count(*) AS registered FROM reg LEFT JOIN org USING (user_id) GROUP BY ALL),
bad AS (SELECT user_id, min_by(trade_first_name, row_idx) AS industry FROM fx_annotated WHERE remark_first = '{N.CONFIRMED}' GROUP BY 1),
b AS (SELECT industry, coalesce(t, '{N.MISSING_AUTH}') AS method, count(*) AS confirmed FROM bad LEFT JOIN org USING (user_id) GROUP BY ALL)
SELECT industry, method, coalesce(registered, 0) AS registered, coalesce(confirmed, 0) AS confirmed FROM a FULL JOIN b USING (industry, method) WHERE method <> '{N.MISSING_AUTH}'""")
def cert_method(spark, sf_dir):
    _, annotated, _ = _inputs(spark, sf_dir)
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    org = c.select(F.concat(F.lit("u"), "c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("authentication_type"))
    return R.auth_methods(_registered(spark, sf_dir), org, annotated)


@query(f"""WITH {X.SETTLEMENT_SQL}, t AS (SELECT first_trade_name AS industry, count(*) AS registered, count(*) FILTER (apply_source = 'AD_PASS') AS sampled FROM fx_settlement GROUP BY 1)
SELECT industry, registered, sampled, round(registered / (SELECT sum(registered) FROM t), 4) AS registered_share, round(sampled / (SELECT sum(sampled) FROM t), 4) AS sampled_share FROM t""")
def representativeness(spark, sf_dir):
    t = X.settlement(spark, sf_dir).groupBy(F.col("first_trade_name").alias("industry")).agg(F.count("*").alias("registered"), F.count_if(F.col("apply_source") == "AD_PASS").alias("sampled"))
    return R.shares(t, "industry", ["registered", "sampled"])


WEEKS = "(SELECT CAST(date_trunc('week', max(pro_settle_date)) AS DATE) FROM fx_settlement)"


@query(f"""WITH {X.SETTLEMENT_SQL}, w AS (SELECT second_trade_name AS industry, CAST(date_trunc('week', pro_settle_date) AS DATE) AS wk FROM fx_settlement),
c AS (SELECT industry, count(*) AS n FROM w WHERE wk = {WEEKS} GROUP BY 1), p AS (SELECT industry, count(*) AS n FROM w WHERE wk = {WEEKS} - 7 GROUP BY 1),
b AS (SELECT industry, coalesce(c.n, 0) AS current, coalesce(p.n, 0) AS previous FROM c FULL JOIN p USING (industry))
SELECT *, current - previous AS delta, CASE WHEN previous <> 0 THEN round((current - previous) / previous, 4) END AS delta_share FROM b""")
def registered_compare(spark, sf_dir):
    s = X.settlement(spark, sf_dir).withColumn("wk", F.trunc("pro_settle_date", "week"))
    last = s.agg(F.max("wk")).first()[0]
    n = lambda d: s.where(F.col("wk") == d).groupBy(F.col("second_trade_name").alias("industry")).agg(F.count("*").alias("n"))
    return R.compare_weeks(n(F.lit(last)), n(F.date_sub(F.lit(last), 7)), "industry", "n")


@query(f"""WITH {X.CLUSTER_SQL}, d AS (SELECT *, row_idx % 3 AS day FROM fx_cluster WHERE cluster_id >= 0), m AS (SELECT day, cluster_id, bool_or(NOT is_target_user) AS h FROM d GROUP BY ALL HAVING count(DISTINCT user_id) > 1),
u AS (SELECT day, user_id, min_by(trade_first_name, row_idx) AS industry, bool_or(h) AS h FROM d JOIN m USING (day, cluster_id) WHERE is_target_user GROUP BY ALL)
SELECT day, industry, count(*) AS accounts, count(*) FILTER (h) AS with_history FROM u GROUP BY ALL""")
def industry_history_daily(spark, sf_dir):
    return R.history_by_day(X.clusters(spark, sf_dir).withColumn("day", F.col("row_idx") % 3))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type AS industry, count(*) AS accounts, count(*) FILTER (value > 100) AS with_history FROM events GROUP BY ALL),
k AS (SELECT industry, CASE WHEN sum(accounts) / (SELECT count(DISTINCT day) FROM d) < 10 THEN 'other' ELSE industry END AS k FROM d GROUP BY industry),
j AS (SELECT k, day, sum(accounts) AS a, sum(with_history) AS h FROM d JOIN k USING (industry) GROUP BY ALL)
SELECT k AS industry, CAST(sum(a) AS BIGINT) AS accounts, CAST(sum(h) AS BIGINT) AS with_history, round(100 * sum(h) / sum(a), 1) AS pooled_pct, round(avg(100 * h / a), 1) AS mean_pct, round(min(100 * h / a), 1) AS min_pct, round(max(100 * h / a), 1) AS max_pct, count(*) AS days, round(sum(a) / count(*), 1) AS per_day FROM j GROUP BY k""")
def industry_history_summary(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    days = e.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("industry")).agg(F.count("*").alias("accounts"), F.count_if(F.col("value") > 100).alias("with_history"))
    return R.history_summary(days)


@query(f"""WITH {X.ANNOTATED_SQL}, m AS (SELECT DISTINCT user_id, qualification_url AS url FROM fx_annotated WHERE remark_first = '{N.CONFIRMED}'),
s AS (SELECT DISTINCT user_id, qualification_url AS url FROM fx_cluster WHERE row_idx % 4 = 0 AND user_id IN (SELECT user_id FROM m)),
b AS (SELECT user_id, count(m.url) AS n_fake, count(s.url) AS n_audited, count(*) FILTER (m.url IS NOT NULL AND s.url IS NOT NULL) AS n_same FROM m FULL JOIN s USING (user_id, url) GROUP BY user_id)
SELECT *, CASE WHEN n_audited = 0 THEN 'nofactor' WHEN n_same > 0 THEN 'same' ELSE 'diff' END AS match FROM b""")
def miss_attribution(spark, sf_dir):
    rows, annotated, _ = _inputs(spark, sf_dir)
    audited = rows.where("row_idx % 4 = 0").select("user_id", F.col("qualification_url").alias("url"))
    return R.attribute_misses(annotated.where(F.col("remark_first") == N.CONFIRMED), audited)


# -- annotation


@query(f"""WITH {X.CLUSTER_SQL}, g AS (SELECT cluster_id FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1 HAVING bool_or(is_target_user) AND count(DISTINCT user_id) >= 2) SELECT fx_cluster.* FROM fx_cluster JOIN g USING (cluster_id)""")
def annotation_task(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    return W.annotation_task(rows).select(*rows.columns)


ANN = "ann AS (SELECT cluster_id, min_by(remark_first, row_idx) AS remark_first FROM fx_annotated WHERE cluster_id >= 0 AND remark_first IS NOT NULL GROUP BY 1)"


def _cluster_annotations(annotated: DataFrame) -> DataFrame:
    return annotated.where("cluster_id >= 0 and remark_first is not null").groupBy("cluster_id").agg(F.min_by("remark_first", "row_idx").alias("remark_first"))


@query(f"""WITH {X.ANNOTATED_SQL}, {ANN}, p AS (SELECT cluster_id, trade_first_name, trade_second_name, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, trade_first_name, trade_second_name) AS rn FROM fx_cluster WHERE cluster_id >= 0 GROUP BY cluster_id, trade_first_name, trade_second_name),
n AS (SELECT cluster_id, count(*) AS rows FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1)
SELECT n.cluster_id, rows, trade_first_name, trade_second_name, remark_first FROM n JOIN p ON n.cluster_id = p.cluster_id AND rn = 1 LEFT JOIN ann ON n.cluster_id = ann.cluster_id""")
def cluster_list(spark, sf_dir):
    rows, annotated, _ = _inputs(spark, sf_dir)
    return W.cluster_list(rows, _cluster_annotations(annotated))


@query(f"""WITH {X.ANNOTATED_SQL}, {ANN}, c AS (SELECT DISTINCT cluster_id FROM fx_cluster WHERE cluster_id >= 0), t AS (SELECT count(*) AS clusters, count(ann.cluster_id) AS annotated FROM c LEFT JOIN ann USING (cluster_id))
SELECT clusters, annotated, clusters - annotated AS pending, coalesce(round(100 * annotated / nullif(clusters, 0), 2), 0) AS percent, clusters > 0 AND clusters = annotated AS completed FROM t""")
def progress(spark, sf_dir):
    rows, annotated, _ = _inputs(spark, sf_dir)
    return W.progress(rows, _cluster_annotations(annotated))


EXPORT = f"""{X.ANNOTATED_SQL}, {ANN}, il AS (SELECT qualification_url AS u FROM fx_cluster WHERE row_idx % 11 = 0), rv AS (SELECT qualification_url AS u, CASE WHEN row_idx % 2 = 0 THEN '{N.CLEAN}' ELSE '{N.CONFIRMED}' END AS v FROM fx_cluster WHERE row_idx % 13 = 0),
x AS (SELECT c.row_idx, c.qualification_url, c.cluster_id, ann.remark_first, il.u AS l, rv.v FROM fx_cluster c LEFT JOIN ann ON ann.cluster_id = c.cluster_id LEFT JOIN il ON il.u = c.qualification_url LEFT JOIN rv ON rv.u = c.qualification_url)"""


def _export(spark: SparkSession, sf_dir: str, with_reviews: bool) -> DataFrame:
    rows, annotated, _ = _inputs(spark, sf_dir)
    reviews = rows.where("row_idx % 13 = 0").select("qualification_url", F.when(F.col("row_idx") % 2 == 0, N.CLEAN).otherwise(N.CONFIRMED).alias("verdict"))
    return W.export_rows(rows, _cluster_annotations(annotated), rows.where("row_idx % 11 = 0"), reviews if with_reviews else None)


@query(f"""WITH {EXPORT} SELECT row_idx, cluster_id, remark_first, coalesce(v, '') AS image_verdict, CASE WHEN v = '{N.CLEAN}' THEN '{N.PASSED}' WHEN v IS NOT NULL THEN '{N.VIOLATION}' WHEN l IS NOT NULL OR remark_first = '{N.CLEAN}' THEN '{N.PASSED}' ELSE '{N.VIOLATION}' END AS image_label
FROM x WHERE remark_first IS NOT NULL OR v IS NOT NULL OR l IS NOT NULL""")
def join_export_v1(spark, sf_dir):
    return _export(spark, sf_dir, True).select("row_idx", "cluster_id", "remark_first", "image_verdict", "image_label")


@query(f"WITH {EXPORT} SELECT row_idx, cluster_id, remark_first, CASE WHEN l IS NOT NULL OR remark_first = '{N.CLEAN}' THEN '{N.PASSED}' ELSE '{N.VIOLATION}' END AS image_label FROM x")
def join_export_v2(spark, sf_dir):
    return _export(spark, sf_dir, False).select("row_idx", "cluster_id", "remark_first", "image_label")


@query(f"WITH {X.CLUSTER_SQL}, h AS (SELECT cluster_id FROM fx_cluster WHERE cluster_id <> -1 AND user_id ILIKE '%u1%') SELECT DISTINCT cluster_id, (SELECT count(*) FROM h) AS total FROM h ORDER BY cluster_id LIMIT 500")
def search_uid(spark, sf_dir):
    return W.search_user(X.clusters(spark, sf_dir), "U1")


# -- workflow over events


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(F.col("event_id").alias("seq"), "ts", (F.col("user_id") % 50).alias("run_id"), F.col("event_type").alias("stage"), F.when(F.col("value") > 100, "done").when(F.col("value") > 20, "running").otherwise("failed").alias("status"))


STAGE_LIST = ["signup", "view", "click", "purchase", "error"]
STATES = """e AS (SELECT user_id % 50 AS run_id, event_type AS stage, max_by(CASE WHEN value > 100 THEN 'done' WHEN value > 20 THEN 'running' ELSE 'failed' END, event_id) AS status FROM events GROUP BY ALL),
d(place, stage) AS (VALUES (0, 'signup'), (1, 'view'), (2, 'click'), (3, 'purchase'), (4, 'error')),
states AS (SELECT r.run_id, d.stage, d.place, coalesce(e.status, 'pending') AS status FROM (SELECT DISTINCT run_id FROM e) r CROSS JOIN d LEFT JOIN e ON e.run_id = r.run_id AND e.stage = d.stage)"""


@query(f"WITH {STATES} SELECT * FROM states")
def stage_machine(spark, sf_dir):
    return W.stage_states(_events(spark, sf_dir), STAGE_LIST)


@query(f"WITH {STATES} SELECT run_id, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_and(status = 'done') THEN 'done' WHEN bool_or(status IN ('running', 'done')) THEN 'running' ELSE 'pending' END AS status FROM states GROUP BY run_id")
def run_status(spark, sf_dir):
    return W.run_status(W.stage_states(_events(spark, sf_dir), STAGE_LIST))


@query("SELECT user_id, event_type FROM events GROUP BY ALL HAVING count(*) % 2 = 1")
def toggle_label(spark, sf_dir):
    return W.toggled(spark.read.parquet(f"{sf_dir}/events.parquet"), ["user_id", "event_type"])


@query("""WITH t AS (SELECT event_id AS task_id, ts AS started_at, CASE WHEN value > 50 THEN 'running' ELSE 'done' END AS status FROM events)
SELECT task_id, CASE WHEN status = 'running' AND started_at < TIMESTAMP '2024-01-03 00:00:00' - INTERVAL 2 HOUR THEN 'failed' ELSE status END AS status, status = 'running' AND started_at < TIMESTAMP '2024-01-03 00:00:00' - INTERVAL 2 HOUR AS timed_out FROM t""")
def lease_timeout(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    tasks = e.select(F.col("event_id").alias("task_id"), F.col("ts").cast("timestamp_ntz").alias("started_at"), F.when(F.col("value") > 50, "running").otherwise("done").alias("status"))
    return W.leases(tasks, F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")).select("task_id", "status", "timed_out")


@query("""WITH o AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events WHERE value > 100) SELECT event_id AS cluster_id, concat('w', CAST(n AS VARCHAR)) AS assignee FROM o WHERE n <= 9""")
def claim_queue(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    pool = e.select(F.col("event_id").alias("cluster_id"), F.col("ts").alias("created_at"), F.lit(None).cast("string").alias("assignee"), F.when(F.col("value") <= 100, F.col("ts")).alias("completed_at"))
    workers = spark.range(1, 10).select(F.concat(F.lit("w"), "id").alias("email"), F.col("id").alias("idle_since"))
    return W.claim(pool, workers)


@query("""WITH c AS (SELECT CAST(user_id AS BIGINT) AS user_id, event_id AS seq, event_type AS label FROM events), old AS (SELECT DISTINCT user_id, 'none' AS label FROM c WHERE user_id % 2 = 0), new AS (SELECT user_id, max_by(label, seq) AS label FROM c WHERE user_id % 3 = 0 GROUP BY 1)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM new)""")
def sink_upsert(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").cast("long").alias("user_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("label"))
    old = c.where("user_id % 2 = 0").select("user_id", F.lit("none").alias("label")).distinct()
    return W.upsert(old, c.where("user_id % 3 = 0"), ["user_id"])


@query("SELECT event_type, CAST(ts AS DATE) AS run_id, count(*) AS n FROM events GROUP BY ALL")
def sink_snapshot(spark, sf_dir):
    path = new_path(spark, "snapshot")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type", F.to_date("ts").alias("run_id")).agg(F.count("*").alias("n"))
    sinks.write_snapshot(e.withColumn("n", F.lit(0).cast("long")), path)
    sinks.write_snapshot(e, path)
    return spark.read.schema("event_type string, n long, run_id date").parquet(path)


@query(f"WITH {X.CLUSTER_SQL}, t AS (SELECT cluster_id, count(*) AS cluster_size FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200), p AS (SELECT row_idx, cluster_id, cluster_size, row_number() OVER (PARTITION BY cluster_id ORDER BY row_idx) AS place FROM fx_cluster JOIN t USING (cluster_id)) SELECT row_idx, cluster_id, cluster_size, CAST(place AS INTEGER) AS place FROM p WHERE place <= 80")
def sink_gallery(spark, sf_dir):
    return sinks.gallery(X.clusters(spark, sf_dir)).select("row_idx", "cluster_id", "cluster_size", "place")


@query("SELECT concat('p-', CAST(row_number() OVER (ORDER BY page_id) - 1 AS VARCHAR)) AS candidate_id, page_id, url AS qualification_url FROM pages QUALIFY url LIKE 'http%'")
def scan_input_csv(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.col("url").alias("qualification_url"))
    return tables.candidates(p, "p", "page_id")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly report: both levels of industry, sampled, confirmed and suspected accounts."""
    return violation_dist(spark, sf_dir)
