"""Queries over datasets, pools, queues, runs and pictures, each beside its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..operators import checks as K
from ..operators import review as W
from ..operators import sampling as P
from ..operators import similarity as C
from ..operators import workflow as O
from ..operators.pages import page_from, write_pages
from . import fixtures as X
from .catalogue import EXPAND_B, query
from .materialize import materialize, new_path
from .ordering import global_index

C_SQL = X.CLUSTER_SQL
ITEMS = f"{C_SQL}, items AS (SELECT *, trade_second_name AS dataset_id FROM fx_cluster)"
REVIEWS = f"{ITEMS}, reviews AS (SELECT dataset_id, qualification_url, CASE WHEN is_target_user THEN '{N.CLEAN}' ELSE '{N.CONFIRMED}' END AS verdict FROM items WHERE is_target_user OR trade_first_name = 'en')"
POOL = f"{ITEMS}, pool AS (SELECT dataset_id, cluster_id, CASE WHEN cluster_id % 3 = 0 THEN 'ann' WHEN cluster_id % 3 = 1 THEN 'bob' END AS assignee, CASE WHEN cluster_id % 2 = 0 THEN 'done' END AS completed_at, 'day' AS claimed_at FROM items WHERE cluster_id >= 0 GROUP BY ALL)"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.clusters(spark, sf_dir).withColumn("dataset_id", F.col("trade_second_name"))


def _reviews(items: DataFrame) -> DataFrame:
    return items.where("is_target_user or trade_first_name = 'en'").select("dataset_id", "qualification_url", F.when(F.col("is_target_user"), N.CLEAN).otherwise(N.CONFIRMED).alias("verdict"))


def _pool(items: DataFrame) -> DataFrame:
    own = items.where("cluster_id >= 0").select("dataset_id", "cluster_id").distinct()
    left = F.col("cluster_id") % 3
    return own.select("dataset_id", "cluster_id", F.when(left == 0, "ann").when(left == 1, "bob").alias("assignee"), F.when(F.col("cluster_id") % 2 == 0, "done").alias("completed_at"), F.lit("day").alias("claimed_at"))


@query(f"""WITH {ITEMS} SELECT dataset_id, count(*) AS total_rows, count(DISTINCT cluster_id) AS cluster_count, true AS by_hand FROM items GROUP BY 1
UNION ALL SELECT dataset_id, count(*), count(DISTINCT cluster_id) FILTER (cluster_id <> -1), false FROM items GROUP BY 1""")
def dataset_counts(spark, sf_dir):
    items = _items(spark, sf_dir)
    return O.dataset_counts(items).withColumn("by_hand", F.lit(True)).unionByName(O.dataset_counts(items, False).withColumn("by_hand", F.lit(False)))


@query(f"WITH {REVIEWS} SELECT dataset_id, qualification_url, verdict, cluster_id FROM reviews JOIN items USING (dataset_id, qualification_url)")
def join_reviews(spark, sf_dir):
    items = _items(spark, sf_dir)
    return O.cluster_reviews(_reviews(items), items)


@query(f"""WITH {REVIEWS}, d AS (SELECT DISTINCT dataset_id, cluster_id, qualification_url FROM items WHERE cluster_id <> -1), r AS (SELECT DISTINCT dataset_id, qualification_url, 1 AS one FROM reviews)
SELECT dataset_id, cluster_id, count(*) AS images, count(one) AS reviewed, count(one) >= count(*) AS completed FROM d LEFT JOIN r USING (dataset_id, qualification_url) GROUP BY 1, 2""")
def cluster_complete(spark, sf_dir):
    items = _items(spark, sf_dir)
    return O.completed_clusters(items, _reviews(items))


@query(f"""WITH {REVIEWS}, d AS (SELECT DISTINCT dataset_id, qualification_url FROM items WHERE cluster_id <> -1), r AS (SELECT DISTINCT dataset_id, qualification_url, 1 AS one FROM reviews)
SELECT count(*) AS total, count(one) AS reviewed FROM d LEFT JOIN r USING (dataset_id, qualification_url)""")
def image_progress(spark, sf_dir):
    items = _items(spark, sf_dir)
    return O.image_progress(items, _reviews(items))


@query(f"WITH {POOL} SELECT row_idx, dataset_id, cluster_id FROM items i WHERE EXISTS (SELECT 1 FROM pool p WHERE p.dataset_id = i.dataset_id AND p.cluster_id = i.cluster_id AND assignee = 'ann' AND completed_at IS NULL)")
def exists_claimed(spark, sf_dir):
    items = _items(spark, sf_dir)
    return O.claimed_images(items, _pool(items), "ann").select("row_idx", "dataset_id", "cluster_id")


@query(f"WITH {POOL} SELECT count(*) AS total, count(completed_at) AS done, count(completed_at) FILTER (assignee = 'bob') AS mine FROM pool")
def my_task_counts(spark, sf_dir):
    return O.task_counts(_pool(_items(spark, sf_dir)), "bob")


@query(f"WITH {POOL} SELECT dataset_id, cluster_id, CASE WHEN coalesce(assignee = 'ann', false) AND completed_at IS NULL THEN NULL ELSE assignee END AS assignee, completed_at, CASE WHEN coalesce(assignee = 'ann', false) AND completed_at IS NULL THEN NULL ELSE claimed_at END AS claimed_at FROM pool")
def release_pool(spark, sf_dir):
    return O.released(_pool(_items(spark, sf_dir)), "ann")


@query(f"WITH {C_SQL} SELECT row_idx, user_id, cluster_id, (SELECT count(*) FROM fx_cluster WHERE cluster_id = 0) AS total FROM fx_cluster WHERE cluster_id = 0 ORDER BY row_idx LIMIT 2 OFFSET 2")
def paginate_items(spark, sf_dir):
    return O.page_of(X.clusters(spark, sf_dir), 0, 2, 2).select("row_idx", "user_id", "cluster_id", "total")


@query(f"""WITH {C_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY row_idx) AS k, count(*) OVER (PARTITION BY cluster_id) AS total FROM fx_cluster)
SELECT row_idx, user_id, cluster_id, total, page FROM n JOIN (VALUES (1, -1, 7), (2, 0, 2), (3, -1, 50), (9, 0, 2), (1, 10, 3)) q(page, c, size) ON cluster_id = c AND k > (page - 1) * size AND k <= page * size""")
def paginate_items_stored(spark, sf_dir):
    path = new_path(spark, "pages")
    write_pages(X.clusters(spark, sf_dir), path, block=64, buckets=8)
    asked = [(1, -1, 7), (2, 0, 2), (3, -1, 50), (9, 0, 2), (1, 10, 3)]
    found = [page_from(spark, path, c, page, size).select("row_idx", "user_id", "cluster_id", "total", F.lit(page).alias("page")) for page, c, size in asked]
    return reduce(DataFrame.unionByName, found)


TASKS = """tasks AS (SELECT event_id AS task_id, concat(event_type, CASE WHEN value > 120 THEN '（重试2）' ELSE '' END) AS title, CASE WHEN value > 100 THEN 'failed' WHEN value > 60 THEN 'running' WHEN value > 30 THEN 'done' ELSE 'pending' END AS status,
  CASE WHEN user_id > 10 THEN 'table' END AS content, ts AS created_at, event_type AS mode FROM events)"""


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    value = F.col("value")
    return e.select(
        F.col("event_id").alias("task_id"),
        F.concat("event_type", F.when(value > 120, "（重试2）").otherwise("")).alias("title"),
        F.when(value > 100, "failed").when(value > 60, "running").when(value > 30, "done").otherwise("pending").alias("status"),
        F.when(F.col("user_id") > 10, "table").alias("content"),
        F.col("ts").alias("created_at"),
        F.col("event_type").alias("mode"),
    )


@query(f"""WITH {TASKS} SELECT task_id, CASE WHEN mode = 'click' AND status IN ('running', 'failed') AND content IS NOT NULL THEN 'pending' ELSE status END AS status,
CASE WHEN mode = 'click' AND status NOT IN ('running', 'failed') THEN 'state' WHEN mode = 'click' AND content IS NULL THEN 'content' END AS refused FROM tasks""")
def requeue_tasks(spark, sf_dir):
    t = _tasks(spark, sf_dir).withColumns({c: F.lit("x") for c in ("started_at", "finished_at", "detail")})
    return O.requeued(t, t.where("mode = 'click'")).select("task_id", "status", "refused")


@query(f"""WITH {TASKS} SELECT task_id AS retry_of, concat(regexp_replace(title, '（重试(?:[0-9]+)?）$', ''), '{O.RETRY_MARK}') AS title, content, 'pending' AS status FROM tasks WHERE status = 'failed' AND content IS NOT NULL""")
def retry_tasks(spark, sf_dir):
    t = _tasks(spark, sf_dir)
    return O.retried(t, t.select("task_id"))


@query(f"""WITH {TASKS}, p AS (SELECT * FROM tasks WHERE status = 'pending'), a AS (SELECT task_id, row_number() OVER (ORDER BY created_at, task_id) AS n FROM p WHERE mode = 'view' QUALIFY n <= 2),
b AS (SELECT task_id, row_number() OVER (ORDER BY created_at, task_id) AS n FROM p WHERE mode IN ('click', 'view') AND task_id NOT IN (SELECT task_id FROM a) QUALIFY n <= 3)
SELECT concat('v', CAST(n AS VARCHAR)) AS worker, task_id FROM a UNION ALL SELECT concat('x', CAST(n AS VARCHAR)), task_id FROM b""")
def claim_by_mode(spark, sf_dir):
    people = [(f"v{k}", ["view"]) for k in (1, 2)] + [(f"x{k}", ["view", "click"]) for k in (1, 2, 3)]
    return O.next_tasks(_tasks(spark, sf_dir), spark.createDataFrame(people, "worker string, modes array<string>"))


@query(f"""WITH {C_SQL}, list AS (SELECT cluster_id, min(trade_first_name) AS trade_first_name, min(trade_second_name) AS trade_second_name, CASE WHEN min(row_idx) % 2 = 0 THEN '{N.CONFIRMED}' END AS remark_first FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1),
s AS (SELECT *, row_number() OVER (ORDER BY cluster_id) AS seq FROM list) SELECT cluster_id, seq FROM s WHERE remark_first IS NULL AND (contains(lower(trade_first_name), 'e') OR contains(lower(trade_second_name), 'e'))""")
def cluster_list_filter(spark, sf_dir):
    rows = X.clusters(spark, sf_dir).where("cluster_id >= 0")
    listed = rows.groupBy("cluster_id").agg(F.min("trade_first_name").alias("trade_first_name"), F.min("trade_second_name").alias("trade_second_name"), F.when(F.min("row_idx") % 2 == 0, N.CONFIRMED).alias("remark_first"))
    return O.filtered_list(listed, first="未打标", trade=" E ").select("cluster_id", "seq")


@query("""SELECT event_id AS dataset_id, strftime(ts, '%Y-%m-%d') = '2024-01-02' AND event_type = 'view' AS on_day, contains(lower(event_type), 'ick') AS named FROM events""")
def delete_datasets(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("dataset_id"), F.col("event_type").alias("name"), F.col("event_type").alias("channel"), F.col("ts").cast("timestamp_ntz").alias("created_at"))
    own = O.deleted_on(e, "2024-01-02", "view").withColumnRenamed("deleted", "on_day")
    return O.deleted_named(own, "ICK").select("dataset_id", "on_day", F.col("deleted").alias("named"))


@query(f"""WITH {C_SQL}, a AS (SELECT DISTINCT user_id FROM fx_cluster WHERE is_target_user), b AS (SELECT DISTINCT user_id FROM fx_cluster WHERE trade_first_name = 'fr')
SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN a.user_id IS NOT NULL THEN 'left' ELSE 'right' END AS side FROM a FULL JOIN b USING (user_id) WHERE a.user_id IS NULL OR b.user_id IS NULL""")
def xor_sets(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    return O.one_sided(rows.where("is_target_user"), rows.where("trade_first_name = 'fr'"), "user_id")


@query(f"""WITH {C_SQL}, a AS (SELECT DISTINCT user_id FROM fx_cluster WHERE is_target_user), b AS (SELECT DISTINCT user_id FROM fx_cluster)
SELECT (SELECT count(*) FROM a WHERE user_id NOT IN (SELECT user_id FROM b)) AS only_left, (SELECT count(*) FROM b WHERE user_id NOT IN (SELECT user_id FROM a)) AS only_right, NOT EXISTS (SELECT 1 FROM b WHERE user_id NOT IN (SELECT user_id FROM a)) AS equal""")
def set_equal(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    return O.same_sets(rows.where("is_target_user"), rows, "user_id")


@query(f"WITH {C_SQL} SELECT DISTINCT trade_second_name AS tag FROM fx_cluster WHERE trade_second_name NOT IN (SELECT trade_second_name FROM fx_cluster WHERE cluster_id = 0)")
def orphan_tags(spark, sf_dir):
    rows = X.clusters(spark, sf_dir).withColumn("tag", F.col("trade_second_name"))
    return O.orphans(rows, rows.where("cluster_id = 0"))


@query(f"""WITH {C_SQL}, asked AS (SELECT DISTINCT user_id FROM fx_cluster), own AS (SELECT user_id, bool_or(cluster_id <> -1) AS inside FROM fx_cluster WHERE is_target_user GROUP BY 1)
SELECT (SELECT count(*) FROM asked) AS n_accounts, count(*) FILTER (inside) AS n_clustered, count(*) FILTER (NOT inside) AS n_unclustered, (SELECT count(*) FROM asked) - count(*) AS n_no_emb FROM own""")
def runner_stats(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    return O.runner_stats(rows, rows.withColumn("is_target", F.col("is_target_user")))


TASK = f"{C_SQL}, g AS (SELECT cluster_id, bool_or(is_target_user) AS t, count(DISTINCT user_id) AS u, count(DISTINCT user_id) FILTER (is_target_user) AS ut FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1), task AS (SELECT fx_cluster.* FROM fx_cluster JOIN g USING (cluster_id) WHERE t AND u >= 2), task2 AS (SELECT fx_cluster.* FROM fx_cluster JOIN g USING (cluster_id) WHERE t AND ut >= 2)"


@query(f"""WITH {TASK} SELECT (SELECT count(*) FROM fx_cluster) AS input_rows, (SELECT count(DISTINCT user_id) FROM fx_cluster) AS week_users, (SELECT count(DISTINCT user_id) FROM fx_cluster WHERE is_target_user) AS target_users,
(SELECT count(*) FROM g) AS all_clusters, (SELECT count(*) FROM g WHERE u < 2) AS single_user_clusters, count(*) AS task_rows, count(DISTINCT cluster_id) AS task_clusters, count(DISTINCT user_id) AS task_users, count(DISTINCT user_id) FILTER (is_target_user) AS task_target_users FROM task""")
def board_metrics(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    return O.board_metrics(rows, W.annotation_task(rows))


def _stats_sql(mode: str, task: str, users: str) -> str:
    return f"""SELECT '{mode}' AS min_user_mode, 2 AS min_users, (SELECT count(*) FROM fx_cluster) AS input_rows, (SELECT count(DISTINCT user_id) FROM fx_cluster) AS input_users, (SELECT count(DISTINCT user_id) FROM fx_cluster WHERE is_target_user) AS input_target_users,
(SELECT count(*) FROM g) AS all_clusters, (SELECT count(*) FROM g WHERE t) AS clusters_with_target, (SELECT count(*) FROM g WHERE t AND {users} >= 2) AS task_clusters, count(*) AS task_rows, count(DISTINCT user_id) AS task_users,
count(DISTINCT user_id) FILTER (is_target_user) AS task_target_users, (SELECT count(*) FROM g WHERE t AND {users} < 2) AS dropped_clusters FROM {task}"""


@query(f"WITH {TASK} {_stats_sql('all', 'task', 'u')} UNION ALL {_stats_sql('target', 'task2', 'ut')}")
def annotation_stats(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    return O.task_statistics(rows).unionByName(O.task_statistics(rows, mode="target"))


@query(f"WITH {TASK} SELECT row_idx, cluster_id FROM task2")
def annotation_task_target(spark, sf_dir):
    return W.annotation_task(X.clusters(spark, sf_dir), mode="target").select("row_idx", "cluster_id")


@query(f"""WITH {EXPAND_B}, s AS (SELECT DISTINCT user_id FROM fx_sample), b AS (SELECT user_id, max(cluster_id) AS c FROM fx_cluster JOIN s USING (user_id) GROUP BY 1)
SELECT (SELECT count(*) FROM s) AS sample_total, (SELECT count(*) FROM b) AS valid_sample_users, (SELECT count(*) FROM b WHERE c < 0) AS unmatched_cluster, count(DISTINCT cluster_id) FILTER (cluster_id >= 0) AS hit_clusters,
count(DISTINCT user_id) FILTER (NOT is_sample_user) AS expanded_users, count(DISTINCT user_id) AS annotate_users_total, count(*) AS annotate_rows_total, (SELECT count(DISTINCT cluster_id) FROM taken WHERE cluster_id IN (SELECT cluster_id FROM solo)) AS dropped_solo_clusters,
(SELECT count(*) FROM taken WHERE cluster_id IN (SELECT cluster_id FROM solo)) AS dropped_solo_rows, (SELECT count(*) FROM fx_cluster) AS cluster_source_rows, (SELECT count(*) FROM s) - (SELECT count(*) FROM b) AS no_qual_img_excluded FROM expanded""")
def expand_stats(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    samples = X.samples(rows)
    whole, kept = (materialize(P.expand_clusters(rows, samples, solo), "expanded") for solo in (True, False))
    return O.expansion_statistics(rows, samples, whole, kept)


@query(f"""WITH {C_SQL} SELECT 'user_id' AS "column", count(DISTINCT nullif(trim(user_id), '')) AS "distinct", count(*) AS rows FROM fx_cluster UNION ALL SELECT 'cluster_id', count(DISTINCT cluster_id), count(*) FROM fx_cluster""")
def artifact_stats(spark, sf_dir):
    return O.artifact_statistics(X.clusters(spark, sf_dir))


REPORT = f"""report AS (SELECT user_id % 7 AS run_id, CASE WHEN value > 100 THEN 'done' WHEN value > 80 THEN 'dry-run-ok' ELSE 'upload' END AS step, CASE WHEN value < 20 THEN '跨周期{O.DUPLICATE_WORD}' WHEN value < 50 THEN 'timeout' WHEN value > 140 THEN 'late' END AS error,
  CASE WHEN value > 110 THEN CAST(event_id AS VARCHAR) WHEN value > 100 THEN 'None' END AS sample_id FROM events)"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    step = F.when(v > 100, "done").when(v > 80, "dry-run-ok").otherwise("upload")
    error = F.when(v < 20, f"跨周期{O.DUPLICATE_WORD}").when(v < 50, "timeout").when(v > 140, "late")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("user_id") % 7).alias("run_id"), step.alias("step"), error.alias("error"), F.when(v > 110, F.col("event_id").cast("string")).when(v > 100, "None").alias("sample_id"))


@query(f"""WITH {REPORT} SELECT run_id, count(*) AS total, count(*) FILTER (step = 'done') AS ok, count(*) FILTER (contains(error, '{O.DUPLICATE_WORD}')) AS duplicated,
count(*) FILTER (error IS NOT NULL AND step <> 'done' AND NOT contains(error, '{O.DUPLICATE_WORD}')) AS failed, count(*) FILTER (step = 'done' AND regexp_full_match(sample_id, '[0-9]+')) AS stored FROM report GROUP BY 1""")
def report_summary(spark, sf_dir):
    return O.report_summary(_report(spark, sf_dir))


@query(f"""WITH {REPORT} SELECT count(*) FILTER (step IN ('done', 'dry-run-ok')) AS success, count(*) FILTER (contains(error, '{O.DUPLICATE_WORD}')) AS duplicate, count(*) FILTER (error IS NOT NULL AND NOT contains(error, '{O.DUPLICATE_WORD}')) AS error, (SELECT count(*) FROM events WHERE event_type = 'view') AS skipped FROM report""")
def bot_summary(spark, sf_dir):
    return O.bot_summary(_report(spark, sf_dir), spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'view'"))


VERDICTS = f"{C_SQL}, verdict AS (SELECT cluster_id, row_idx, qualification_url, row_idx % 2 = 0 AS is_electronic, CASE WHEN row_idx % 3 = 0 THEN 'high' ELSE 'low' END AS confidence FROM fx_cluster WHERE cluster_id >= 0), said AS (SELECT DISTINCT cluster_id, CASE cluster_id % 4 WHEN 0 THEN 'keep' WHEN 1 THEN 'drop' WHEN 2 THEN 'auto' END AS decision FROM fx_cluster WHERE cluster_id >= 0)"


def _verdicts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = X.clusters(spark, sf_dir).where("cluster_id >= 0")
    verdicts = rows.select("cluster_id", "row_idx", "qualification_url", (F.col("row_idx") % 2 == 0).alias("is_electronic"), F.when(F.col("row_idx") % 3 == 0, "high").otherwise("low").alias("confidence"))
    left = F.col("cluster_id") % 4
    return verdicts, rows.select("cluster_id", F.when(left == 0, "keep").when(left == 1, "drop").when(left == 2, "auto").alias("decision")).distinct()


@query(f"""WITH {VERDICTS} SELECT row_idx, CASE decision WHEN 'keep' THEN false WHEN 'drop' THEN true ELSE is_electronic END AS is_electronic, CASE decision WHEN 'keep' THEN 'human' WHEN 'drop' THEN 'high' ELSE confidence END AS confidence FROM verdict LEFT JOIN said USING (cluster_id)""")
def override_verdict(spark, sf_dir):
    return O.overridden(*_verdicts(spark, sf_dir)).select("row_idx", "is_electronic", "confidence")


@query(f"""WITH {VERDICTS}, j AS (SELECT is_electronic AS e, nullif(decision, 'auto') AS h FROM verdict LEFT JOIN said USING (cluster_id))
SELECT count(*) AS total, count(*) FILTER (coalesce(h = 'keep', NOT e)) AS will_keep, count(*) FILTER (NOT coalesce(h = 'keep', NOT e)) AS will_drop, count(*) FILTER (e) AS vlm_electronic, count(h) AS human_overrides FROM j""")
def effective_decision(spark, sf_dir):
    verdicts, said = _verdicts(spark, sf_dir)
    return O.decision_sums(verdicts.join(said, "cluster_id", "left"))


@query(f"WITH {VERDICTS} SELECT c.row_idx, NOT coalesce(is_electronic AND confidence = 'high', false) AS passed, NOT coalesce(is_electronic, false) AS passed_strict FROM fx_cluster c LEFT JOIN verdict v ON v.qualification_url = c.qualification_url")
def filter_electronic(spark, sf_dir):
    rows = X.clusters(spark, sf_dir).select("row_idx", "qualification_url")
    verdicts, _ = _verdicts(spark, sf_dir)
    strict = O.split_electronic(rows, verdicts, True).select("row_idx", F.col("passed").alias("passed_strict"))
    return O.split_electronic(rows, verdicts).select("row_idx", "passed").join(strict, "row_idx")


@query("""SELECT event_id, coalesce(value > 50 AND user_id % 4 <> 3, false) AS is_electronic, CASE WHEN user_id % 4 = 3 THEN 'low' ELSE 'high' END AS confidence,
CASE WHEN user_id % 4 = 3 THEN 'parse_fail: no answer' ELSE event_type END AS reason FROM events""")
def vlm_classify(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    body = F.concat(F.lit('{"is_electronic": '), F.when(F.col("value") > 50, "true").otherwise("false"), F.lit(', "confidence": "HIGH", "reason": "'), F.col("event_type"), F.lit('"}'))
    kind = F.col("user_id") % 4
    answer = F.when(kind == 0, body).when(kind == 1, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nok"))).when(kind == 2, F.concat(F.lit("So it is "), body, F.lit(", I think."))).otherwise("no answer")
    return O.parsed_answers(e.select("event_id", answer.alias("answer"))).select("event_id", "is_electronic", "confidence", "reason")


@query("SELECT count(*) AS rows_total, count(*) FILTER (url LIKE 'http%') AS rows_with_url, (SELECT list(url ORDER BY page_id) FROM (SELECT url, page_id FROM pages WHERE url LIKE 'http%' ORDER BY page_id LIMIT 6)) AS sample_urls FROM pages")
def analyze_upload(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").select("url")
    return O.upload_overview(p, "url")


@query(f"WITH {C_SQL} SELECT cluster_id, count(user_id) AS cluster_size, count(DISTINCT user_id) AS n_unique_user_id FROM fx_cluster WHERE cluster_id >= 0 GROUP BY 1 ORDER BY 3 DESC, 2 DESC, 1 LIMIT 15")
def top15_suspects(spark, sf_dir):
    return C.suspect_clusters(X.clusters(spark, sf_dir)).limit(15)


@query(f"""WITH {C_SQL}, {X.SAMPLE_SQL}, h AS (SELECT DISTINCT cluster_id, sample_group FROM fx_cluster JOIN fx_sample USING (user_id) WHERE cluster_id >= 0), t AS (SELECT cluster_id, string_agg(sample_group, ',' ORDER BY sample_group) AS trigger_groups FROM h GROUP BY 1),
x AS (SELECT row_idx, cluster_id, user_id, trigger_groups, user_id IN (SELECT user_id FROM fx_sample) AS s FROM fx_cluster JOIN t USING (cluster_id)) SELECT row_idx, row_number() OVER (ORDER BY trigger_groups, cluster_id, s DESC, user_id, row_idx) - 1 AS place FROM x""")
def sort_expand_a(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    out = P.expand_matches(rows, P.merged_samples(X.samples(rows).withColumn("source_file", F.col("sample_group"))))
    return global_index(out, [F.asc("trigger_groups"), F.asc("cluster_id"), F.desc("is_sample_user"), F.asc("user_id"), F.asc("row_idx")], "place").select("row_idx", "place")


@query(f"""WITH {C_SQL}, t AS (SELECT DISTINCT user_id FROM fx_cluster WHERE is_target_user), b AS (SELECT DISTINCT user_id FROM fx_cluster WHERE trade_first_name = 'en')
SELECT today, before, overlap, before > 0 AND overlap = before AND overlap = today AS repeated FROM (SELECT (SELECT count(*) FROM t) AS today, (SELECT count(*) FROM b) AS before, (SELECT count(*) FROM t WHERE user_id IN (SELECT user_id FROM b)) AS overlap)
UNION ALL SELECT n, n, n, n > 0 FROM (SELECT count(*) AS n FROM t)""")
def guard_same_users(spark, sf_dir):
    rows = X.clusters(spark, sf_dir)
    t = rows.where("is_target_user")
    return K.same_accounts(t, rows.where("trade_first_name = 'en'")).unionByName(K.same_accounts(t, t))


@query("""WITH q AS (SELECT DISTINCT o_orderdate AS d FROM orders) SELECT strftime(d, '%Y-%m-%d') AS biz_date, 'dtm' AS kind, '20240101' AS found FROM q UNION ALL SELECT strftime(d, '%Y-%m-%d'), 'pro_settle_date', '1995-01-01' FROM q WHERE strftime(d, '%Y-%m-%d') <> '1995-01-01'""")
def guard_sql_dates(spark, sf_dir):
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("biz_date")).distinct()
    text = F.concat(F.lit("SELECT 1 WHERE pro_settle_date = '"), F.col("biz_date"), F.lit("' AND dtm='20240101' OR pro_settle_date='1995-01-01' OR dtm = '"), F.replace(F.col("biz_date"), F.lit("-"), F.lit("")), F.lit("'"))
    return K.sql_date_faults(days.withColumn("sql", text)).select("biz_date", "kind", "found")


@query("""WITH f AS (SELECT event_type, event_type = 'view' AS cached, value > 40 AS ok FROM events), g AS (SELECT count(*) AS needed, count(*) FILTER (cached) AS hits, count(*) FILTER (NOT cached) AS new, count(*) FILTER (NOT cached AND NOT ok) AS failed FROM f)
SELECT *, round(failed / new, 4) AS fail_rate, CASE WHEN (new >= 50 OR (needed - failed) / needed < 0.9) AND failed / new >= 0.5 THEN 'stop' WHEN (new >= 50 OR (needed - failed) / needed < 0.9) AND failed / new >= 0.1 THEN 'warn' ELSE 'pass' END AS verdict FROM g""")
def download_guard(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return K.download_guard(e.select((F.col("event_type") == "view").alias("cached"), (F.col("value") > 40).alias("ok")))
