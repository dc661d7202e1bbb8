"""Annotation tables: lists, progress, exports, claims and state kept as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalise as N


def annotation_task(rows: DataFrame, least_users: int = 2, mode: str = "all") -> DataFrame:
    """Rows of clusters that hold a target row and ``least_users`` distinct accounts, over all rows or target rows only."""
    counted = F.col("user_id") if mode == "all" else F.when(F.col("is_target_user"), F.col("user_id"))
    inside = rows.where("cluster_id >= 0")
    good = inside.groupBy("cluster_id").agg(F.bool_or("is_target_user").alias("t"), F.count_distinct(counted).alias("u")).where(F.col("t") & (F.col("u") >= least_users))
    return inside.join(good.select("cluster_id"), "cluster_id", "left_semi")


def mode_trade(items: DataFrame, key: str = "cluster_id") -> DataFrame:
    """The most frequent pair of industries of each cluster, ties in order of names."""
    pairs = items.groupBy(key, "trade_first_name", "trade_second_name").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "trade_first_name", "trade_second_name"))
    return pairs.groupBy(key).agg(best.alias("_b")).select(key, "_b.trade_first_name", "_b.trade_second_name")


def cluster_list(items: DataFrame, annotations: DataFrame) -> DataFrame:
    """Clusters with rows, most frequent trade and label."""
    sizes = items.where("cluster_id <> -1").groupBy("cluster_id").agg(F.count("*").alias("rows"))
    return sizes.join(mode_trade(items), "cluster_id", "left").join(annotations.select("cluster_id", "remark_first"), "cluster_id", "left")


def search_user(items: DataFrame, part: str, limit: int = 500) -> DataFrame:
    """Distinct clusters of accounts that contain ``part`` in any case, with the
    count of matching rows in clusters; nothing for fewer than two characters."""
    wanted = part.strip().lower()
    hits = items.where("cluster_id <> -1").where(F.contains(F.lower("user_id"), F.lit(wanted)) if len(wanted) >= 2 else F.lit(False))
    total = hits.agg(F.count("*").alias("total"))
    return hits.select("cluster_id").distinct().orderBy("cluster_id").limit(limit).crossJoin(F.broadcast(total))  # one row


def progress(items: DataFrame, annotations: DataFrame) -> DataFrame:
    """One row: clusters, annotated and pending ones, percentage, and whether all are done."""
    own = items.where("cluster_id <> -1").select("cluster_id").distinct()
    done = annotations.where(N.trimmed(F.col("remark_first")).isNotNull()).select("cluster_id").distinct().withColumn("_d", F.lit(1))
    out = own.join(done, "cluster_id", "left").agg(F.count("*").alias("clusters"), F.count("_d").alias("annotated"))
    return out.select("clusters", "annotated", (F.col("clusters") - F.col("annotated")).alias("pending"), N.share(100 * F.col("annotated"), F.col("clusters"), 2).alias("percent"), ((F.col("clusters") > 0) & (F.col("clusters") == F.col("annotated"))).alias("completed"))


def export_rows(items: DataFrame, annotations: DataFrame, item_labels: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Items with label. With ``reviews`` verdicts count and only rows with any annotation are kept; without, all rows."""
    out = items.join(annotations.select("cluster_id", "remark_first"), "cluster_id", "left")
    out = out.join(item_labels.select("qualification_url", F.lit("1").alias("_l")), "qualification_url", "left")
    if reviews is None:
        return out.withColumn("image_label", N.image_label(F.col("remark_first"), F.col("_l"))).drop("_l")
    out = out.join(reviews.select("qualification_url", F.col("verdict").alias("_v")), "qualification_url", "left")
    kept = out.where("remark_first is not null or _v is not null or _l is not null")
    return kept.withColumn("image_verdict", F.coalesce("_v", F.lit(""))).withColumn("image_label", N.image_label(F.col("remark_first"), F.col("_l"), F.col("_v"))).drop("_l", "_v")


def upsert(table: DataFrame, changes: DataFrame, keys: list[str], keep_old: bool = False) -> DataFrame:
    """``table`` with the rows of ``changes`` by key: the last change (by ``seq``) wins, or with ``keep_old`` the row that was there."""
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in table.columns if c not in keys]), "seq").alias("_r")).select(*keys, "_r.*").select(*table.columns)
    if keep_old:
        return table.unionByName(last.join(table, keys, "left_anti"))
    return table.join(last, keys, "left_anti").unionByName(last)


def toggled(events: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that an odd number of toggles left set."""
    return events.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n % 2 = 1").drop("_n")


def claim(pool: DataFrame, workers: DataFrame) -> DataFrame:
    """``(cluster_id, assignee)``: the oldest open clusters to idle workers, one each.

    As many clusters as there are workers are ranked; ``workers`` is the short list of people.
    """
    n = workers.count()
    place = lambda *o: F.row_number().over(Window.orderBy(*o))
    first = pool.where("assignee is null and completed_at is null").orderBy("created_at", "cluster_id").limit(n)
    return first.select("cluster_id", place("created_at", "cluster_id").alias("_n")).join(F.broadcast(workers.select(F.col("email").alias("assignee"), place("idle_since", "email").alias("_n"))), "_n").drop("_n")


def leases(tasks: DataFrame, now: Column, hours: int = 2) -> DataFrame:
    """Running tasks that began over ``hours`` before ``now`` are failed."""
    late = (F.col("status") == "running") & (F.col("started_at") < now - F.make_dt_interval(F.lit(0), F.lit(hours)))
    return tasks.withColumns({"status": F.when(late, "failed").otherwise(F.col("status")), "timed_out": F.coalesce(late, F.lit(False))})


def to_resume(tasks: DataFrame, now: Column, seconds: int = 60) -> DataFrame:
    """Pending tasks, and running ones whose last heartbeat is older than ``seconds``."""
    stale = F.coalesce(F.col("heartbeat_at") < now - F.make_dt_interval(secs=F.lit(seconds)), F.lit(True))
    return tasks.where((F.col("status") == "pending") | ((F.col("status") == "running") & stale))


def stage_states(log: DataFrame, stages: list[str]) -> DataFrame:
    """Each run's stages in their fixed order with the last status (by ``seq``), ``pending`` where there is none."""
    last = log.groupBy("run_id", "stage").agg(F.max_by("status", "seq").alias("status"))
    fixed = F.explode(F.array(*[F.struct(F.lit(k).alias("place"), F.lit(s).alias("stage")) for k, s in enumerate(stages)])).alias("_s")
    every = log.select("run_id").distinct().select("run_id", fixed).select("run_id", "_s.*")
    return every.join(last, ["run_id", "stage"], "left").withColumn("status", F.coalesce("status", F.lit("pending")))


def run_status(states: DataFrame) -> DataFrame:
    """A run is failed, running, done (all stages done or skipped) or pending."""
    any_ = lambda s: F.bool_or(F.col("status") == s)
    closed = F.bool_and(F.col("status").isin("done", "skipped"))
    return states.groupBy("run_id").agg(F.when(any_("failed"), "failed").when(closed, "done").when(any_("running") | any_("done"), "running").otherwise("pending").alias("status"))


def decisions(candidates: DataFrame, verdicts: DataFrame, reviews: DataFrame, strict: bool = False) -> DataFrame:
    """What happens to each candidate: the reviewer's keep or drop, or else whether its picture is electronic.

    ``shown`` is the default of the review page (any electronic verdict drops);
    ``submitted`` drops only those of high confidence unless ``strict``.
    """
    out = candidates.join(verdicts, "qualification_url", "left").join(reviews.select("cluster_id", "decision"), "cluster_id", "left")
    human = F.when(F.col("decision").isin("keep", "drop"), F.col("decision"))
    electronic = F.coalesce("is_electronic", F.lit(False))
    drop = electronic & (F.lit(strict) | F.coalesce(F.col("confidence") == "high", F.lit(False)))
    word = lambda c: F.when(c, "drop").otherwise("keep")
    return out.withColumn("shown", F.coalesce(human, word(electronic))).withColumn("submitted", F.coalesce(human, word(drop)))


# Words in a header that hint at the kind of its ids.
ID_HINTS = {
    "uid": ("user_id", "userid", "uid", "账户id", "账号id", "用户id"),
    "audit_order": ("history_id", "task_id", "版本id", "任务id", "订单号", "物料id"),
}


def detect_id_columns(df: DataFrame, least: float = 0.9) -> DataFrame:
    """``(column, kind, ratio, chosen)``: columns whose header hints at the kind
    of ids that most of their cells are, with a share of ``least`` or more.

    Cells of 24 hexadecimal digits are ``uid``, of six digits and more
    ``audit_order``. The last ``uid`` column is ``chosen``, unless an
    ``audit_order`` column comes after it; of those the first counts.
    """
    named = [(i, c, next((k for k, words in ID_HINTS.items() if any(w in c.lower() for w in words)), None)) for i, c in enumerate(df.columns)]
    listed = [F.struct(F.lit(i).alias("at"), F.lit(c).alias("column"), F.lit(k).alias("hint"), F.trim(F.col(f"`{c}`").cast("string")).alias("x")) for i, c, k in named]
    cells = df.select(F.explode(F.array(*listed)).alias("_c")).select("_c.*").where("x <> '' and hint is not null")
    kind = F.when(F.lower("x").rlike("^[0-9a-f]{24}$"), "uid").when(F.col("x").rlike("^[0-9]{6,}$"), "audit_order").otherwise("unknown")
    votes = cells.groupBy("at", "column", "hint").agg(F.count("*").alias("n"), F.count_if(kind == F.col("hint")).alias("own"))
    held = votes.select("at", "column", F.col("hint").alias("kind"), (F.col("own") / F.col("n")).alias("ratio")).where(F.col("ratio") >= least)
    last_uid = F.max(F.when(F.col("kind") == "uid", F.col("at")))
    ends = held.agg(last_uid.alias("u"), F.sort_array(F.collect_list(F.when(F.col("kind") == "audit_order", F.col("at")))).alias("o"))  # one element a column
    after = F.filter("o", lambda x: F.coalesce(x > F.col("u"), F.lit(True)))
    return held.crossJoin(F.broadcast(ends)).select("column", "kind", "ratio", (F.col("at") == F.coalesce(F.try_element_at(after, F.lit(1)), F.col("u"))).alias("chosen"))


def batches(rows: DataFrame, size: int = 10) -> DataFrame:
    """Batches of ``size`` rows in order of ``index`` (from 0), each row with its place from 1."""
    return rows.groupBy(F.floor(F.col("index") / size).alias("batch")).agg(F.array_sort(F.collect_list(F.struct((F.col("index") % size + 1).alias("idx"), "qualification_url"))).alias("rows"))


def batch_verdicts(found: DataFrame) -> DataFrame:
    """Verdicts by url from ``(rows, results)`` of a batch, met by place."""
    rows = found.select("batch", F.explode("rows").alias("r")).select("batch", "r.*")
    got = found.select("batch", F.explode("results").alias("v")).select("batch", F.col("v.idx").alias("idx"), F.col("v.is_electronic").alias("is_electronic"), F.col("v.confidence").alias("confidence"))
    return rows.join(got, ["batch", "idx"], "left").select("qualification_url", F.coalesce("is_electronic", F.lit(False)).alias("is_electronic"), F.coalesce("confidence", F.lit("low")).alias("confidence"))
