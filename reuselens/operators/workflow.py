"""Datasets, pools, queues and runs as tables: counts, searches, deletions and state changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..plans.ordering import global_index

# The columns whose distinct values an artifact's statistics count.
ARTIFACT_COLUMNS = ("user_id", "cluster_id", "cluster", "group_id", "sample_group")
DUPLICATE_WORD = "重复"
RETRY_MARK = "（重试）"

# -- datasets and their clusters


def dataset_counts(items: DataFrame, by_hand: bool = True) -> DataFrame:
    """Per dataset: rows and distinct clusters; an upload by hand counts -1 as a cluster, an automatic one does not."""
    counted = F.col("cluster_id") if by_hand else F.when(F.col("cluster_id") != -1, F.col("cluster_id"))
    return items.groupBy("dataset_id").agg(F.count("*").alias("total_rows"), F.count_distinct(counted).alias("cluster_count"))


def cluster_reviews(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Reviews of images with the cluster of each item that shows them."""
    return reviews.join(items.select("dataset_id", "qualification_url", "cluster_id"), ["dataset_id", "qualification_url"])


def completed_clusters(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per dataset and cluster: distinct images, reviewed ones, and whether all are."""
    own = items.where("cluster_id <> -1").select("dataset_id", "cluster_id", "qualification_url").distinct()
    seen = reviews.select("dataset_id", "qualification_url").distinct().withColumn("_r", F.lit(1))
    out = own.join(seen, ["dataset_id", "qualification_url"], "left").groupBy("dataset_id", "cluster_id").agg(F.count("*").alias("images"), F.count("_r").alias("reviewed"))
    return out.withColumn("completed", (F.col("images") > 0) & (F.col("reviewed") >= F.col("images")))


def image_progress(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: distinct images in clusters, and those reviewed."""
    own = items.where("cluster_id <> -1").select("dataset_id", "qualification_url").distinct()
    seen = reviews.select("dataset_id", "qualification_url").distinct().withColumn("_r", F.lit(1))
    return own.join(seen, ["dataset_id", "qualification_url"], "left").agg(F.count("*").alias("total"), F.count("_r").alias("reviewed"))


def claimed_images(items: DataFrame, pool: DataFrame, assignee: str) -> DataFrame:
    """Items of the clusters that ``assignee`` holds and has not completed."""
    mine = pool.where((F.col("assignee") == assignee) & F.col("completed_at").isNull()).select("dataset_id", "cluster_id")
    return items.join(mine, ["dataset_id", "cluster_id"], "left_semi")


def task_counts(pool: DataFrame, assignee: str) -> DataFrame:
    """One row: clusters of the pool, completed ones, and those that ``assignee`` completed."""
    done = F.col("completed_at").isNotNull()
    return pool.agg(F.count("*").alias("total"), F.count_if(done).alias("done"), F.count_if(done & F.coalesce(F.col("assignee") == assignee, F.lit(False))).alias("mine"))


def page_of(items: DataFrame, cluster: int, page: int, size: int, order: str = "row_idx") -> DataFrame:
    """Items of one cluster on a page (from 1) in ``order``, with the ``total`` of the cluster."""
    own = items.where(F.col("cluster_id") == cluster)
    rows = own.orderBy(order).offset((page - 1) * size).limit(size)
    return rows.crossJoin(F.broadcast(own.agg(F.count("*").alias("total"))))  # one row


def filtered_list(clusters: DataFrame, first: str | None = None, second: str | None = None, trade: str | None = None, matched: DataFrame | None = None, order: str = "cluster_id", unlabelled: str = "未打标") -> DataFrame:
    """Clusters by label, second label, part of a trade name and matched ids; ``seq`` is the place before filtering, from 1."""
    out = global_index(clusters, [F.asc(order)], "_i").withColumn("seq", F.col("_i") + 1).drop("_i")
    if first == unlabelled:
        out = out.where("remark_first is null")
    elif first:
        out = out.where(F.col("remark_first") == first)
    if second:
        out = out.where(F.col("remark_second") == second)
    if trade and trade.strip():
        part = F.lit(trade.strip().lower())
        out = out.where(F.contains(F.lower(F.coalesce("trade_first_name", F.lit(""))), part) | F.contains(F.lower(F.coalesce("trade_second_name", F.lit(""))), part))
    return out if matched is None else out.join(matched.select("cluster_id").distinct(), "cluster_id", "left_semi")


def deleted_on(datasets: DataFrame, day: str, channel: str | None = None) -> DataFrame:
    """``datasets`` with ``deleted``: made on ``day`` (yyyy-MM-dd), in ``channel`` if given."""
    hit = F.date_format("created_at", "yyyy-MM-dd") == day
    return datasets.withColumn("deleted", F.coalesce(hit if channel is None else hit & (F.col("channel") == channel), F.lit(False)))


def deleted_named(datasets: DataFrame, word: str, channel: str | None = None) -> DataFrame:
    """``datasets`` with ``deleted``: a name that contains ``word`` in any case, in ``channel`` if given."""
    hit = F.contains(F.lower("name"), F.lit(word.lower()))
    return datasets.withColumn("deleted", F.coalesce(hit if channel is None else hit & (F.col("channel") == channel), F.lit(False)))


def orphans(tags: DataFrame, known: DataFrame, key: str = "tag") -> DataFrame:
    """Tags that no known row carries."""
    return tags.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")


def one_sided(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``(key, side)``: values of only one of two tables (``left`` or ``right``)."""
    both = a.select(key).distinct().withColumn("_a", F.lit(1)).join(b.select(key).distinct().withColumn("_b", F.lit(1)), key, "full_outer")
    return both.where("_a is null or _b is null").select(key, F.when(F.col("_a").isNotNull(), "left").otherwise("right").alias("side"))


def same_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: ``equal``, and how many values only one table has."""
    out = one_sided(a, b, key).agg(F.count_if(F.col("side") == "left").alias("only_left"), F.count_if(F.col("side") == "right").alias("only_right"))
    return out.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


# -- pools and queues


def released(pool: DataFrame, assignee: str) -> DataFrame:
    """``pool`` after ``assignee`` gave back what is not completed."""
    mine = F.coalesce(F.col("assignee") == assignee, F.lit(False)) & F.col("completed_at").isNull()
    return pool.withColumns({c: F.when(~mine, F.col(c)) for c in ("assignee", "claimed_at")})


def requeued(tasks: DataFrame, ids: DataFrame) -> DataFrame:
    """``tasks`` with the asked ones pending again; ``refused`` says why one was not (``state`` or ``content``)."""
    out = tasks.join(ids.select("task_id", F.lit(True).alias("_q")).distinct(), "task_id", "left")
    refused = F.when(~F.col("status").isin("running", "failed"), "state").when(F.col("content").isNull(), "content")
    go = F.coalesce("_q", F.lit(False)) & refused.isNull()
    out = out.withColumn("refused", F.when(F.col("_q"), refused))
    changed = {c: F.when(~go, F.col(c)) for c in ("started_at", "finished_at", "detail")} | {"status": F.when(go, "pending").otherwise(F.col("status"))}
    return out.withColumns(changed).drop("_q")


def retried(tasks: DataFrame, ids: DataFrame) -> DataFrame:
    """New pending tasks for the asked ones that failed and still have their content: ``(retry_of, title, content, status)``."""
    own = tasks.join(ids.select("task_id").distinct(), "task_id", "left_semi").where("status = 'failed' and content is not null")
    title = F.concat(F.regexp_replace("title", "（重试(?:[0-9]+)?）$", ""), F.lit(RETRY_MARK))
    return own.select(F.col("task_id").alias("retry_of"), title.alias("title"), "content", F.lit("pending").alias("status"))


def next_tasks(tasks: DataFrame, workers: DataFrame) -> DataFrame:
    """``(worker, task_id)``: pending tasks to idle workers that can do their mode, oldest first, one each.

    ``workers (worker, modes)`` is the short list of runners. Workers of one
    set of modes are served together; sets of fewer modes come first, so that a
    worker with more of them takes what is left.
    """
    people = workers.select("worker", F.array_sort("modes").alias("modes")).collect()  # the list of runners
    taken, left = None, tasks.where("status = 'pending'").select("task_id", "created_at", "mode")
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in people:
        groups.setdefault(tuple(p["modes"]), []).append(p["worker"])
    for modes, names in sorted(groups.items(), key=lambda g: (len(g[0]), g[0])):
        first = left.where(F.col("mode").isin(*modes)).orderBy("created_at", "task_id").limit(len(names))
        ranked = first.select("task_id", F.row_number().over(Window.orderBy("created_at", "task_id")).alias("n"))  # as many rows as workers
        one = ranked.select(F.element_at(F.array(*[F.lit(w) for w in sorted(names)]), F.col("n")).alias("worker"), "task_id")
        taken = one if taken is None else taken.unionByName(one)
        left = left.join(F.broadcast(one.select("task_id")), "task_id", "left_anti")
    return taken if taken is not None else left.select(F.lit("").alias("worker"), "task_id").where("false")


def runner_stats(targets: DataFrame, result: DataFrame) -> DataFrame:
    """One row: asked accounts, those in a cluster, those outside, and those without an embedding.

    ``result (user_id, cluster_id[, is_target])`` is a run's table.
    """
    own = result.where("is_target") if "is_target" in result.columns else result
    have = own.groupBy("user_id").agg(F.bool_or(F.col("cluster_id") != -1).alias("inside"))
    asked = targets.select("user_id").distinct()
    counts = have.agg(F.count("*").alias("have"), F.count_if("inside").alias("n_clustered"))
    out = asked.agg(F.count("*").alias("n_accounts")).crossJoin(F.broadcast(counts))  # one row
    return out.select("n_accounts", "n_clustered", (F.col("have") - F.col("n_clustered")).alias("n_unclustered"), (F.col("n_accounts") - F.col("have")).alias("n_no_emb"))


# -- runs


def board_metrics(rows: DataFrame, task: DataFrame, least_users: int = 2) -> DataFrame:
    """One row of a run's figures: what was fetched, clustered and uploaded for review."""
    target = F.when(F.col("is_target_user"), F.col("user_id"))
    fetch = rows.agg(F.count("*").alias("input_rows"), F.count_distinct("user_id").alias("week_users"), F.count_distinct(target).alias("target_users"))
    users = rows.where("cluster_id >= 0").groupBy("cluster_id").agg(F.count_distinct("user_id").alias("u"))
    cluster = users.agg(F.count("*").alias("all_clusters"), F.count_if(F.col("u") < least_users).alias("single_user_clusters"))
    upload = task.agg(F.count("*").alias("task_rows"), F.count_distinct("cluster_id").alias("task_clusters"), F.count_distinct("user_id").alias("task_users"), F.count_distinct(target).alias("task_target_users"))
    return fetch.crossJoin(F.broadcast(cluster)).crossJoin(F.broadcast(upload))  # one row each


def task_statistics(rows: DataFrame, least_users: int = 2, mode: str = "all") -> DataFrame:
    """One row of the eleven figures of an annotation task and the clusters it leaves out."""
    target = F.when(F.col("is_target_user"), F.col("user_id"))
    total = rows.agg(F.count("*").alias("input_rows"), F.count_distinct("user_id").alias("input_users"), F.count_distinct(target).alias("input_target_users"))
    counted = F.col("user_id") if mode == "all" else target
    per = rows.where("cluster_id >= 0").groupBy("cluster_id").agg(F.bool_or("is_target_user").alias("t"), F.count_distinct(counted).alias("u"))
    good = F.col("t") & (F.col("u") >= least_users)
    clusters = per.agg(F.count("*").alias("all_clusters"), F.count_if("t").alias("clusters_with_target"), F.count_if(good).alias("task_clusters"))
    task = rows.where("cluster_id >= 0").join(per.where(good).select("cluster_id"), "cluster_id", "left_semi")
    own = task.agg(F.count("*").alias("task_rows"), F.count_distinct("user_id").alias("task_users"), F.count_distinct(target).alias("task_target_users"))
    out = total.crossJoin(F.broadcast(clusters)).crossJoin(F.broadcast(own))  # one row each
    return out.select(F.lit(mode).alias("min_user_mode"), F.lit(least_users).alias("min_users"), "*", (F.col("clusters_with_target") - F.col("task_clusters")).alias("dropped_clusters"))


def expansion_statistics(rows: DataFrame, samples: DataFrame, whole: DataFrame, expanded: DataFrame) -> DataFrame:
    """One row of an expansion's counters; ``whole`` is the expansion with clusters of single accounts kept."""
    sampled = samples.select(F.trim("user_id").alias("user_id")).where("user_id <> ''").distinct()
    best = rows.join(sampled, "user_id", "left_semi").groupBy("user_id").agg(F.max("cluster_id").alias("c"))
    present = best.agg(F.count("*").alias("valid_sample_users"), F.count_if(F.col("c") < 0).alias("unmatched_cluster"))
    inside = F.when(F.col("cluster_id") >= 0, F.col("cluster_id"))
    out = expanded.agg(
        F.count_distinct(inside).alias("hit_clusters"),
        F.count_distinct(F.when(~F.col("is_sample_user"), F.col("user_id"))).alias("expanded_users"),
        F.count_distinct("user_id").alias("annotate_users_total"),
        F.count("*").alias("annotate_rows_total"),
    )
    gone = whole.where("cluster_id >= 0").join(expanded.where("cluster_id >= 0").select("cluster_id").distinct(), "cluster_id", "left_anti")
    dropped = gone.agg(F.count_distinct("cluster_id").alias("dropped_solo_clusters"), F.count("*").alias("dropped_solo_rows"))
    parts = [present, out, dropped, rows.agg(F.count("*").alias("cluster_source_rows"))]
    first = sampled.agg(F.count("*").alias("sample_total"))
    for p in parts:
        first = first.crossJoin(F.broadcast(p))  # one row each
    return first.withColumn("no_qual_img_excluded", F.col("sample_total") - F.col("valid_sample_users"))


def artifact_statistics(artifact: DataFrame) -> DataFrame:
    """``(column, distinct, rows)``: rows of a table, and the distinct cells that aren't blank of the columns that are known."""
    held = [c for c in ARTIFACT_COLUMNS if c in artifact.columns]
    counts = artifact.agg(F.count("*").alias("_rows"), *[F.count_distinct(N.trimmed(F.col(c))).alias(c) for c in held])
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct")) for c in held])
    return counts.select("_rows", F.explode(listed).alias("c")).select("c.column", "c.distinct", F.col("_rows").alias("rows"))


def _outcome(done: Column) -> Column:
    duplicate = F.contains(F.coalesce("error", F.lit("")), F.lit(DUPLICATE_WORD))
    failed = (F.coalesce("error", F.lit("")) != "") & ~duplicate
    return F.struct(done.alias("ok"), duplicate.alias("dup"), failed.alias("err"))


def report_summary(report: DataFrame) -> DataFrame:
    """Per run: rows, ``ok`` (step ``done``), duplicates, failures (an error of another kind and not done) and stored ids."""
    o = report.withColumn("_o", _outcome(F.coalesce(F.col("step") == "done", F.lit(False))))
    stored = F.col("_o.ok") & F.coalesce(F.col("sample_id").rlike("^[0-9]+$"), F.lit(False))
    return o.groupBy("run_id").agg(F.count("*").alias("total"), F.count_if("_o.ok").alias("ok"), F.count_if("_o.dup").alias("duplicated"), F.count_if(F.col("_o.err") & ~F.col("_o.ok")).alias("failed"), F.count_if(stored).alias("stored"))


def bot_summary(report: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row: successes (done or dry run), duplicates, errors, and the clusters that were skipped."""
    o = report.select(_outcome(F.coalesce(F.col("step").isin("done", "dry-run-ok"), F.lit(False))).alias("_o"))
    out = o.agg(F.count_if("_o.ok").alias("success"), F.count_if("_o.dup").alias("duplicate"), F.count_if("_o.err").alias("error"))
    return out.crossJoin(F.broadcast(skipped.agg(F.count("*").alias("skipped"))))  # one row


# -- pictures and uploads


def overridden(verdicts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Verdicts after the reviewers: ``keep`` is not electronic (``human``), ``drop`` is (``high``), ``auto`` stays."""
    out = verdicts.join(decisions.select("cluster_id", "decision"), "cluster_id", "left")
    keep, drop = (F.coalesce(F.col("decision") == w, F.lit(False)) for w in ("keep", "drop"))
    changed = {"is_electronic": F.when(keep, False).when(drop, True).otherwise(F.col("is_electronic")), "confidence": F.when(keep, "human").when(drop, "high").otherwise(F.col("confidence"))}
    return out.withColumns(changed).drop("decision")


def parsed_answers(answers: DataFrame, column: str = "answer") -> DataFrame:
    """A classifier's answers as ``is_electronic``, ``confidence`` and ``reason``.

    The object may stand alone, in a fenced block or inside other text; what
    can't be read is not electronic, of low confidence, with ``parse_fail`` and
    the first hundred characters as reason.
    """
    text = F.trim(F.col(column))
    blocks = F.transform(F.split(text, "```"), lambda p: F.trim(F.regexp_replace(F.trim(p), "^json", "")))
    fenced = F.try_element_at(F.filter(blocks, lambda p: F.startswith(p, F.lit("{")) & F.endswith(p, F.lit("}"))), F.lit(1))
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    body = F.coalesce(F.when(F.contains(text, F.lit("```")), fenced), F.when(F.startswith(text, F.lit("{")), text), F.nullif(inner, F.lit("")))
    read = F.from_json(body, "is_electronic boolean, confidence string, reason string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    ok = F.coalesce(read["_bad"].isNull() & body.isNotNull() & read.isNotNull(), F.lit(False))
    return answers.withColumn("_r", read).withColumns(
        {
            "is_electronic": F.when(ok, F.coalesce("_r.is_electronic", F.lit(False))).otherwise(False),
            "confidence": F.when(ok, F.lower(F.coalesce("_r.confidence", F.lit("low")))).otherwise("low"),
            "reason": F.when(ok, F.left(F.coalesce("_r.reason", F.lit("")), F.lit(200))).otherwise(F.concat(F.lit("parse_fail: "), F.left(F.coalesce(text, F.lit("")), F.lit(100)))),
        }
    ).drop("_r")


def split_electronic(candidates: DataFrame, verdicts: DataFrame, strict: bool = False) -> DataFrame:
    """``candidates`` with ``passed``: false for electronic pictures of high confidence, or of any with ``strict``."""
    out = candidates.join(verdicts.select("qualification_url", "is_electronic", "confidence"), "qualification_url", "left")
    drop = F.coalesce("is_electronic", F.lit(False)) & (F.lit(strict) | F.coalesce(F.col("confidence") == "high", F.lit(False)))
    return out.withColumn("passed", ~drop)


def decision_sums(candidates: DataFrame) -> DataFrame:
    """One row over ``(is_electronic, decision)``: total, kept, dropped, electronic, and decisions by a reviewer."""
    electronic = F.coalesce("is_electronic", F.lit(False))
    human = F.when(F.col("decision").isin("keep", "drop"), F.col("decision"))
    kept = F.coalesce(human == "keep", ~electronic)
    return candidates.agg(F.count("*").alias("total"), F.count_if(kept).alias("will_keep"), F.count_if(~kept).alias("will_drop"), F.count_if(electronic).alias("vlm_electronic"), F.count_if(human.isNotNull()).alias("human_overrides"))


def upload_overview(upload: DataFrame, url: str | None) -> DataFrame:
    """One row: rows, those with an http url, and up to six of these urls, in order."""
    if url is None:
        return upload.agg(F.count("*").alias("rows_total"), F.lit(0).cast("long").alias("rows_with_url"), F.array().cast("array<string>").alias("sample_urls"))
    own = upload.select(F.trim(F.col(url)).alias("u"))
    held = own.where(F.startswith("u", F.lit("http")))
    first = held.select("u", F.monotonically_increasing_id().alias("i")).orderBy("i").limit(6).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "u"))), lambda x: x["u"]).alias("sample_urls"))
    counts = own.agg(F.count("*").alias("rows_total"), F.count_if(F.startswith("u", F.lit("http"))).alias("rows_with_url"))
    return counts.crossJoin(F.broadcast(first))  # one row
