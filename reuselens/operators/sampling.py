"""Reproducible samples, and the clusters that a sample hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from ..plans.ordering import global_index

SALT = "_seed42"
# Margins that are tried, the one preferred next, and the most clusters that can be reviewed.
MARGINS = (0.02, 0.025, 0.03, 0.035, 0.04, 0.05)
SECOND_MARGIN, CEILING = 0.03, 750


def hash_rank(users: DataFrame, salt: str = SALT) -> DataFrame:
    """Distinct ``(user_id, hash, rank)``: places from 1 by the CRC-32 of id and salt; null ids fall out."""
    own = users.select("user_id").where("user_id is not null").distinct().withColumn("hash", F.crc32(F.concat("user_id", F.lit(salt))))
    return global_index(own, [F.asc("hash"), F.asc("user_id")], "_i").select("user_id", "hash", (F.col("_i") + 1).alias("rank"))


def hash_sample(users: DataFrame, n: int, salt: str = SALT) -> DataFrame:
    """The first ``n`` accounts by hash."""
    own = users.select("user_id").where("user_id is not null").distinct().withColumn("hash", F.crc32(F.concat("user_id", F.lit(salt))))
    return own.orderBy("hash", "user_id").limit(n)


def predicted_hits(rows: DataFrame, sizes: DataFrame, fixed: DataFrame, salt: str = SALT) -> DataFrame:
    """``(margin, n, clusters)``: clusters that the first ``n`` accounts and the ``fixed`` ones hit.

    ``sizes (margin, n)`` is a short list; the accounts are ranked once.
    """
    ranks = hash_rank(rows, salt).select("user_id", "rank")
    known = ranks.join(fixed.select("user_id").distinct().withColumn("_fixed", F.lit(True)), "user_id", "left")
    first = known.select("user_id", F.when(F.col("_fixed"), 0).otherwise(F.col("rank")).alias("rank"))
    per_cluster = rows.where("cluster_id >= 0").select("cluster_id", "user_id").distinct().join(first, "user_id").groupBy("cluster_id").agg(F.min("rank").alias("rank"))
    tried = [(float(r["margin"]), int(r["n"])) for r in sizes.select("margin", "n").collect()]  # a handful of margins
    counts = per_cluster.agg(*[F.count_if(F.col("rank") <= n).alias(f"c{k}") for k, (_, n) in enumerate(tried)])
    listed = F.array(*[F.struct(F.lit(m).alias("margin"), F.lit(n).cast("long").alias("n"), F.col(f"c{k}").alias("clusters")) for k, (m, n) in enumerate(tried)])
    return counts.select(F.inline(listed))


def choose_margin(hits: DataFrame, default: float, second: float = SECOND_MARGIN, ceiling: int = CEILING) -> DataFrame:
    """One row of ``hits``, with ``alarm``: the default margin if its clusters can be reviewed,
    else the second, else the smallest that can, else the widest with an alarm."""
    fits = F.col("clusters") <= ceiling
    order = F.when(fits & (F.col("margin") == default), 0).when(fits & (F.col("margin") == second), 1).when(fits, 2).otherwise(3)
    ranked = hits.withColumn("_o", order).withColumn("alarm", ~fits)
    return ranked.orderBy("_o", F.when(F.col("_o") == 3, -F.col("margin")).otherwise(F.col("margin"))).limit(1).drop("_o")


def merged_samples(samples: DataFrame) -> DataFrame:
    """One row an account: its sorted groups and source files, comma-joined."""
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.trim(c))), ",")
    return samples.where(F.trim("user_id") != "").groupBy(F.trim("user_id").alias("user_id")).agg(joined("sample_group").alias("sample_groups"), joined("source_file").alias("source_files"))


def expand_matches(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """All rows of the clusters that ``samples (user_id, sample_groups)`` hit, with what triggered each.

    ``is_sample_user``, and per cluster ``n_trigger_users``, ``trigger_groups``
    and ``trigger_users`` (sorted, comma-joined).
    """
    inside = rows.where("cluster_id >= 0")
    hits = inside.select("cluster_id", "user_id").distinct().join(samples.select("user_id", "sample_groups"), "user_id")
    users = hits.groupBy("cluster_id").agg(F.count("user_id").alias("n_trigger_users"), F.array_join(F.array_sort(F.collect_set("user_id")), ",").alias("trigger_users"))
    groups = hits.select("cluster_id", F.explode(F.split("sample_groups", ",")).alias("g")).groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_set("g")), ",").alias("trigger_groups"))
    stats = users.join(groups, "cluster_id", "left")
    flag = samples.select("user_id").distinct().withColumn("_s", F.lit(True))
    return inside.join(stats, "cluster_id").join(flag, "user_id", "left").withColumn("is_sample_user", F.coalesce("_s", F.lit(False))).drop("_s")


def expand_clusters(rows: DataFrame, samples: DataFrame, keep_solo: bool = False) -> DataFrame:
    """Whole clusters that a sample hits, and the sampled accounts outside clusters with -1.

    Rows are (user_id, qualification_url, cluster_id, row_idx, ...). An account
    and url comes once, from its smallest cluster that was hit. Clusters with a
    single account left are dropped, unless ``keep_solo``; sampled accounts
    that would vanish by that come back with all their rows and -1.
    """
    sampled = samples.select(F.trim("user_id").alias("user_id")).where("user_id <> ''").distinct().withColumn("is_sample_user", F.lit(True))
    # read by four branches below: computed once
    flagged = materialize(rows.join(sampled, "user_id", "left").withColumn("is_sample_user", F.coalesce("is_sample_user", F.lit(False))), "flagged")
    hit = flagged.where("is_sample_user and cluster_id >= 0").select("cluster_id").distinct()
    outside = flagged.where("is_sample_user").groupBy("user_id").agg(F.max("cluster_id").alias("_c")).where("_c < 0").select("user_id")
    taken = flagged.join(hit, "cluster_id", "left_semi").unionByName(flagged.where("is_sample_user").join(outside, "user_id", "left_semi"))
    key = Window.partitionBy("user_id", "qualification_url")
    once = lambda df, *order: df.withColumn("_n", F.row_number().over(key.orderBy(*order))).where("_n = 1").drop("_n")
    taken = once(taken, "cluster_id", "row_idx")
    if keep_solo:
        return taken
    solo = taken.where("cluster_id >= 0").groupBy("cluster_id").agg(F.min("user_id").alias("_a"), F.max("user_id").alias("_b")).where("_a = _b").select("cluster_id")
    kept = taken.join(solo, "cluster_id", "left_anti")
    gone = taken.join(solo, "cluster_id", "left_semi").where("is_sample_user").select("user_id").distinct().join(kept.select("user_id"), "user_id", "left_anti")
    back = once(flagged.join(gone, "user_id", "left_semi"), "row_idx").withColumn("cluster_id", F.lit(-1).cast(dict(rows.dtypes)["cluster_id"]))
    return kept.unionByName(back)


def canonical_order(rows: DataFrame) -> DataFrame:
    """Clustered rows first, by cluster, account and url."""
    return rows.orderBy(F.col("cluster_id") < 0, "cluster_id", "user_id", "qualification_url")
