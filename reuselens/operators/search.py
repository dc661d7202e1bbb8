"""Accounts by a part of their id, from posting lists of the grams in it.

The index holds, in buckets of the gram, which accounts have it, and in buckets
of the account, which clusters it is in. A search reads the buckets of its own
grams, keeps accounts that have them all, makes sure of the part itself, and
reads the clusters of those left.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ACCOUNTS, _GRAMS = "user string, cluster_id int, n long, bucket int", "user string, gram string, bucket int"


def write_search_index(items: DataFrame, path: str, buckets: int = 64) -> None:
    """Index the accounts of ``items (user_id, cluster_id)`` that are in a cluster; replaces what was at ``path``.

    Grams are all runs of two and of three characters, in lower case, each
    once an account; an account of one character has none and is never found,
    as searches take two.
    """
    bucket = lambda c: F.pmod(F.crc32(c), F.lit(buckets)).cast("int")
    held = items.where("cluster_id <> -1 and user_id is not null").groupBy(F.lower("user_id").alias("user"), F.col("cluster_id").cast("int").alias("cluster_id")).agg(F.count("*").alias("n"))
    held.withColumn("bucket", bucket("user")).repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/accounts")
    users = items.sparkSession.read.schema(_ACCOUNTS).parquet(f"{path}/accounts").select("user").distinct().where(F.char_length("user") >= 2)
    size = F.char_length("user")
    runs = lambda k: F.when(size >= k, F.transform(F.sequence(F.lit(1), size - (k - 1)), lambda i: F.substring("user", i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    grams = users.select("user", F.explode(F.array_distinct(F.concat(runs(2), runs(3)))).alias("gram")).withColumn("bucket", bucket("gram"))
    # an own sort in each bucket lets readers skip row groups without the gram
    grams.repartition(buckets, "bucket").sortWithinPartitions("bucket", "gram", "user").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/grams")


def _postings(spark: SparkSession, path: str, wanted: str, buckets: int) -> DataFrame:
    """``(user)``: accounts that have all grams of ``wanted``; the rows read are those of its grams."""
    grams = sorted({wanted} if len(wanted) == 2 else {wanted[k : k + 3] for k in range(len(wanted) - 2)})
    numbers = {zlib.crc32(g.encode()) % buckets for g in grams}
    rows = spark.read.schema(_GRAMS).parquet(f"{path}/grams").where(F.col("bucket").isin(*numbers) & F.col("gram").isin(*grams))
    return rows.groupBy("user").agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select("user")


def search_indexed(spark: SparkSession, path: str, part: str, limit: int = 500, buckets: int = 64) -> DataFrame:
    """The rows of :func:`..review.search_user` for the indexed items: distinct ``cluster_id`` and ``total``, the matching rows."""
    wanted = part.strip().lower()
    accounts = spark.read.schema(_ACCOUNTS).parquet(f"{path}/accounts")
    if len(wanted) < 2:
        return accounts.where("false").select("cluster_id", F.col("n").alias("total"))
    users = _postings(spark, path, wanted, buckets).where(F.contains("user", F.lit(wanted))).withColumn("bucket", F.pmod(F.crc32("user"), F.lit(buckets)).cast("int"))
    hits = accounts.join(users, ["bucket", "user"])  # buckets without an account are pruned as the join runs
    total = hits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return hits.select("cluster_id").distinct().orderBy("cluster_id").limit(limit).crossJoin(F.broadcast(total))  # one row
