"""The shared test tables seen as the data model's inputs, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise as N
from .materialize import materialize
from .ordering import global_index

SETTLEMENT_SQL = """fx_settlement AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS BIGINT) AS apply_id, CAST(o_orderdate AS DATE) AS pro_settle_date,
    CAST(o_orderdate AS TIMESTAMP) AS pro_settle_tms, CASE WHEN o_orderstatus = 'P' THEN 'updateAudit' ELSE 'initAudit' END AS user_apply_type,
    CAST(o_orderkey % 5 AS INTEGER) AS certificate_type,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'SELLER_PASS' WHEN '2-HIGH' THEN 'AD_PASS' WHEN '3-MEDIUM' THEN 'PC' WHEN '4-NOT SPECIFIED' THEN '' ELSE 'APP' END AS apply_source,
    c_mktsegment AS first_trade_name, n_name AS second_trade_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

CLUSTER_SQL = """fx_i AS (
  SELECT CAST(doc_id AS BIGINT) AS row_idx, concat('u', CAST(doc_id % 61 AS VARCHAR)) AS user_id, concat('doc/', CAST(doc_id AS VARCHAR)) AS qualification_url,
    lang AS trade_first_name, source AS trade_second_name, md5(text) AS h, (doc_id % 7 = 0) AS is_target_user FROM documents),
fx_g AS (SELECT h, count(*) AS sz, min(row_idx) AS m FROM fx_i GROUP BY h HAVING count(*) > 1),
fx_r AS (SELECT h, row_number() OVER (ORDER BY sz DESC, m) - 1 AS cid FROM fx_g),
fx_cluster AS (SELECT row_idx, user_id, qualification_url, trade_first_name, trade_second_name, is_target_user, CAST(coalesce(cid, -1) AS INTEGER) AS cluster_id
  FROM fx_i LEFT JOIN fx_r ON fx_i.h = fx_r.h)"""

ANNOTATED_SQL = (
    CLUSTER_SQL
    + f""",
fx_annotated AS (SELECT f.*, CASE WHEN l.toxic = 1 THEN '{N.CONFIRMED}' WHEN l.quality = 0 THEN '{N.SUSPECTED}' WHEN l.doc_id IS NOT NULL THEN '{N.CLEAN}' END AS remark_first
  FROM fx_cluster f LEFT JOIN labels l ON f.row_idx = l.doc_id)"""
)

SAMPLE_SQL = """fx_u AS (SELECT DISTINCT user_id, CAST(substr(user_id, 2) AS INTEGER) AS k FROM fx_cluster),
fx_sample AS (SELECT user_id, 'overall' AS sample_group FROM fx_u WHERE k % 5 = 0
  UNION ALL SELECT user_id, 'finance' FROM fx_u WHERE k % 10 = 0 UNION ALL SELECT 'u900', 'overall')"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (_table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "SELLER_PASS").when(F.col("o_orderpriority") == "2-HIGH", "AD_PASS").when(F.col("o_orderpriority") == "3-MEDIUM", "PC").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise("APP")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("long").alias("apply_id"), F.col("o_orderdate").cast("date").alias("pro_settle_date"), F.col("o_orderdate").cast("timestamp_ntz").alias("pro_settle_tms"),
        F.when(F.col("o_orderstatus") == "P", "updateAudit").otherwise("initAudit").alias("user_apply_type"), (F.col("o_orderkey") % 5).cast("int").alias("certificate_type"), source.alias("apply_source"), F.col("c_mktsegment").alias("first_trade_name"), F.col("n_name").alias("second_trade_name"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as images, exact copies as clusters."""
    d = _table(spark, sf_dir, "documents")
    rows = d.select(
        F.col("doc_id").cast("long").alias("row_idx"), F.concat(F.lit("u"), F.col("doc_id") % 61).alias("user_id"), F.concat(F.lit("doc/"), F.col("doc_id")).alias("qualification_url"),
        F.col("lang").alias("trade_first_name"), F.col("source").alias("trade_second_name"), (F.col("doc_id") % 7 == 0).alias("is_target_user"), F.md5("text").alias("h"),
    )
    sizes = rows.where("h is not null").groupBy("h").agg(F.count("*").alias("sz"), F.min("row_idx").alias("m")).where("sz > 1")
    ranked = global_index(sizes, [F.desc("sz"), F.asc("m")], "cid").select("h", F.col("cid").cast("int").alias("cid"))
    out = rows.join(ranked, "h", "left").select(*[c for c in rows.columns if c != "h"], F.coalesce("cid", F.lit(-1)).alias("cluster_id"))
    return materialize(out, "fx-clusters")


def annotated(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("row_idx"), "quality", "toxic", F.lit(True).alias("_l"))
    mark = F.when(F.col("toxic") == 1, N.CONFIRMED).when(F.col("quality") == 0, N.SUSPECTED).when(F.col("_l"), N.CLEAN)
    rows = clusters(spark, sf_dir) if rows is None else rows
    return rows.join(labels, "row_idx", "left").select(*[F.col(c) for c in rows.columns], mark.alias("remark_first"))


def samples(rows: DataFrame) -> DataFrame:
    u = rows.select("user_id").distinct()
    k = F.expr("cast(substr(user_id, 2) as int)")
    overall = u.where(k % 5 == 0).select("user_id", F.lit("overall").alias("sample_group"))
    finance = u.where(k % 10 == 0).select("user_id", F.lit("finance").alias("sample_group"))
    absent = rows.sparkSession.range(1).select(F.lit("u900").alias("user_id"), F.lit("overall").alias("sample_group"))
    return overall.unionByName(finance).unionByName(absent)
