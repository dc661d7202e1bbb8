"""Pages of a cluster's items read from one or two blocks of a sorted layout.

All items lie in one order, by cluster and then as they are listed, cut into
blocks of equal size; for each cluster the place of its first item and the
count are kept. A page is a range of places, so its blocks are known before
anything is read, however large the cluster is.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.materialize import drop_tables
from ..plans.ordering import global_index


def write_pages(items: DataFrame, path: str, order: tuple[str, ...] = ("row_idx",), block: int = 1 << 16, buckets: int = 64) -> None:
    """Lay ``items`` out at ``path``, a place that nothing else uses, in blocks of ``block`` rows.

    Items without a cluster are left out, as no page asks for them. Equal rows
    in ``order`` keep one place each, the same in every read.
    """
    spark = items.sparkSession
    # the items' columns stay in a struct, so that theirs can't clash with the layout's
    own = items.where("cluster_id is not null").select(F.struct(*[F.col(f"`{c}`") for c in items.columns]).alias("item"))
    cluster = F.col("item")["cluster_id"]
    placed = global_index(own, [F.asc(cluster), *[F.asc(F.col("item")[c]) for c in order]], "place")
    rows = placed.withColumn("_block", F.floor(F.col("place") / block).cast("long"))
    rows.repartition("_block").sortWithinPartitions("_block", "place").write.partitionBy("_block").parquet(f"{path}/rows")
    starts = placed.groupBy(cluster.cast("long").alias("cluster_id")).agg(F.min("place").alias("start"), F.count("*").alias("total"))
    bucket = F.pmod("cluster_id", F.lit(buckets)).cast("int")
    starts.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{path}/clusters")
    drop_tables(placed)
    layout = [(items.schema.json(), block, buckets)]
    spark.createDataFrame(layout, "schema string, block long, buckets int").coalesce(1).write.parquet(f"{path}/layout")  # last: a layout that is there is whole


def page_from(spark: SparkSession, path: str, cluster: int, page: int, size: int) -> DataFrame:
    """The rows of :func:`..workflow.page_of` for the items laid out at ``path``: a page (from 1) and the ``total`` of the cluster."""
    layout = spark.read.schema("schema string, block long, buckets int").parquet(f"{path}/layout").first()
    schema = StructType.fromJson(json.loads(layout["schema"]))
    clusters = spark.read.schema(f"cluster_id long, start long, total long, _bucket int").parquet(f"{path}/clusters")
    own = clusters.where((F.col("_bucket") == cluster % layout["buckets"]) & (F.col("cluster_id") == cluster)).first()  # one row
    skipped = max(0, page - 1) * size
    if own is None or skipped >= own["total"] or size < 1:
        return spark.createDataFrame([], schema).withColumn("total", F.lit(0).cast("long"))
    first = own["start"] + skipped
    last = min(first + size, own["start"] + own["total"]) - 1
    blocks = range(first // layout["block"], last // layout["block"] + 1)
    # read by their own names: the other blocks aren't even listed
    rows = spark.read.schema(StructType().add("item", schema).add("place", "long")).parquet(*[f"{path}/rows/_block={b}" for b in blocks])
    found = rows.where(F.col("place").between(first, last)).orderBy("place")
    return found.select(*[F.col("item")[c].alias(c) for c in schema.names], F.lit(own["total"]).cast("long").alias("total"))
