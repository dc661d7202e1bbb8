"""Writing results as tables of the shared store."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.materialize import drop_tables, materialize


def write_snapshot(df: DataFrame, path: str, key: str = "run_id") -> None:
    """Replace the partitions of the runs that ``df`` holds, and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV files with a header; with ``bom`` its first name begins with a byte-order mark."""
    first, *rest = df.columns
    named = df.withColumnRenamed(first, "﻿" + first) if bom else df
    named.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_views(df: DataFrame, views: dict[str, list[str]]) -> None:
    """The same rows written once for each path, with the columns named for it; the rows are computed once."""
    rows = materialize(df, "views")
    for path, columns in views.items():
        rows.select(*columns).write.mode("overwrite").parquet(path)
    drop_tables(rows)


def write_stats(df: DataFrame, path: str) -> None:
    """One JSON line for each row, in as many files as the rows lie in."""
    df.write.mode("overwrite").json(path)


def changed_cells(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose number is new, gone or differs by more than 1e-9, absolutely and in proportion."""
    both = old.select(*keys, F.col(value).alias("old")).join(new.select(*keys, F.col(value).alias("new")), keys, "full_outer")
    near = F.abs(F.col("old") - F.col("new")) <= F.greatest(F.lit(1e-9), 1e-9 * F.greatest(F.abs("old"), F.abs("new")))
    return both.where(~F.coalesce(near, F.col("old").isNull() & F.col("new").isNull()))


def gallery(rows: DataFrame, clusters: int = 200, images: int = 80) -> DataFrame:
    """The report of the largest ``clusters`` clusters with at most ``images`` images each."""
    top = rows.where("cluster_id >= 0").groupBy("cluster_id").agg(F.count("*").alias("cluster_size")).orderBy(F.desc("cluster_size"), "cluster_id").limit(clusters)
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy("row_idx"))
    return rows.join(F.broadcast(top), "cluster_id").withColumn("place", place).where(F.col("place") <= images)


def merged_block(sheet: DataFrame, block: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``sheet`` with the rows of ``block``: new keys are appended, and a key is rewritten as a whole
    where any of its ``values`` differs (:func:`changed_cells`); ``change`` says ``kept``, ``rewritten`` or ``appended``."""
    near = lambda c: F.abs(F.col(f"s.{c}") - F.col(f"b.{c}")) <= F.greatest(F.lit(1e-9), 1e-9 * F.greatest(F.abs(f"s.{c}"), F.abs(f"b.{c}")))
    both = sheet.withColumn("_s", F.lit(True)).alias("s").join(block.withColumn("_b", F.lit(True)).alias("b"), keys, "full_outer")
    same = F.lit(True)
    for c in values:
        same = same & F.coalesce(near(c), F.col(f"s.{c}").isNull() & F.col(f"b.{c}").isNull())
    change = F.when(F.col("_s").isNull(), "appended").when(F.col("_b").isNull() | same, "kept").otherwise("rewritten")
    picked = [F.when(F.col("_change") == "kept", F.col(f"s.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in values]
    return both.withColumn("_change", change).select(*keys, *picked, F.col("_change").alias("change"))


def unread_cells(written: DataFrame, block: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of ``block`` that a sheet that was read back lacks or holds with another number."""
    return changed_cells(written.join(block.select(*keys), keys, "left_semi"), block, keys, value)
