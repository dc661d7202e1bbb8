"""Clusters of sliding windows of days, kept up day by day.

Similar pairs are stored by the day of their later row. A new day is held
against the days of its window only, once; a window's clusters come from the
stored pairs of its days, and days that no window needs any more are dropped.
So a day costs a day's work, and its labels are those of clustering its whole
window anew.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.statistics import target_or_history
from ..plans.materialize import drop_path
from .merging import near_between
from .similarity import candidate_edges, label_clusters


class WindowClusters:
    """Rows ``(row_idx, embedding, ..)`` of days and their similar pairs, in a folder.

    ``least`` and ``k`` are those of the clusters: rows are linked by a cosine
    of ``least`` or more among the ``k`` nearest of the window. Vectors have
    length one, row ids are unique over all days.
    """

    def __init__(self, spark: SparkSession, path: str, days: int = 7, least: float = 0.98, k: int = 10) -> None:
        self.spark, self.path, self.days, self.least, self.k = spark, path.rstrip("/"), days, least, k

    def _held(self, what: str) -> list[date]:
        """Days with a partition, from the folder's listing."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{what}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(date.fromisoformat(n.removeprefix("day=")) for n in names if n.startswith("day="))

    def _read(self, what: str, last: date) -> DataFrame:
        """The partitions of the window that ends with ``last``."""
        first = last - timedelta(self.days - 1)
        return self.spark.read.parquet(f"{self.path}/{what}").withColumn("day", F.col("day").cast("date")).where(F.col("day").between(first, last))

    def add_day(self, rows: DataFrame, day: date) -> None:
        """Store a day's rows and their similar pairs with each other and with the days before in the window.

        A day given again replaces what it gave before; days come in order, as
        the pairs of a later day would still hold the old rows.
        """
        if any(d > day for d in self._held("pairs")):
            raise ValueError(f"days after {day} are there already")
        rows.drop("day").write.mode("overwrite").parquet(f"{self.path}/rows/day={day}")
        today = self.spark.read.parquet(f"{self.path}/rows/day={day}")
        # where a run ends between these two, the rows are there without pairs, and the day is not held
        window = self._read("rows", day).select("row_idx", "embedding", "day")
        near = near_between(today, window, None, least=self.least).where("src <> dst")
        near.join(window.select(F.col("row_idx").alias("dst"), F.col("day").alias("other")), "dst").select("src", "dst", "score", "other").write.mode("overwrite").parquet(f"{self.path}/pairs/day={day}")

    def edges(self, day: date) -> DataFrame:
        """``(src, dst, score)`` of the window that ends with ``day``: pairs among the ``k`` nearest of either end."""
        first = day - timedelta(self.days - 1)
        held = self._read("pairs", day).where(F.col("other") >= F.lit(first))
        # a pair of two days is stored once, with its later row first; a pair of one day both ways
        both = held.select("src", "dst", "score").unionByName(held.where("other < day").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "score"))
        place = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("score"), "dst"))
        return candidate_edges(both.withColumn("_r", place).where(F.col("_r") <= self.k), self.least)

    def labels(self, day: date) -> DataFrame:
        """The rows of the window that ends with ``day``, with ``cluster_id`` and whether they are of the day or of those before."""
        if day not in self._held("pairs"):
            raise ValueError(f"{day} has not been added")
        rows = self._read("rows", day)
        return label_clusters(rows.withColumn("source_window", target_or_history(F.col("day"), day, self.days)), self.edges(day))

    def drop_before(self, day: date) -> None:
        """Remove the days that windows from the one ending with ``day`` on don't reach."""
        first = day - timedelta(self.days - 1)
        for what in ("pairs", "rows"):
            for old in self._held(what):
                if old < first:
                    drop_path(self.spark, f"{self.path}/{what}/day={old}")
