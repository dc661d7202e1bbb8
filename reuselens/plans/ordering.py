"""A place in a total order without a window over one partition."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .materialize import materialize


def global_index(df: DataFrame, order: list[Column], name: str = "index") -> DataFrame:
    """``df`` with the place (from 0) of each row in ``order``.

    A range-partitioned sort is written once; then each partition's rows are
    shifted by the counts before it. Only one count for each partition meets in
    one task. Ties get places in any order; an empty table stays empty.
    """
    rows = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = [(r["p"], r["n"]) for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()]  # one row a partition
    offsets, total = np.zeros(max((p for p, _ in sizes), default=0) + 1, np.int64), 0
    for p, n in sorted(sizes):
        offsets[p], total = total, total + n
    # one array literal, looked up by place
    out = rows.withColumn(name, F.get(F.lit(offsets), part.cast("int")) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")
    out.table_path = rows.table_path  # so that it can be dropped
    return out
