"""Joining rows with a row of their group where one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group is large if it holds more than one in so many rows; there are fewer large groups than this.
LARGE = 1 << 16


def with_groups(rows: DataFrame, groups: DataFrame, key: str, size: str = "n") -> DataFrame:
    """``rows`` with the other columns of ``groups``, one row a ``key`` with the number of its rows in ``size``; nulls without one.

    Groups of more than one in ``LARGE`` rows, fewer than ``LARGE`` by that
    very bound, are broadcast; so what is shuffled by ``key`` has no group of
    more than total / ``LARGE`` rows. Both tables are read twice and should be
    written ones. Keys are not null; empty tables stay empty.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * LARGE > F.lit(total)
    hot = F.broadcast(groups.where(large))
    rest = rows.join(F.broadcast(groups.where(large).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(groups.where(~large), key, "left"))
