"""Naming a value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once for each row.

    An expression that a lambda mentions is otherwise evaluated again for each
    element the lambda visits.
    """
    return F.transform(F.array(value), body)[0]
