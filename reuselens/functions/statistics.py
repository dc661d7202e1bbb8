"""Sample sizes as Column expressions."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rational approximation 26.2.23 of the normal quantile.
NUMERATOR = (2.515517, 0.802853, 0.010328)
DENOMINATOR = (1.0, 1.432788, 0.189269, 0.001308)
MARGIN_FROM, MARGIN_LOW, MARGIN_HIGH = 0.30, 0.02, 0.05


def _poly(coefficients: tuple[float, ...], t: Column) -> Column:
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = total * t + F.lit(c)
    return total


def normal_quantile(p: Column) -> Column:
    """The normal quantile of ``p``, infinite at 0 and 1 and beyond."""
    t = F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    upper = t - _poly(NUMERATOR, t) / _poly(DENOMINATOR, t)
    inside = F.when(p < 0.5, -upper).otherwise(upper)
    return F.when(p <= 0, F.lit(-math.inf)).when(p >= 1, F.lit(math.inf)).otherwise(inside)


def default_margin(p: Column) -> Column:
    return F.when(p < MARGIN_FROM, F.lit(MARGIN_LOW)).otherwise(F.lit(MARGIN_HIGH))


def sample_size(p: Column, population: Column, margin: Column | None = None, confidence: float = 0.99, take_all: Column | None = None) -> Column:
    """The size that estimates a share near ``p`` within ``margin``, corrected for a finite population.

    Without a population (null or zero) no correction is made; rows where
    ``take_all`` holds take the population. Rounded up.
    """
    margin = default_margin(p) if margin is None else margin
    z = normal_quantile(F.lit(1 - (1 - confidence) / 2))
    endless = z * z * p * (1 - p) / (margin * margin)
    n = F.when(F.coalesce(population, F.lit(0)) == 0, endless).otherwise(endless * population / (endless + population - 1))
    if take_all is not None:
        n = F.when(take_all, population.cast("double")).otherwise(n)
    return F.ceil(n).cast("long")


def previous_week(day: Column) -> tuple[Column, Column, Column]:
    """Monday and Sunday of the week before ``day``, and that Sunday as ``yyyyMMdd``."""
    monday = F.date_sub(F.trunc(day, "week"), 7)
    sunday = F.date_add(monday, 6)
    return monday, sunday, F.date_format(sunday, "yyyyMMdd")


def target_or_history(day: Column, target: dt.date, days: int = 7) -> Column:
    """``target_day``, ``history_<days>d`` for the days before it, else null."""
    last = F.lit(target)
    return F.when(day == last, "target_day").when((day < last) & (day > F.date_sub(last, days)), f"history_{days}d")
