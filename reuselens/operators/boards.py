"""What the weekly board shows: shares, drill-downs, ranks and one run in full."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..plans.ordering import global_index
from .reports import shares

CHANNELS = ("professional", "shop", "ad")


def industry_share(violations: DataFrame) -> DataFrame:
    """Industries with violations: ``(industry, violated, violated_share)``."""
    return shares(violations.where("violated > 0"), "industry", ["violated"])


def second_level(violations: DataFrame, industry: str) -> DataFrame:
    """Second-level industries of one industry with violations, most first, with their ``place`` from 0."""
    own = violations.where((F.col("industry1") == industry) & (F.col("violated") > 0)).select("industry2", "violated")
    return global_index(own, [F.desc("violated"), F.asc("industry2")], "place")


def method_shares(cert: DataFrame) -> DataFrame:
    """Each authentication method's percentage of its industry's registered and confirmed accounts (0 where there are none)."""
    total = cert.groupBy("industry").agg(F.sum("registered").alias("_r"), F.sum("confirmed").alias("_c"))
    pct = lambda part, whole: N.share(100 * F.col(part), F.col(whole), 1)
    return cert.join(total, "industry").select("industry", "method", "registered", "confirmed", pct("registered", "_r").alias("registered_pct"), pct("confirmed", "_c").alias("confirmed_pct"))


def source_lift(registered: DataFrame, violated: DataFrame) -> DataFrame:
    """Per industry and channel: registered and violated accounts, their percentages, and the lift.

    Both inputs are ``(industry, professional, shop, ad)``. Industries without
    registrations fall out; the lift is violated over registered percentage,
    null where either side is empty.
    """
    long = lambda df, n: df.select("industry", F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias(n)) for c in CHANNELS])).alias("_c")).select("industry", "_c.*")
    both = long(registered, "registered").join(long(violated, "violated"), ["industry", "channel"], "left").withColumn("violated", F.coalesce("violated", F.lit(0)))
    total = both.groupBy("industry").agg(F.sum("registered").alias("_r"), F.sum("violated").alias("_v"))
    pct = lambda part, whole: F.when(F.col(whole) > 0, 100 * F.col(part) / F.col(whole)).otherwise(0.0)
    lift = F.when((F.col("registered") > 0) & (F.col("_v") > 0), pct("violated", "_v") / pct("registered", "_r"))
    out = both.join(total, "industry")
    return out.select("industry", "channel", "registered", "violated", F.round(pct("registered", "_r"), 1).alias("registered_pct"), F.round(pct("violated", "_v"), 1).alias("violated_pct"), F.round(lift, 2).alias("lift"))


def channel_shares(split: DataFrame) -> DataFrame:
    """``(channel, accounts, percent)`` over all: the overall row of :func:`.reports.source_split`, or the sum of the others without one."""
    total = F.col("professional") + F.col("shop") + F.col("ad")
    own = split.where(total > 0)
    picked = lambda c: F.coalesce(F.sum(F.when(F.col("is_overall"), F.col(c))), F.sum(c), F.lit(0)).alias(c)
    one = own.agg(*[picked(c) for c in CHANNELS])
    out = one.select((F.col("professional") + F.col("shop") + F.col("ad")).alias("_t"), F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("accounts")) for c in CHANNELS])).alias("_c"))
    return out.select("_c.channel", "_c.accounts", N.share(100 * F.col("_c.accounts"), F.col("_t"), 1).alias("percent"))


def accuracy_rank(baseline: DataFrame) -> DataFrame:
    """Industries with annotated accounts by confirmed over annotated, best first, ``place`` from 0."""
    own = baseline.where("annotated > 0").select("industry", "annotated", "confirmed", F.round(100 * F.col("confirmed") / F.col("annotated"), 2).alias("rate"))
    return global_index(own, [F.desc("rate"), F.asc("industry")], "place")


def stacked_change(compared: DataFrame) -> DataFrame:
    """Bars of :func:`.reports.compare_weeks`: the part both weeks have, and what came on top; rows of two zeros fall out."""
    own = compared.where((F.col("current") > 0) | (F.col("previous") > 0))
    return own.withColumn("base", F.least("current", "previous")).withColumn("increase", F.greatest(F.col("current") - F.col("previous"), F.lit(0)))


def overall_change(compared: DataFrame) -> DataFrame:
    """One row: totals of both weeks, difference and percentage (null without a week before)."""
    out = compared.agg(F.coalesce(F.sum("current"), F.lit(0)).alias("current"), F.coalesce(F.sum("previous"), F.lit(0)).alias("previous")).withColumn("delta", F.col("current") - F.col("previous"))
    return out.withColumn("delta_pct", F.round(F.when(F.col("previous") != 0, 100 * F.col("delta") / F.col("previous")), 1))


def previous_of(weeks: DataFrame, current: str, order: str = "week") -> DataFrame:
    """The week before ``current``: the last one below it, or the last week of all where ``current`` is not among them."""
    known = weeks.agg(F.max(F.when(F.col(order) == current, True)).alias("k"), F.max(F.when(F.col(order) < current, F.col(order))).alias("before"), F.max(order).alias("last"))
    return known.select(F.when(F.col("k"), F.col("before")).otherwise(F.col("last")).alias(order)).where(F.col(order).isNotNull())


def recent(rows: DataFrame, order: list[str], n: int, without: str | None = None) -> DataFrame:
    """The last ``n`` rows by ``order``; ``without`` names a flag whose rows are left out."""
    own = rows if without is None else rows.where(~F.coalesce(F.col(without), F.lit(False)))
    return own.orderBy(*[F.desc(c) for c in order]).limit(n)


def last_weeks(metrics: DataFrame, n: int, week: str = "week") -> DataFrame:
    """Rows of the last ``n`` weeks, oldest first."""
    last = metrics.select(week).distinct().orderBy(F.desc(week)).limit(n)
    return metrics.join(F.broadcast(last), week, "left_semi").orderBy(week)


def overall_first(rows: DataFrame, total: str, overall: str = "is_overall", name: str = "industry") -> DataFrame:
    """Rows with ``place``: the overall one, then the others by total, largest first."""
    return global_index(rows, [F.desc(overall), F.desc(total), F.asc(name)], "place")


def nulls_last(rows: DataFrame, value: str, id_col: str) -> DataFrame:
    """Rows with ``place``: largest value first, absent ones last, then by id."""
    return global_index(rows, [F.desc_nulls_last(value), F.asc(id_col)], "place")


def run_order(runs: DataFrame) -> DataFrame:
    """Runs ``(tag, kind, created_at)`` with ``place``: uploads by time, newest first, then the others by tag downwards."""
    upload = F.col("kind") == "upload"
    return global_index(runs, [F.desc(upload), F.desc_nulls_last(F.when(upload, F.col("created_at"))), F.desc("tag")], "place")


def run_detail(tables: dict[str, DataFrame], run_id: object, order: dict[str, list[str]]) -> DataFrame:
    """One run in full: ``(list, place, row)`` with each list's rows as JSON in its fixed order."""
    parts = []
    for name, df in tables.items():
        own = df.where(F.col("run_id") == F.lit(run_id))
        placed = global_index(own, [F.asc(c) for c in order[name]], "_place")
        parts.append(placed.select(F.lit(name).alias("list"), F.col("_place").alias("place"), F.to_json(F.struct(*[c for c in df.columns if c != "run_id"])).alias("row")))
    return reduce(DataFrame.unionByName, parts)


def run_metrics(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Weeks' metrics of runs, joined: ``(run_id, week, sample_group, concentration)``."""
    return runs.select("run_id", "week").join(metrics.select("run_id", "sample_group", "concentration"), "run_id")
