"""What must hold for an expansion, a week's figures, an extract and its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..plans.ordering import global_index
from .reports import concentration_checked
from .sampling import expand_clusters

#: Fixed value: concentrations are the same up to this.
_SAME = 1e-4


def _count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _joined(*one_row: DataFrame) -> DataFrame:
    """Tables of one row each, side by side."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), one_row)


def _listed(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """``(code, ok, detail)`` from one-row tables with a ``detail`` that should be zero."""
    found = [df.select(F.lit(code).alias("code"), (F.col("detail") == 0).alias("ok"), F.col("detail").cast("long").alias("detail")) for code, df in parts]
    return reduce(DataFrame.unionByName, found)


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """``detail``: the difference of the counts of two tables."""
    return _joined(_count(a, "a"), _count(b, "b")).select(F.abs(F.col("a") - F.col("b")).alias("detail"))


def expansion_checks(rows: DataFrame, samples: DataFrame, expanded: DataFrame, ordered: DataFrame | None = None, keep_solo: bool = False) -> DataFrame:
    """``(code, ok, detail)`` of the ten checks of an expansion of ``rows`` by ``samples``.

    ``ordered`` is the written table with its ``place``, from which A8 takes
    the order of rows; without it A8 looks at the canonical order itself.
    ``detail`` counts what is wrong. A cluster counts as hit if a sampled
    account lies in it and it is not dropped for having a single account once
    each account and url has gone to its first cluster; A10 names those that
    have several accounts in the whole table.
    """
    sampled = samples.select(F.trim("user_id").alias("user_id")).where("user_id <> ''").distinct()
    flagged = rows.join(sampled.withColumn("_s", F.lit(True)), "user_id", "left")
    matched = sampled.join(rows.select("user_id"), "user_id", "left_semi")
    absent = sampled.join(rows.select("user_id"), "user_id", "left_anti")
    hit_any = flagged.where("_s and cluster_id >= 0").select("cluster_id").distinct()
    inside = expanded.where("cluster_id >= 0")
    in_file = inside.select("cluster_id").distinct()
    accounts = lambda df: df.where("cluster_id >= 0").groupBy("cluster_id").agg(F.min("user_id").alias("_a"), F.max("user_id").alias("_b"))
    solo = accounts(expand_clusters(rows, samples, keep_solo=True)).where("_a = _b").select("cluster_id")
    hit = hit_any if keep_solo else hit_any.join(solo, "cluster_id", "left_anti")
    hit_rows = rows.join(hit, "cluster_id", "left_semi")
    of = lambda flag: expanded.where(F.col("is_sample_user") == flag).select("user_id").distinct()
    found, others = of(True), of(False)
    keys = ["user_id", "qualification_url"]
    detail = lambda df: _count(df, "detail")
    placed = ordered if ordered is not None else global_index(expanded, [F.asc(F.col("cluster_id") < 0), F.asc("cluster_id"), F.asc("user_id"), F.asc("qualification_url")], "place")
    key = F.struct((F.col("cluster_id") < 0).alias("o"), F.when(F.col("cluster_id") >= 0, F.col("cluster_id")).otherwise(0).alias("c"), F.col("user_id"), F.col("qualification_url"))
    here, after = placed.select("place", key.alias("k")), placed.select((F.col("place") - 1).alias("place"), key.alias("later"))
    left = accounts(inside).where("_a = _b")
    parts = [
        ("A1_clusters_are_those_hit", _differ(in_file, hit)),
        ("A2_samples_are_those_matched", _differ(found, matched)),
        ("A3_matched_and_absent_are_all", _joined(_count(matched, "m"), _count(absent, "a"), _count(sampled, "s")).select(F.abs(F.col("m") + F.col("a") - F.col("s")).alias("detail"))),
        ("A4_no_sample_as_expanded", detail(found.join(others, "user_id", "left_semi"))),
        ("A5_rows_once", expanded.groupBy(*keys).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("detail"))),
        ("A6_no_account_missing", detail(hit_rows.select("user_id").distinct().join(expanded.select("user_id"), "user_id", "left_anti"))),
        ("A7_no_row_missing", detail(hit_rows.select(*keys).distinct().join(expanded.select(*keys), keys, "left_anti"))),
        ("A8_canonical_order", detail(here.join(after, "place").where("k > later"))),
        ("A9_no_single_account", detail(left.where(F.lit(not keep_solo)))),
        ("A10_only_single_accounts_dropped", detail(solo.where(F.lit(not keep_solo)).join(accounts(rows).where("_a <> _b"), "cluster_id", "left_semi"))),
    ]
    return _listed(parts)


def _level(fail: Column, warn: Column | None = None) -> Column:
    out = F.when(fail, "FAIL")
    return (out if warn is None else out.when(warn, "WARN")).otherwise("PASS")


def weekly_checks(samples: DataFrame, rows: DataFrame, annotated: DataFrame, pool: DataFrame, board: dict[str, DataFrame], previous: DataFrame | None = None, overall: str = "overall", drift: float = 0.10) -> DataFrame:
    """``(code, level, detail)`` of a week: ``FAIL``, ``WARN`` or ``PASS``, and what was counted.

    ``annotated`` is the labelled table of the pool (``image_label``,
    ``remark_first``), ``pool`` what was uploaded. ``board`` holds what was
    reported: ``metrics (sample_group, concentration)``, ``sample`` and
    ``violation`` distributions at both levels (``count``, ``violated_count``;
    ``_l2`` for the second), ``baseline`` and ``baseline_l2`` (``clustered``,
    ``annotated``, ``confirmed``) and ``cert`` (``industry``, ``registered``,
    ``confirmed``). ``previous`` is the baseline of the week before.
    """
    out: list[DataFrame] = []

    def put(code: str, df: DataFrame, level: Column, detail: Column) -> None:
        out.append(df.select(F.lit(code).alias("code"), level.alias("level"), F.coalesce(detail.cast("double"), F.lit(0.0)).alias("detail")))

    real = annotated.where("cluster_id <> -1")
    c1 = real.agg(F.count_distinct("image_label").alias("labels"), F.count(N.trimmed(F.col("remark_first"))).alias("remarks"))
    put("C1_labelled_by_hand", c1, _level((F.col("labels") <= 1) | (F.col("remarks") == 0)), F.col("labels"))

    accounts = lambda df: df.select("user_id").distinct()
    apart = accounts(pool).withColumn("p", F.lit(1)).join(accounts(annotated).withColumn("a", F.lit(1)), "user_id", "full_outer").where("p is null or a is null")
    c2 = _joined(_count(pool, "p"), _count(annotated, "a"), _count(apart, "d"))
    put("C2_pool_is_result", c2, _level((F.col("p") != F.col("a")) | (F.col("d") > 0)), F.abs(F.col("p") - F.col("a")) + F.col("d"))

    again = concentration_checked(samples, rows, annotated)
    held = again.join(board["metrics"].select("sample_group", F.col("concentration").alias("b")), "sample_group", "left")
    c3 = _count(held.where(F.coalesce(F.abs(F.col("b") - F.col("concentration")) > _SAME, F.lit(True))))
    put("C3_recomputed", c3, _level(F.col("n") > 0), F.col("n"))

    whole = again.where(F.col("sample_group") == overall).agg(F.coalesce(F.max("denominator"), F.lit(0)).alias("d"), F.coalesce(F.max("numerator"), F.lit(0)).alias("n"))
    for table, column, side in (("sample", "count", "d"), ("violation", "violated_count", "n"), ("sample_l2", "count", "d"), ("violation_l2", "violated_count", "n")):
        c4 = _joined(board[table].agg(F.coalesce(F.sum(column), F.lit(0)).alias("got")), whole)
        put(f"C4_{table}_total", c4, _level(F.col("got") != F.col(side)), F.abs(F.col("got") - F.col(side)))

    for table in ("baseline", "baseline_l2"):
        c5 = _count(board[table].where("annotated > clustered"))
        put(f"C5_{table}_subset", c5, _level(F.col("n") > 0), F.col("n"))

    sums = board["baseline"].agg(F.coalesce(F.sum("annotated"), F.lit(0)).alias("ann"), F.coalesce(F.sum("confirmed"), F.lit(0)).alias("cfm"))
    c6 = _joined(_count(accounts(pool), "everyone"), _count(accounts(pool.where("cluster_id <> -1")), "inside"), sums)
    mixed = (F.col("everyone") > F.col("inside")) & (F.col("ann") == F.col("everyone"))
    put("C6_annotated_in_clusters", c6, _level(mixed, F.col("ann") != F.col("inside")), F.abs(F.col("ann") - F.col("inside")))

    if previous is not None:
        c7 = _joined(sums, previous.agg(F.coalesce(F.sum("annotated"), F.lit(0)).alias("pa"), F.coalesce(F.sum("confirmed"), F.lit(0)).alias("pc")))
        moved = F.abs(F.col("cfm") / F.nullif(F.col("ann"), F.lit(0)) - F.col("pc") / F.nullif(F.col("pa"), F.lit(0)))
        put("C7_accuracy_drift", c7, _level(F.lit(False), F.coalesce(moved > drift, F.lit(True))), F.round(moved, 4))

    cert = board["cert"]
    c8 = cert.agg(F.count("*").alias("rows"), F.count_if((F.coalesce("registered", F.lit(0)) == 0) & (F.col("confirmed") > 0)).alias("ghosts"))
    put("C8a_no_ghost_rows", c8, _level(F.col("ghosts") > 0, F.col("rows") == 0), F.col("ghosts"))
    c8 = _joined(_count(cert.groupBy("industry").agg(F.sum("registered").alias("r"), F.sum("confirmed").alias("v")).where("v > r"), "over"), _count(cert, "rows"))
    put("C8b_numerator_within", c8, _level(F.col("over") > 0, F.col("rows") == 0), F.col("over"))
    return reduce(DataFrame.unionByName, out)


def auth_checks(registered: DataFrame, confirmed: DataFrame, expected: int | Column, most_missing: float = 0.05) -> DataFrame:
    """``(code, level, detail)`` of an authentication report before it goes out.

    Both inputs are ``(method, n)``, with the mark of absent methods in. The
    numerator must have no absent method, no method that the denominator lacks,
    and ``expected`` accounts in all; a denominator with more absent ones than
    ``most_missing`` is a warning.
    """
    absent = F.col("method") == N.MISSING_AUTH
    total = lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.coalesce(F.sum(F.when(absent, F.col("n"))), F.lit(0)).alias("absent"))
    own = expected if isinstance(expected, Column) else F.lit(expected)
    ghosts = _count(confirmed.where("n > 0").join(registered.where("n > 0"), "method", "left_anti"))
    share = F.col("absent") / F.nullif(F.col("all"), F.lit(0))
    parts = [
        ("K1_numerator_has_methods", total(confirmed), _level(F.col("absent") > 0), F.col("absent")),
        ("K2_no_ghost_methods", ghosts, _level(F.col("n") > 0), F.col("n")),
        ("K3_numerator_complete", total(confirmed), _level(F.col("all") != own), F.abs(F.col("all") - own)),
        ("K4_denominator_has_methods", total(registered), _level(F.lit(False), F.coalesce(share > most_missing, F.lit(False))), F.round(share, 4)),
    ]
    return reduce(DataFrame.unionByName, [df.select(F.lit(c).alias("code"), level.alias("level"), F.coalesce(d.cast("double"), F.lit(0.0)).alias("detail")) for c, df, level, d in parts])


def sql_date_faults(queries: DataFrame, text: str = "sql", day: str = "biz_date") -> DataFrame:
    """Every date in SQL text that is not the business day: rows with ``kind`` and the ``found`` value.

    ``pro_settle_date = '...'`` has to be the day itself, ``dtm = '...'`` the day without dashes.
    """
    found = lambda pattern, kind: F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("found")))
    every = F.concat(found(r"pro_settle_date\s*=\s*'([0-9-]+)'", "pro_settle_date"), found(r"dtm\s*=\s*'([0-9]+)'", "dtm"))
    right = F.when(F.col("_d.kind") == "dtm", F.replace(day, F.lit("-"), F.lit(""))).otherwise(F.col(day))
    return queries.withColumn("_d", F.explode(every)).where(F.col("_d.found") != right).select(*queries.columns, "_d.kind", "_d.found")


def same_accounts(today: DataFrame, before: DataFrame) -> DataFrame:
    """One row: distinct accounts of both days, those in both, and ``repeated`` where the sets are equal and not empty."""
    own = lambda df, c: df.where(F.coalesce("user_id", F.lit("")) != "").select("user_id").distinct().withColumn(c, F.lit(1))
    both = own(today, "t").join(own(before, "b"), "user_id", "full_outer")
    out = both.agg(F.count("t").alias("today"), F.count("b").alias("before"), F.count_if(F.col("t").isNotNull() & F.col("b").isNotNull()).alias("overlap"))
    return out.withColumn("repeated", (F.col("before") > 0) & (F.col("overlap") == F.col("before")) & (F.col("overlap") == F.col("today")))


def download_guard(fetched: DataFrame, least_new: int = 50, least_ok: float = 0.9, stop_at: float = 0.5, warn_at: float = 0.1) -> DataFrame:
    """One row over ``fetched (cached, ok)``: counts, the failure rate of new downloads, and ``stop``, ``warn`` or ``pass``.

    The rate counts only with ``least_new`` new downloads or where fewer than
    ``least_ok`` of all images are there.
    """
    new = ~F.col("cached")
    out = fetched.agg(F.count("*").alias("needed"), F.count_if("cached").alias("hits"), F.count_if(new).alias("new"), F.count_if(new & ~F.col("ok")).alias("failed"))
    rate = F.when(F.col("new") > 0, F.col("failed") / F.col("new")).otherwise(0.0)
    there = F.when(F.col("needed") > 0, (F.col("needed") - F.col("failed")) / F.col("needed")).otherwise(1.0)
    counts = (F.col("new") >= least_new) | (there < least_ok)
    return out.withColumn("fail_rate", F.round(rate, 4)).withColumn("verdict", F.when(counts & (rate >= stop_at), "stop").when(counts & (rate >= warn_at), "warn").otherwise("pass"))


def require_downloads(fetched: DataFrame) -> None:
    """Raise where :func:`download_guard` says stop."""
    found = download_guard(fetched).first()
    if found["verdict"] == "stop":
        raise RuntimeError(f"{found['failed']} of {found['new']} new downloads failed")
