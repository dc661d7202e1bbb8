"""Weekly measures: concentrations, distributions, comparisons and attribution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalise as N

PRIORITY = (N.CONFIRMED, N.SUSPECTED, N.CLEAN)


def counts_for(scope: str) -> tuple[str, ...]:
    """The labels of the numerator: ``confirmed``, ``suspected`` (both) or ``all`` (three labels)."""
    return {"confirmed": (N.CONFIRMED,), "suspected": (N.CONFIRMED, N.SUSPECTED), "all": (N.CONFIRMED, N.SUSPECTED, N.AFFILIATED)}[scope]


def extract_daily(settlement: DataFrame, governance: DataFrame, images: DataFrame) -> DataFrame:
    """Accounts in scope with their trade names and each image: one row an account and url."""
    scope = settlement.where("user_apply_type = 'initAudit' and certificate_type in (2, 4)")
    base = scope.groupBy("user_id").agg(F.max("pro_settle_date").alias("pro_settle_date"))
    trade = governance.groupBy("user_id").agg(F.max("first_trade_name").alias("trade_first_name"), F.max("second_trade_name").alias("trade_second_name"))
    one = images.where("embeds is not null and trim(embeds) <> ''").groupBy("user_id", "qualification_url").agg(F.max("embeds").alias("embeds"))
    return base.join(trade, "user_id", "left").join(one, "user_id")


def latest_registration(settlement: DataFrame) -> DataFrame:
    """The last registration in scope of each account, later applications first among equals."""
    scope = settlement.where("user_apply_type = 'initAudit' and certificate_type in (2, 4)")
    last = F.max_by(F.struct(*[c for c in settlement.columns if c != "user_id"]), F.struct("pro_settle_tms", "apply_id"))
    return scope.groupBy("user_id").agg(last.alias("_r")).select("user_id", "_r.*")


def registered_sources(settlement: DataFrame) -> DataFrame:
    """Distinct accounts by industry and source of their last registration."""
    last = latest_registration(settlement).withColumn("first_trade_name", N.industry(F.col("first_trade_name")))
    return last.groupBy("first_trade_name", "apply_source").agg(F.count_distinct("user_id").alias("uid_cnt"))


def source_split(counts: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """Per industry and over all: accounts by channel; with ``total (confirmed)`` those the channels miss."""
    bucket = N.source_bucket(F.col("apply_source"))
    sums = [F.sum(F.when(bucket == b, F.col("uid_cnt")).otherwise(0)).alias(b) for b in ("shop", "ad", "professional")]
    out = counts.rollup("first_trade_name").agg(F.grouping("first_trade_name").alias("_g"), *sums)
    out = out.select((F.col("_g") == 1).alias("is_overall"), F.when(F.col("_g") == 1, F.lit("overall")).otherwise(F.col("first_trade_name")).alias("industry"), "shop", "ad", "professional")
    if total is None:
        return out
    missing = F.greatest(F.col("confirmed") - F.col("shop") - F.col("ad") - F.col("professional"), F.lit(0))
    return out.crossJoin(F.broadcast(total.agg(F.sum("confirmed").alias("confirmed")))).withColumn("missing", F.when(F.col("is_overall"), missing).otherwise(0)).drop("confirmed")  # one row


def first_label(annotated: DataFrame) -> DataFrame:
    """One row an account: its gravest label (confirmed, suspected, clean, any other), earlier rows first."""
    rank = reduce(lambda c, kv: c.when(F.col("remark_first") == kv[1], kv[0]), enumerate(PRIORITY), F).otherwise(len(PRIORITY))
    row = F.struct(*[c for c in annotated.columns if c != "user_id"])
    return annotated.groupBy("user_id").agg(F.min_by(row, F.struct(rank.alias("p"), F.col("row_idx").alias("i"))).alias("_r")).select("user_id", "_r.*")


def _violates(scope: str) -> Column:
    return F.coalesce(F.col("remark_first").isin(*counts_for(scope)), F.lit(False))


def concentration_by_group(annotations: DataFrame) -> DataFrame:
    """Per group of a cell's groups: sampled accounts that are annotated, those in violation (three labels), and the share."""
    own = annotations.where(N.flag_words(F.col("is_sample_user"))).where(N.trimmed(F.col("annotation_result")).isNotNull())
    bad = F.coalesce(N.trimmed(F.col("annotation_result")).isin(*counts_for("all")), F.lit(False))
    each = own.select(N.uid(F.col("user_id")).alias("user_id"), F.explode(N.groups(F.col("sample_groups"))).alias("sample_group"), bad.alias("bad"))
    per_user = each.where("user_id is not null").groupBy("sample_group", "user_id").agg(F.bool_or("bad").alias("bad"))
    out = per_user.groupBy("sample_group").agg(F.count("*").alias("annotated"), F.count_if("bad").alias("violated"))
    return out.withColumn("concentration", N.share(F.col("violated"), F.col("annotated")))


def concentration_restored(samples: DataFrame, rows: DataFrame, annotated: DataFrame, scope: str = "confirmed") -> DataFrame:
    """Per group: labelled sample rows in ``scope`` over sample rows that the cluster table holds."""
    inside = rows.select("user_id").distinct().withColumn("in_cluster", F.lit(True))
    joined = samples.join(first_label(annotated).select("user_id", "remark_first"), "user_id", "left").join(inside, "user_id", "left")
    out = joined.groupBy("sample_group").agg(F.count_if("in_cluster").alias("denominator"), F.count_if(_violates(scope)).alias("numerator"))
    return out.withColumn("concentration", N.share(F.col("numerator"), F.col("denominator")))


def concentration_checked(samples: DataFrame, rows: DataFrame, annotated: DataFrame) -> DataFrame:
    """Per group: distinct sampled accounts of the table, those confirmed in a cluster, and the share."""
    present = samples.select("sample_group", "user_id").distinct().join(rows.select("user_id"), "user_id", "left_semi")
    bad = annotated.where("cluster_id <> -1").where(_violates("confirmed")).select("user_id").distinct().withColumn("bad", F.lit(True))
    out = present.join(bad, "user_id", "left").groupBy("sample_group").agg(F.count("*").alias("denominator"), F.count_if("bad").alias("numerator"))
    return out.withColumn("concentration", N.share(F.col("numerator"), F.col("denominator")))


def first_industry(rows: DataFrame) -> DataFrame:
    """The industries of each account's first row, blanks as unknown."""
    first = F.min_by(F.struct(N.industry(F.col("trade_first_name")).alias("industry1"), N.industry(F.col("trade_second_name")).alias("industry2")), "row_idx")
    return rows.groupBy("user_id").agg(first.alias("_i")).select("user_id", "_i.*")


def violation_distribution(samples: DataFrame, rows: DataFrame, annotated: DataFrame) -> DataFrame:
    """Sample entries of the table by both levels of industry (rollup): sampled, confirmed and only suspected."""
    label = annotated.groupBy("user_id").agg(F.coalesce(F.bool_or(F.col("remark_first") == N.CONFIRMED), F.lit(False)).alias("real"), F.coalesce(F.bool_or(F.col("remark_first") == N.SUSPECTED), F.lit(False)).alias("maybe"))
    joined = samples.select("user_id").join(first_industry(rows), "user_id").join(label, "user_id", "left")
    out = joined.rollup("industry1", "industry2").agg(
        (2 - F.grouping("industry1") - F.grouping("industry2")).cast("int").alias("level"),
        F.count("*").alias("sampled"),
        F.count_if("real").alias("confirmed"),
        F.count_if(F.col("maybe") & ~F.col("real")).alias("suspected"),
    )
    return out.select("level", "industry1", "industry2", "sampled", "confirmed", "suspected")


def industry_baseline(registered: DataFrame, rows: DataFrame, annotated: DataFrame) -> DataFrame:
    """Distinct accounts by industry: registered, clustered, annotated, confirmed, and the accuracy.

    Industries come from ``registered (user_id, first_trade_name)``; the cluster
    table fills gaps and adds accounts.
    """
    reg = registered.groupBy("user_id").agg(F.max(N.trimmed(F.col("first_trade_name"))).alias("reg"))
    table = rows.groupBy("user_id").agg(F.min_by(N.trimmed(F.col("trade_first_name")), "row_idx").alias("own"), F.bool_or(F.col("cluster_id") >= 0).alias("clustered"))
    labels = annotated.groupBy("user_id").agg(F.bool_or(N.trimmed(F.col("remark_first")).isNotNull()).alias("annotated"), F.bool_or(_violates("confirmed")).alias("confirmed"))
    flags = reg.join(table, "user_id", "full_outer").join(labels, "user_id", "left")
    out = flags.groupBy(F.coalesce("reg", "own", F.lit(N.UNKNOWN_INDUSTRY)).alias("industry")).agg(
        F.count("*").alias("registered"), F.count_if("clustered").alias("clustered"), F.count_if("annotated").alias("annotated"), F.count_if("confirmed").alias("confirmed")
    )
    return out.withColumn("accuracy", N.share(F.col("confirmed"), F.col("annotated")))


def pool_baseline(full: DataFrame, rows: DataFrame, suspects: DataFrame, pool: DataFrame, annotated: DataFrame, level: int = 1) -> DataFrame:
    """Distinct accounts by industry, of one or both levels: registered,
    clustered, in suspect clusters, in the pool and confirmed.

    Industries are those of an account's first row in ``full``; ``rows`` fills
    in accounts that it lacks. ``suspects`` holds the suspect ``cluster_id``s.
    """
    first = lambda df, p: df.groupBy("user_id").agg(F.min_by(F.struct(F.trim(F.coalesce("trade_first_name", F.lit(""))).alias("a"), F.trim(F.coalesce("trade_second_name", F.lit(""))).alias("b")), "row_idx").alias(p))
    inside = rows.where("cluster_id >= 0")
    marked = inside.join(suspects.select("cluster_id").distinct().withColumn("_s", F.lit(True)), "cluster_id", "left").groupBy("user_id").agg(F.lit(True).alias("c"), F.bool_or(F.coalesce("_s", F.lit(False))).alias("s"))
    flags = first(full, "f").join(first(inside, "t"), "user_id", "full_outer").join(marked, "user_id", "left")
    for df, name in ((pool.select("user_id"), "p"), (annotated.where(_violates("confirmed")).select("user_id"), "v")):
        flags = flags.join(df.distinct().withColumn(name, F.lit(True)), "user_id", "left")
    own = F.coalesce("f", "t")
    names = [F.coalesce(F.nullif(own[k], F.lit("")), F.lit(N.UNKNOWN_INDUSTRY)).alias(n) for k, n in (("a", "industry"), ("b", "industry2"))][:level]
    return flags.groupBy(*names).agg(F.count("*").alias("registered"), *[F.count_if(c).alias(n) for c, n in (("c", "clustered"), ("s", "suspected"), ("p", "annotated"), ("v", "confirmed"))])


def extract_window(settlement: DataFrame, governance: DataFrame, images: DataFrame, day: Column, days: int = 7) -> DataFrame:
    """Registrations of ``day`` and the days before it with all their trades and images.

    An account comes once for each of its days, trades and images: trades are
    not folded to one. ``is_target_user`` marks the day itself.
    """
    scope = settlement.where("user_apply_type = 'initAudit' and certificate_type in (2, 4)").where(F.col("pro_settle_date").between(F.date_sub(day, days - 1), day))
    target = F.col("pro_settle_date") == day
    base = scope.select("user_id", "pro_settle_date", target.alias("is_target_user"), F.when(target, "target_day").otherwise("history_7d").alias("source_window")).distinct()
    trade = governance.select("user_id", F.col("first_trade_name").alias("trade_first_name"), F.col("second_trade_name").alias("trade_second_name")).distinct()
    one = images.where("qualification_url is not null and qualification_url <> ''").groupBy("user_id", "qualification_url").agg(F.max("embeds").alias("embeds")).where("embeds <> ''")
    return base.join(trade, "user_id", "left").join(one, "user_id")


def daily_windows(settlement: DataFrame, days: int = 7) -> DataFrame:
    """One window a day: ``(day, registrations, accounts, target_accounts)`` of the day and the days before it.

    Each registration is counted once for each window that it lies in.
    """
    own = settlement.select("user_id", "pro_settle_date").where("pro_settle_date is not null")
    days_held = own.select(F.col("pro_settle_date").alias("day")).distinct()
    spread = own.select("user_id", "pro_settle_date", F.explode(F.sequence(F.col("pro_settle_date"), F.date_add("pro_settle_date", days - 1))).alias("day")).join(days_held, "day", "left_semi")
    target = F.when(F.col("pro_settle_date") == F.col("day"), F.col("user_id"))
    return spread.groupBy("day").agg(F.count("*").alias("registrations"), F.count_distinct("user_id").alias("accounts"), F.count_distinct(target).alias("target_accounts"))


def auth_methods(registered: DataFrame, organisation: DataFrame, annotated: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Registered and confirmed accounts by industry and authentication method; those without a method fall out."""
    method = organisation.groupBy("user_id").agg(F.max("authentication_type").alias("t"))
    base = registered.groupBy("user_id").agg(F.max(N.industry(F.col("first_trade_name"))).alias("industry"))
    bad = annotated.where(_violates("confirmed")).groupBy("user_id").agg(F.min_by(N.industry(F.col("trade_first_name")), "row_idx").alias("industry"))
    by = lambda df, n: df.join(method, "user_id", "left").groupBy("industry", N.auth_method(F.col("t"), names).alias("method")).agg(F.count("*").alias(n))
    both = by(base, "registered").join(by(bad, "confirmed"), ["industry", "method"], "full_outer")
    return both.where(F.col("method") != N.MISSING_AUTH).select("industry", "method", F.coalesce("registered", F.lit(0)).alias("registered"), F.coalesce("confirmed", F.lit(0)).alias("confirmed"))


def shares(rows: DataFrame, key: str, values: list[str], digits: int = 4) -> DataFrame:
    """``key`` with each value and its share of the value's total; totals are one row, not a window."""
    total = rows.agg(*[F.sum(v).alias(f"_{v}") for v in values])
    out = rows.crossJoin(F.broadcast(total))  # one row
    return out.select(key, *values, *[N.share(F.col(v), F.col(f"_{v}"), digits).alias(f"{v}_share") for v in values])


def compare_weeks(current: DataFrame, previous: DataFrame, key: str, value: str) -> DataFrame:
    """Values of two weeks, absent ones as zero: difference, and its part of the former (null if that is zero)."""
    both = current.select(key, F.col(value).alias("current")).join(previous.select(key, F.col(value).alias("previous")), key, "full_outer")
    filled = both.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("current", "previous")])
    delta = F.col("current") - F.col("previous")
    return filled.select(key, "current", "previous", delta.alias("delta"), F.round(F.when(F.col("previous") != 0, delta / F.col("previous")), 4).alias("delta_share"))


def concentration_moves(weeks: DataFrame, week: str, before: str, least: float = 0.0001) -> DataFrame:
    """Industries of both weeks whose share of violations moved by ``least`` or more, the largest moves first."""
    share = F.col("violated") / F.nullif(F.col("sampled"), F.lit(0))
    a, b = (weeks.where(F.col("week") == w).select("industry", F.coalesce(share, F.lit(0.0)).alias(n)) for w, n in ((week, "current"), (before, "previous")))
    moved = a.join(b, "industry").withColumn("delta", F.col("current") - F.col("previous")).where(F.abs("delta") >= least)
    return moved.select("industry", *[F.round(c, 6).alias(c) for c in ("current", "previous", "delta")]).orderBy(F.desc(F.abs("delta")), "industry")


def trend(metrics: DataFrame, groups: dict[str, str], weeks: int = 12) -> DataFrame:
    """The last ``weeks`` weeks, one column of percentages for each group (null where absent)."""
    named = metrics.withColumn("g", F.create_map(*[F.lit(x) for kv in groups.items() for x in kv])[F.regexp_replace("sample_group", r"(_sample|_v[0-9]+)+$", "")])
    table = named.where("g is not null").groupBy("week").pivot("g", list(groups.values())).agg(F.round(F.max("concentration") * 100, 2))
    return table.orderBy(F.desc("week")).limit(weeks).orderBy("week")


def history_by_day(rows: DataFrame) -> DataFrame:
    """Per day and industry: target accounts, and those whose clusters of two accounts or more hold a row of the days before."""
    pairs = rows.where("cluster_id >= 0")
    mixed = pairs.groupBy("day", "cluster_id").agg(F.count_distinct("user_id").alias("u"), F.bool_or(~F.col("is_target_user")).alias("h")).where("u > 1")
    target = pairs.where("is_target_user").join(mixed, ["day", "cluster_id"])
    users = target.groupBy("day", "user_id").agg(F.min_by(N.industry(F.col("trade_first_name")), "row_idx").alias("industry"), F.bool_or("h").alias("with_history"))
    return users.groupBy("day", "industry").agg(F.count("*").alias("accounts"), F.count_if("with_history").alias("with_history"))


def history_summary(days: DataFrame, small: float = 10.0, other: str = "other") -> DataFrame:
    """Per industry over all days: pooled percentage, mean, least and largest daily one, and accounts a day.

    Industries of fewer than ``small`` accounts a day become one row, with
    percentages from its pooled counts.
    """
    n_days = days.agg(F.count_distinct("day").alias("_d"))
    per = days.groupBy("industry").agg(F.sum("accounts").alias("_n"))
    keyed = per.crossJoin(F.broadcast(n_days)).select("industry", F.when(F.col("_n") / F.col("_d") < small, other).otherwise(F.col("industry")).alias("_k"))
    daily = days.join(keyed, "industry").groupBy("_k", "day").agg(F.sum("accounts").alias("a"), F.sum("with_history").alias("h"))
    pct = F.when(F.col("a") > 0, 100 * F.col("h") / F.col("a"))
    out = daily.groupBy(F.col("_k").alias("industry")).agg(
        F.sum("a").alias("accounts"), F.sum("h").alias("with_history"), F.round(100 * F.sum("h") / F.nullif(F.sum("a"), F.lit(0)), 1).alias("pooled_pct"), F.round(F.avg(pct), 1).alias("mean_pct"),
        F.round(F.min(pct), 1).alias("min_pct"), F.round(F.max(pct), 1).alias("max_pct"), F.count("*").alias("days"),
    )
    return out.withColumn("per_day", F.round(F.col("accounts") / F.col("days"), 1))


def fold_audits(records: DataFrame) -> DataFrame:
    """One row an audit (account, order, time): sorted actions and tags, and the last list of pairs that isn't empty."""
    pairs = F.from_json("pairs_json", "array<struct<query_img_url string, sim_img_url string, pixel_similarity double, cosine_similarity double, type_name string>>")
    own = records.withColumn("_p", pairs)
    return own.groupBy("user_id", "order_id", "audit_ms").agg(
        F.array_sort(F.collect_set("action")).alias("actions"), F.array_sort(F.collect_set("tag")).alias("tags"), F.max_by("_p", F.when(F.size("_p") > 0, F.col("seq"))).alias("pairs")
    )


def attribute_misses(confirmed: DataFrame, audited: DataFrame) -> DataFrame:
    """Per confirmed account: its images, those audits compared, how many agree, and ``nofactor``, ``same`` or ``diff``.

    Both inputs are ``(user_id, url)``. Sets meet in a join on account and url,
    so an account of any number of images is never one row.
    """
    mine = confirmed.select("user_id", F.col("qualification_url").alias("url")).distinct().withColumn("_m", F.lit(1))
    seen = audited.select("user_id", "url").distinct().join(mine.select("user_id"), "user_id", "left_semi").withColumn("_a", F.lit(1))
    both = mine.join(seen, ["user_id", "url"], "full_outer").groupBy("user_id").agg(F.count("_m").alias("n_fake"), F.count("_a").alias("n_audited"), F.count_if(F.col("_m").isNotNull() & F.col("_a").isNotNull()).alias("n_same"))
    return both.withColumn("match", F.when(F.col("n_audited") == 0, "nofactor").when(F.col("n_same") > 0, "same").otherwise("diff"))


def attribute_rows(confirmed: DataFrame, audits: DataFrame) -> DataFrame:
    """Each row of ``confirmed`` with its account's figures of :func:`attribute_misses` and ``n_orders``, its audits.

    ``audits`` has a row an audit, as :func:`fold_audits` gives it: ``pairs``
    may be null or empty. Rows without an account have no audits.
    """
    urls = audits.select("user_id", F.explode("pairs").alias("p")).select("user_id", F.col("p.query_img_url").alias("url")).where("url is not null")
    orders = audits.groupBy("user_id").agg(F.count("*").alias("n_orders"))
    figures = attribute_misses(confirmed.where("user_id is not null"), urls).join(orders, "user_id", "left")
    own = confirmed.join(figures, "user_id", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_fake", "n_audited", "n_same", "n_orders")}
    return own.withColumns(zero | {"match": F.coalesce("match", F.lit("nofactor"))})


def prev_value(metrics: DataFrame, partition: str, order: str, value: str) -> DataFrame:
    """Each week's value with the one before it, the change, and whether it is flat (under 0.005)."""
    w = Window.partitionBy(partition).orderBy(order)
    out = metrics.withColumn("previous", F.lag(value).over(w)).withColumn("delta", F.col(value) - F.col("previous"))
    return out.withColumn("is_flat", F.abs("delta") < 0.005)
