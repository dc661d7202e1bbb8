"""Text cells to ids, booleans, cluster ids, labels and buckets, as Column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label vocabulary, shown names and default words of the data model.
CONFIRMED, SUSPECTED, AFFILIATED, CLEAN = "实锤造假", "疑似造假", "资质挂靠", "不违规"
UNKNOWN_INDUSTRY, MISSING_AUTH = "未知", "未取到"
VIOLATION, PASSED = "违规", "通过"
TRUE_WORDS = ("1", "true", "t", "yes", "y", "是")

BLANKS = r"^[\s　]+|[\s　]+$"


def trimmed(c: Column) -> Column:
    """The text without outer blanks; null where nothing is left."""
    return F.nullif(F.regexp_replace(c.cast("string"), BLANKS, ""), F.lit(""))


def uid(c: Column) -> Column:
    """An id as trimmed text; a blank one is null."""
    return trimmed(c)


def number(c: Column) -> Column:
    """A number; what is not one (NaN) is null."""
    return F.when(~F.isnan(c), c)


def flag_words(c: Column) -> Column:
    """True for any of the accepted words, in any case; false for all else, nulls included."""
    return F.coalesce(F.lower(trimmed(c)).isin(*TRUE_WORDS), F.lit(False))


def flag_short(c: Column) -> Column:
    """True for ``true`` or ``1`` in any case."""
    return F.coalesce(F.lower(trimmed(c)).isin("true", "1"), F.lit(False))


def flag_exact(c: Column) -> Column:
    """True for the literal ``True`` only."""
    return F.coalesce(c.cast("string") == "True", F.lit(False))


def cluster_id(c: Column) -> Column:
    """A cluster id from text; what is no whole number is -1."""
    text = trimmed(c)
    return F.when(text.rlike(r"^[+-]?[0-9]{1,9}(\.0*)?$"), text.cast("double").cast("int")).otherwise(F.lit(-1))


def cluster_id_strict(c: Column) -> Column:
    """A cluster id from text; anything else ends the query."""
    text = trimmed(c)
    return F.when(text.rlike(r"^[+-]?[0-9]{1,9}$"), text.cast("int")).otherwise(F.raise_error(F.concat(F.lit("not a cluster id: "), F.coalesce(c.cast("string"), F.lit("null")))).cast("int"))


def industry(c: Column) -> Column:
    return F.coalesce(trimmed(c), F.lit(UNKNOWN_INDUSTRY))


def auth_method(c: Column, names: dict[str, str] | None = None) -> Column:
    """The shown name of an authentication type; absent ones are marked."""
    shown = trimmed(c)
    if names:
        shown = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[shown], shown)
    return F.coalesce(shown, F.lit(MISSING_AUTH))


def source_bucket(c: Column) -> Column:
    """Three channels: shops, advertising and, for all the rest, professional."""
    return F.when(c == "SELLER_PASS", "shop").when(c == "AD_PASS", "ad").otherwise("professional")


def image_label(cluster_remark: Column, item_label: Column, verdict: Column | None = None) -> Column:
    """The label of one image: the reviewer's verdict, the image's own label, the cluster's remark, then violation."""
    own = F.when(trimmed(item_label).isNotNull() | F.coalesce(cluster_remark == CLEAN, F.lit(False)), F.lit(PASSED)).otherwise(F.lit(VIOLATION))
    if verdict is None:
        return own
    return F.when(verdict == CLEAN, F.lit(PASSED)).when(F.coalesce(verdict, F.lit("")) != "", F.lit(VIOLATION)).otherwise(own)


def host_allowed(url: Column, hosts: list[str]) -> Column:
    """http(s) urls whose host is one of ``hosts`` or below one."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    inside = [(host == h.lower()) | host.endswith("." + h.lower()) for h in hosts]
    ok = F.lit(False)
    for x in inside:
        ok = ok | x
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https") & ok, F.lit(False))


def file_name(date: Column, tag: Column, cluster: Column, user: Column, seq: Column) -> Column:
    """``date_tag_cluster_user6_seq``; the cluster without the tag before it."""
    own = F.when(cluster.startswith(F.concat(tag, F.lit("-"))), cluster.substr(F.length(tag) + 2, F.length(cluster))).otherwise(cluster)
    return F.concat_ws("_", date, tag, own, F.right(user, F.lit(6)), F.lpad(seq.cast("string"), 3, "0"))


def groups(c: Column) -> Column:
    """The distinct group names of a cell, divided by any of ``| , ; /``."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[|,;/]"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def retry_name(c: Column, suffix: str = "-retry") -> Column:
    """A task name with one retry suffix, however many it had."""
    return F.concat(F.regexp_replace(c, f"(?:{suffix})+$", ""), F.lit(suffix))


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole``, rounded half up; zero where there is no whole."""
    return F.coalesce(F.round(F.when(whole > 0, part / whole), digits), F.lit(0.0))


def hmac_sha256(key: bytes, message: Column) -> Column:
    """The keyed digest of a text or bytes, in lower-case hex; null for null."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)
