"""Exact copies by progressive refinement: lengths, then hashes of prefixes, then hashes of whole texts.

Texts are equal when they are identical after each run of white space has
become one space. Each step looks only at what the one before left open: a
length that one text alone has needs no hash, a prefix that one text alone has
needs no hash of the whole. Texts are read where they lie and never shuffled;
what is shuffled are counts by length, by length and prefix, and by digest.

The open keys of a step are broadcast if there are at most ``_KEYS`` of them
(16 bytes each); beyond that all rows stay open, which costs hashes but changes
no result.

Edge cases: null text is empty text, and empty texts are copies of each other;
of rows with equal texts the one with the smallest id stays, nulls last; of
those that share this id as well, one; ``keep_id`` is null where no row of the
group has an id; an empty table stays empty; other columns play no part,
whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from .grouping import with_groups

SPACE = r"[\x20\x09-\x0D]+"
#: Code points of a text that its prefix hash looks at.
PREFIX = 256
_KEYS = 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _open_keys(rows: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, bool]:
    """Keys of two rows or more, as a table, and whether they are few enough to be broadcast."""
    found = materialize(rows.groupBy(*keys).agg(F.count("*").alias("_c")).where("_c > 1").select(*keys), name)
    return found, found.count() <= _KEYS


def _survivors(rows: DataFrame, found: tuple[DataFrame, bool], keys: list[str]) -> DataFrame:
    """``rows`` with ``_open``: whether their key is an open one."""
    table, few = found
    if not few:
        return rows.withColumn("_open", F.lit(True))
    marked = F.broadcast(table.withColumn("_m", F.lit(True)))
    return rows.join(marked, keys, "left").withColumn("_open", F.col("_m").isNotNull()).drop("_m")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every_digest: bool = False, prefix: int = PREFIX) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, digest)``, one row for each of ``docs``.

    ``digest`` is the hash of the whole normalised text (64 hex digits), null
    for a text that its length or prefix tells apart from all others;
    ``every_digest`` asks for those too.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(F.col(f"`{text_col}`")).alias("_x"))
    sized = own.withColumn("_len", F.char_length("_x"))
    lengths = _open_keys(sized.select("_len"), ["_len"], "open-lengths")
    begun = _survivors(sized, lengths, ["_len"]).withColumn("_pre", F.when(F.col("_open"), F.xxhash64(F.substring("_x", 1, prefix)))).drop("_open")
    prefixes = _open_keys(begun.where("_pre is not null").select("_len", "_pre"), ["_len", "_pre"], "open-prefixes")
    whole = _survivors(begun, prefixes, ["_len", "_pre"])
    asked = F.lit(True) if every_digest else F.col("_open")
    rows = materialize(whole.select("doc_id", "_open", F.when(asked, F.sha2("_x", 256)).alias("digest"), F.monotonically_increasing_id().alias("_row")), "digests", consumed=(lengths[0], prefixes[0]))

    alone = rows.where(~F.col("_open")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    held = rows.where("_open")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_row"))
    groups = materialize(held.groupBy("digest").agg(F.count("*").alias("n"), first.alias("_first")).select("digest", "n", F.col("_first.doc_id").alias("keep_id"), F.col("_first._row").alias("_keep_row")), "copies")
    found = with_groups(held, groups, "digest").select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("_row") == F.col("_keep_row")).alias("kept"), "digest")
    return alone.unionByName(found)
