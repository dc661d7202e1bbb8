"""How filters interact: every order of five filters, from one histogram of failure masks.

A document's failures are five bits, made by native expressions. Copies are
found by a ``groupBy`` over digests of texts, which gives the smallest id.
Then each part (language) is at most 32 cells of counts, and every order of the
filters, every step in it and every share follows from the cells alone, so the
work over documents doesn't grow with the orders.

Edge cases: null text is empty text, with no words (A fails, B and C do not);
a null part is the empty string, with the parts named so; a row without an id
has no smaller one and is no copy of another, nor are rows that share both id
and text; repeated rows count each; a document with several labels is good or
toxic if any label says so, and one without is neither; an empty table has no
parts and gives no row; columns that are not asked for play no part.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.let import let
from ..plans.materialize import materialize
from .grouping import with_groups

WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at one text: A few words, B few distinct ones, C many capitals, D symbols."""
    size = F.char_length(text)
    capitals = size - F.char_length(F.translate(text, CAPITALS, ""))
    bit = lambda failed, at: F.when(failed, F.lit(1 << at)).otherwise(F.lit(0))
    of_words = lambda n: bit(n["all"] < 200, 0) + bit(100 * n["kinds"] < 50 * n["all"], 1)
    counted = let(F.regexp_extract_all(text, F.lit(WORD), 0), lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("kinds")))
    return let(counted, of_words) + bit(100 * capitals > 3 * size, 2) + bit(text.rlike("[#$%&*|]"), 3)


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(doc_id, part, mask)``, one row for each of ``docs``; texts are read once and not shuffled."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"), text_mask(text).alias("own"), F.sha2(text, 256).alias("digest"))
    rows = materialize(rows, "masks")
    groups = materialize(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "texts")
    copied = F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))
    return with_groups(rows, groups, "digest").select("doc_id", "part", (F.col("own") + F.when(copied, F.lit(16)).otherwise(F.lit(0))).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(part, mask, n, good, toxic)``: at most 32 rows a part."""
    known = labels.where(f"{id_col} is not null").groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0))).alias("toxic"))
    own = masked.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))  # rows without an id, or of one id, are few from here on
    joined = own.join(known, "doc_id", "left")
    lost = lambda c: F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).alias(c)
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), lost("good"), lost("toxic"))


def orders(counted: DataFrame) -> DataFrame:
    """Each part, order of the filters and step with its counts, from :func:`cells`."""
    held = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    spread = held.select("part", "cells", F.explode(F.lit(["".join(p) for p in permutations(FILTERS)])).alias("filter_order"))
    stepped = spread.select("part", "cells", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bits = lambda letters: F.aggregate(letters, F.lit(0), lambda s, c: s + F.element_at(F.lit([1 << k for k in range(len(FILTERS))]), F.ascii(c) - ord("A") + 1))
    letters = F.split("filter_order", "")
    placed = stepped.withColumns({"bit": bits(F.slice(letters, F.col("step"), F.lit(1))), "before": bits(F.slice(letters, F.lit(1), F.col("step") - 1))})

    def total(test, value=lambda c: c["n"]) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(test(c["mask"]), value(c)).otherwise(F.lit(0)).cast("long"))

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    removed = lambda m: fails(m) & ~gone(m)
    # a filter is the first of the k that a document fails in one of k orders
    share = lambda c: c["n"] * F.lit(120) / F.bit_count(c["mask"])
    return placed.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda m: m == F.col("bit")).alias("unique_fails"),
        total(removed, lambda c: c["good"]).alias("good_lost"),
        total(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows for each part of ``docs``: 120 orders of five steps."""
    return orders(materialize(cells(masks(docs), labels), "cells"))
