"""Merkle manifest of a table: a tree for each group, a tree over their roots, proofs, and their check.

Every level is one window over runs of ``FANOUT`` neighbours: partitioned by
group and parent index, an ordered ``collect_list`` over the whole frame gives
both what the parent is the hash of and the siblings of each node. Parents are
then reduced to one row each and make up the next level, an eighth as large.
On the way back each node takes its parent's path, so a path is shuffled once a
run and not once a leaf. No window holds more than ``FANOUT`` rows, and no
group, however large, is one task.

Edge cases: a null is ``-`` and an empty text ``0:``, so they differ; a null
group is a group of its own, before all others; leaves without an id come first
in their group, equal ids are ordered by their leaves, and rows equal in all
columns have equal leaves, each with a place of its own; a leaf alone is its
group's root, a group alone the whole root; an empty table has no root and
gives no row. Columns that are not asked for play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from ..plans.ordering import global_index
from .grouping import with_groups

FANOUT = 8
_PATH = "array<struct<before:string,after:string>>"


def preimage(value: Column) -> Column:
    """A value as its UTF-8 byte count, ``:`` and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[preimage(v) for v in values]), 256)


def _depth(most: int) -> int:
    """Levels until the largest group has one node left."""
    levels = 0
    while most > 1:
        most, levels = -(-most // FANOUT), levels + 1
    return levels


def _grow(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels ``(k, idx, up, n, h, before, after, parent, ..)`` of the groups of ``nodes (k, idx, n, h, ..)``, the leaves first,
    and ``(k, h, level)``: each group's root and the level on which it stands. What else leaves hold stays with them."""
    rest = [c for c in nodes.columns if c not in ("k", "idx", "n", "h")]
    runs = Window.partitionBy("k", "up").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = (F.col("idx") % FANOUT).cast("int")
    lone = lambda df, level: df.where("n = 1").select("k", "h", F.lit(level).alias("level"))
    roots, levels = lone(nodes, 0), []
    for depth in range(_depth(most)):
        placed = nodes.where("n > 1").withColumn("up", F.floor(F.col("idx") / FANOUT)).withColumn("run", F.collect_list("h").over(runs))
        level = placed.select(
            "k", "idx", "up", "n", "h",
            F.array_join(F.slice("run", F.lit(1), at), "").alias("before"),
            F.array_join(F.slice("run", at + 2, F.lit(FANOUT)), "").alias("after"),
            F.sha2(F.array_join("run", ""), 256).alias("parent"), *(rest if depth == 0 else []),
        )
        levels.append(materialize(level, "merkle-level"))
        nodes = levels[-1].select("k", F.col("up").alias("idx"), F.ceil(F.col("n") / FANOUT).alias("n"), F.col("parent").alias("h")).distinct()
        roots = roots.unionByName(lone(nodes, depth + 1))
    return levels, roots


def _paths(nodes: DataFrame, levels: list[DataFrame], roots: DataFrame, carry: str) -> DataFrame:
    """``(carry, path, ..)`` of the leaves ``nodes (k, n, carry)``: siblings level by level, then the path of ``roots (k, level, path, ..)``.

    Nodes of a level join the paths of their parents, an eighth as many rows.
    """
    rest = [c for c in roots.columns if c not in ("k", "level", "path")]
    standing = lambda level: roots.where(F.col("level") == level).select("k", F.lit(0).cast("long").alias("idx"), "path", *rest)
    found = standing(len(levels))
    for depth, level in reversed(list(enumerate(levels))):
        above = found.withColumnRenamed("idx", "up").withColumnRenamed("path", "_above")
        path = F.concat(F.array(F.struct("before", "after")), F.col("_above")).alias("path")
        joined = level.join(above, ["k", "up"])
        found = joined.select("k", "idx", path, *rest).unionByName(standing(depth)) if depth else joined.select(carry, path, *rest)
    lone = nodes.where("n = 1").select("k", carry).join(standing(0).drop("idx"), "k").select(carry, "path", *rest)
    return found.unionByName(lone) if levels else lone


def manifest(leaves: DataFrame, group: str, order: list[str], leaf: str = "leaf") -> tuple[DataFrame, str | None]:
    """``leaves`` with ``subroot``, the root of their group, and ``path``, their siblings level by level; and the whole root.

    ``group`` is text; within it leaves ascend by ``order``, nulls first, ties
    by their hash. The root is None for an empty table.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("k")  # null, as the shortest, comes before all others
    carried = F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("carried")
    keyed = leaves.select(named, F.struct(*order).alias("_order"), F.col(leaf).alias("h"), carried)
    placed = global_index(keyed, [F.asc("k"), *[F.asc_nulls_first(f"_order.{c}") for c in order], F.asc("h")], "pos")
    groups = materialize(placed.groupBy("k").agg(F.count("*").alias("n"), F.min("pos").alias("first")), "merkle-groups")
    rows = materialize(with_groups(placed, groups, "k").select("k", (F.col("pos") - F.col("first")).alias("idx"), "n", "h", "carried"), "merkle-leaves", consumed=(placed,))
    most, count = groups.agg(F.max("n"), F.count("*")).first()
    if not count:
        return leaves.withColumns({"subroot": F.lit(None).cast("string"), "path": F.lit(None).cast(_PATH)}), None

    levels, roots = _grow(rows, most)
    roots = materialize(roots, "merkle-roots")
    tops = materialize(global_index(roots, [F.asc("k")], "idx"), "merkle-tops")
    nodes = tops.select(F.lit("").alias("k"), "idx", F.lit(count).cast("long").alias("n"), "h", F.struct(F.col("k"), "level", F.col("h").alias("subroot")).alias("top"))
    above, root = _grow(nodes, count)
    root = materialize(root.withColumn("path", F.array().cast(_PATH)), "merkle-root")
    ends = materialize(_paths(nodes, above, root.drop("h"), "top").select("top.*", "path"), "merkle-ends")
    return _paths(rows, levels, ends, "carried").select("carried.*", "subroot", "path"), root.first()["h"]  # one row


def proof_hash(path: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def audited(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` under a planted tampering.

    The leaf is the hash of ``columns``. In rows whose id has a check sum that
    3 divides, A-Z of the text are lower-cased after the manifest was made;
    a row without an id, or with a null text, is never tampered with.
    """
    of = lambda text: leaf_hash(*[text if c == text_col else F.col(f"`{c}`") for c in columns])
    lowered = F.translate(F.col(f"`{text_col}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    touched = F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 0
    plain = F.col(f"`{text_col}`")
    leaves = materialize(
        docs.select(F.col(f"`{group}`").cast("string").alias("lang"), F.col(f"`{id_col}`").alias("doc_id"), of(plain).alias("leaf"), F.when(touched & (lowered != plain), of(lowered)).alias("tampered")), "merkle-hashes"
    )
    rows, root = manifest(leaves, "lang", ["doc_id"])
    found = rows.withColumn("root", F.lit(root).cast("string")).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
