"""Best-fit packing with certified bin counts.

Documents are cut into pieces of at most ``capacity`` tokens (the first piece
of a document takes the remainder, the others are full). Full pieces are
sequences of their own. The others are dealt to groups, and each group is
packed by best-fit decreasing. Dual feasible functions give a lower bound of a
group's count: a function u with sum(u(x)) <= 1 for every feasible bin makes
ceil(sum(u)) a bound. A group that meets its bound is certified and done. A
group with a gap keeps its fullest bins, as many as waste less than one bin
together, which meets the bound of what they hold; the documents of the other
bins go to an exchange: they are dealt to fewer groups and packed again, until
all are certified, the exchange no longer shrinks the count, or it was one
group. ``bins`` and ``bound`` of a piece are those of the set it was kept with.

A group holds sizes and row numbers of its pieces only, about ``group_items``;
a task takes group after group, and there are at most ``_TASKS`` tasks. What
the driver sees is one row of counts a round.

Edge cases: null text is an empty text, one piece with the end token alone;
equal documents are packed each for itself; an empty table gives an empty one;
columns other than id and text are ignored.
"""

from __future__ import annotations

import bisect
import json
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize

CAPACITY = 1024
END_ID = 2
_PIECE = "doc_id long, piece int, start long, length long"
_TASKS = 1 << 12


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The encode function of a tokenizer file.

    The file's own library encodes any text, special strings included. Text of
    Latin scripts without these, where the classes of the split pattern are the
    same in every Unicode version, goes through the same merges in the faster
    of the two installed libraries.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = {c: b for b, c in _byte_letters().items()}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_dense(ranks), special_tokens={})
    odd = re.compile("|".join(["[^\t-\r\x20-~\xa1-ɏ‐-‧]", *map(re.escape, sorted(added))])).search
    order = _ids_by_merge_rank(ranks)

    def encode(text: str) -> np.ndarray:
        if odd(text):
            return np.array(own.encode(text, add_special_tokens=False).ids, dtype="<u4")
        ids = np.array(fast.encode_ordinary(text), dtype="<u4")
        return ids if order is None else order[ids]

    return encode


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _dense(ranks: dict[bytes, int]) -> dict[bytes, int]:
    return {t: k for k, (t, _) in enumerate(sorted(ranks.items(), key=lambda x: x[1]))}


def _ids_by_merge_rank(ranks: dict[bytes, int]) -> np.ndarray | None:
    ids = np.array(sorted(ranks.values()), dtype="<u4")
    return None if np.array_equal(ids, np.arange(len(ids))) else ids


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of tokenized documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
                        raw = ids[s:e].tobytes()
                        for name, value in zip(out, (doc, k, s, e - s, zlib.crc32(raw), raw)):
                            out[name].append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(v, t) for v, t in zip(out.values(), kinds)]
                n = len(out) if with_ids else len(out) - 1
                yield pa.RecordBatch.from_arrays(arrays[:n], names=list(out)[:n])

    schema = f"{_PIECE}, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The best bound of a family of dual feasible functions over sizes in 1..capacity."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1)
    best = -(-int(count @ x) // capacity)
    # u_e: sizes over capacity - e count whole, sizes under e count nothing
    above, mass = np.cumsum(count[::-1])[::-1], np.cumsum(count * x)
    for e in range(1, capacity // 2 + 1):
        whole = int(above[capacity - e + 1])
        best = max(best, whole - (-int(mass[capacity - e] - mass[e - 1]) // capacity))
    # u_k: floor((k + 1) x / capacity) / k, exact multiples counted as they are
    for k in range(1, 64):
        scaled = (k + 1) * x
        exact = scaled % capacity == 0
        value = np.where(exact, scaled * k // capacity, (scaled // capacity) * (k + 1))  # times k (k + 1)
        best = max(best, -(-int(count @ value) // (k * (k + 1))))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece and its offset there."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space
    spaces: list[int] = []  # the spaces that have bins, sorted
    used = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        k = bisect.bisect_left(spaces, size)
        if k < len(spaces):
            space = spaces[k]
            b = free[space].pop()
            if not free[space]:
                spaces.pop(k)
        else:
            space, b, used = capacity, used, used + 1
        bins[i], offsets[i] = b, capacity - space
        left = space - size
        if left:
            if not free[left]:
                bisect.insort(spaces, left)
            free[left].append(b)
    return bins, offsets


_PACKED = f"{_PIECE}, ids_crc32 long, group long, bin long, offset long, bins long, bound long, open boolean"


def certified_bins(fill: np.ndarray, capacity: int) -> np.ndarray:
    """The fullest bins that waste less than one bin together: ceil(sum / capacity) is their number."""
    order = np.argsort(-fill, kind="stable")
    out = np.zeros(len(fill), bool)
    out[order[np.cumsum(capacity - fill[order]) < capacity]] = True
    return out


def _pack_groups(capacity: int):
    """Packs group after group of rows in order; ``open`` marks the pieces that go to the exchange."""

    def packed(table: pa.Table) -> pa.Table:
        sizes = table.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(sizes, capacity)
        used, bound = int(bins.max()) + 1, lower_bound(sizes, capacity)
        loose = np.zeros(len(sizes), bool)
        count, least = np.full(len(sizes), used), np.full(len(sizes), bound)
        if used > bound:
            keep = certified_bins(np.bincount(bins, weights=sizes, minlength=used).astype(np.int64), capacity)
            loose = ~keep[bins]
            for part, size in ((~loose, int(keep.sum())), (loose, used - int(keep.sum()))):
                count[part], least[part] = size, lower_bound(sizes[part], capacity)
        for name, values in (("bin", bins), ("offset", offsets), ("bins", count), ("bound", least), ("open", loose)):
            table = table.append_column(name, pa.array(values))
        return table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            while b.num_rows:
                group = b.column("group")
                if held and held[0].column("group")[0] != group[0]:
                    yield from packed(pa.Table.from_batches(held)).to_batches()
                    held = []
                same = int(np.searchsorted(group.to_numpy(), group[0].as_py(), side="right"))
                held.append(b.slice(0, same))
                b = b.slice(same)
        if held:
            yield from packed(pa.Table.from_batches(held)).to_batches()

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, group_items: int = 8192) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset, bins, bound)`` of pieces as :func:`pieces` cuts them."""
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    cut = cut.select(*own)
    whole = cut.where(F.col("length") == capacity)
    loose = cut.where(F.col("length") < capacity)
    settled, stage, before, n = [], 0, None, loose.count()
    while n:
        groups = max(1, math.ceil(n / group_items))
        dealt = loose.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(stage)), F.lit(groups)))
        dealt = dealt.repartition(min(groups, _TASKS), "group").sortWithinPartitions("group", *own)
        packed = materialize(dealt.mapInArrow(_pack_groups(capacity), _PACKED), "packed")
        sets = packed.groupBy("group", "open").agg(F.first("bins").alias("bins"), F.count("*").alias("n"))
        used, left, n = sets.agg(F.sum("bins"), F.sum(F.when(F.col("open"), F.col("bins"))), F.sum(F.when(F.col("open"), F.col("n")))).first()
        # An exchange that packed the same documents into no fewer bins is the last.
        last = groups == 1 or (before is not None and used >= before)
        settled.append(packed.where(F.lit(True) if last else ~F.col("open")).withColumn("stage", F.lit(stage)))
        loose, before, stage = packed.where("open").select(*own), left, stage + 1
        if last:
            break
    # Numbers: group, round and bin give a sequence; full pieces come after, one each.
    out = whole.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("bins"), F.lit(1).cast("long").alias("bound"))
    for packed in settled:
        number = F.lit(-1).cast("long") - ((F.col("group") * F.lit(1 << 6) + F.col("stage")) * F.lit(1 << 24) + F.col("bin"))
        out = out.unionByName(packed.select(*own, number.alias("sequence_id"), "offset", "bins", "bound"))
    return out


def assemble(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the token ids of each sequence, from pieces cut with their ids."""
    ids = cut.select("doc_id", "piece", "ids").join(packed, ["doc_id", "piece"])
    held = ids.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return held.select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + x["length"]).alias("length"),
        F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"),
    )
