"""Removal of byte strings that occur more than once in the corpus.

Every window of ``span`` bytes is owned by an anchor, the least-hashed gram of
``GRAM`` bytes in it (the leftmost of equal ones). Equal windows own equal
anchors at equal offsets, so windows of different anchors need no comparison.
The windows an anchor owns are one region of the text. Steps:

1. regions of all documents, as digests of anchor and of region bytes;
2. anchors met once are dropped; equal regions are folded to one with a count,
   so copies of any number are one row (folded regions are repeats as a whole);
3. anchors with several different regions go to shards by anchor. Each shard
   is sorted by external induced sorting (:mod:`.induced_sort`), and suffixes
   with a common prefix of ``span`` bytes or more with a neighbour are repeats;
   anchors with more than ``hot`` different regions are not put in one shard:
   their windows are counted by 128-bit digests, a plain aggregation in which
   every window is a key of its own;
4. repeats go back to the documents that hold the region, and the union of
   their bytes is removed.

Digests of regions and windows are 128-bit; everything else is exact.

Edge cases: null is the empty text; texts shorter than ``span`` lose nothing
and give nothing to others; copies lose everything, also within one document;
ids must name texts: repeated rows (same id, same text) count as two documents,
and a row without an id goes by a hash of its text; other columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import drop_path, materialize, new_path

SPAN = 200
GRAM = 16
SEGMENT = 1 << 20
_POSITION_BITS = 24
#: So many tasks sort shards; beyond it a task takes shard after shard.
_TASKS = 1 << 12


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    words = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    with np.errstate(over="ignore"):
        x = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x += words[8:]
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
    return x


def anchored_regions(raw: bytes, starts: np.ndarray, sizes: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """(text number, first window, windows, anchor hash) of the regions of texts that lie in one buffer of at most 2**24 bytes."""
    buffer = np.frombuffer(raw + bytes(16), dtype=np.uint8)
    hashes = gram_hashes(buffer)[: max(0, len(raw) - GRAM + 1)]
    n = len(hashes) - (span - GRAM)
    if n <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    low = hashes >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)
    low |= np.arange(len(low), dtype=np.uint64)
    width, want = 1, span - GRAM + 1
    while width * 2 <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < want:
        low = np.minimum(low[: n], low[want - width : want - width + n])
    at = (low & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    count = np.maximum(sizes - span + 1, 0)
    if not count.any():
        return tuple(np.empty(0, np.int64) for _ in range(4))
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), count)
    window = np.arange(len(owner)) + np.repeat(starts - (np.cumsum(count) - count), count)
    at = at[window]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
    count = np.diff(np.r_[first, len(window)])
    own = owner[first]
    return own, window[first] - starts[own], count, hashes[at[first]].view(np.int64)


_REGION = "doc_id long, start long, n int, anchor long, hi long, lo long"


def regions(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """The regions of ``(doc_id, text)`` rows with their 128-bit digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            group: list[tuple[int, int, bytes]] = []
            held = 0

            def flush():
                raw = b"".join(g[2] for g in group)
                sizes = np.array([len(g[2]) for g in group], dtype=np.int64)
                starts = np.cumsum(sizes) - sizes
                own, first, count, anchor = anchored_regions(raw, starts, sizes, span)
                begin = starts[own] + first
                both = b"".join([digest(raw[s:e]) for s, e in zip(begin.tolist(), (begin + count + span - 1).tolist())])
                halves = np.frombuffer(both, dtype="<i8").reshape(-1, 2)
                ids = np.array([g[0] for g in group], dtype=np.int64)
                shift = np.array([g[1] for g in group], dtype=np.int64)
                arrays = [ids[own], first + shift[own], count.astype(np.int32), anchor, halves[:, 0].copy(), halves[:, 1].copy()]
                return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["doc_id", "start", "n", "anchor", "hi", "lo"])

            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                for at in range(0, max(1, len(raw) - span + 1), SEGMENT):  # pieces of a very long text share span - 1 bytes
                    piece = raw[at : at + SEGMENT + span - 1]
                    if len(piece) < span:
                        continue
                    group.append((doc, at, piece))
                    held += len(piece)
                    if held > SEGMENT:
                        yield flush()
                        group, held = [], 0
            if group:
                yield flush()

    return docs.mapInArrow(run, _REGION)


def _sort_shards(span: int, memory: int):
    """Repeats of the regions of shard after shard, rows in order of shard, as ranges of windows. Holds one shard."""

    def repeats(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        from .induced_sort import Shard

        table = pa.Table.from_batches(held).combine_chunks()
        strings = table.column("bytes").to_pylist()
        found = Shard(strings, span, memory).repeated()
        out = {k: [] for k in ("anchor", "hi", "lo", "at", "size")}
        keys = [table.column(k).to_pylist() for k in ("anchor", "hi", "lo")]
        place = 0
        for k, s in enumerate(strings):
            flags = found[place : place + len(s) - span + 1]
            place += len(s) + 1
            edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
            for a, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                for name, value in zip(out, (keys[0][k], keys[1][k], keys[2][k], a, e - a)):
                    out[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            while b.num_rows:
                shard = b.column("shard").to_numpy()
                if held and held[0].column("shard")[0].as_py() != shard[0]:
                    yield repeats(held)
                    held = []
                same = int(np.searchsorted(shard, shard[0], side="right"))
                held.append(b.slice(0, same))
                b = b.slice(same)
        if held:
            yield repeats(held)

    return run


def _window_digests(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            keys = [b.column(k).to_pylist() for k in ("anchor", "hi", "lo")]
            for a, h, low, s in zip(*keys, b.column("bytes").to_pylist()):
                n = len(s) - span + 1
                found = np.frombuffer(b"".join([digest(s[i : i + span]) for i in range(n)]), dtype="<i8").reshape(-1, 2)
                full = [pa.array(np.full(n, x, np.int64)) for x in (a, h, low)]
                yield pa.RecordBatch.from_arrays([*full, pa.array(np.arange(n, dtype=np.int32)), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["anchor", "hi", "lo", "at", "w1", "w2"])

    return run


def _cut_bytes(span: int):
    """Region bytes of documents, for the regions each document is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                cols = list(zip(*[(w["anchor"], w["hi"], w["lo"], raw[w["start"] : w["start"] + w["n"] + span - 1], w["hot"]) for w in wanted]))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["anchor", "hi", "lo", "bytes", "hot"])

    return run


def repeated_spans(docs: DataFrame, span: int = SPAN, hot: int = 20_000, shard_bytes: int = 4 << 20, memory: int = 8 << 20) -> DataFrame:
    """``(doc_id, spans)``: for each document that has any, the ranges [start,
    end) of bytes covered by repeated strings, sorted, overlapping ones apart."""
    spark = docs.sparkSession
    path = new_path(spark, "regions")
    regions(docs.select("doc_id", "text"), span).write.option("compression", "zstd").parquet(path)
    every = spark.read.schema(_REGION).parquet(path)
    again = every.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = materialize(every.join(again.hint("shuffle_hash"), "anchor", "left_semi"), "regions-shared")
    drop_path(spark, path)
    folded = materialize(shared.groupBy("anchor", "hi", "lo").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "start", "n")).alias("one")), "regions-folded")
    # regions met more than once are repeats as a whole: they are sorted only beside one that is not
    kinds = folded.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("copies") == 1).alias("single")).where("kinds > 1 and single > 0")
    ask = folded.join(kinds.hint("shuffle_hash"), "anchor").select(F.col("one.doc_id").alias("doc_id"), F.struct("anchor", "hi", "lo", F.col("one.start").alias("start"), F.col("one.n").alias("n"), (F.col("kinds") > hot).alias("hot")).alias("w"))
    # A document asks for its own regions only: their number is bounded by its length.
    asked = ask.groupBy("doc_id").agg(F.collect_list("w").alias("wanted"))
    text = docs.where("text is not null").select("doc_id", "text")
    cut = materialize(text.join(asked.hint("shuffle_hash"), "doc_id").mapInArrow(_cut_bytes(span), "anchor long, hi long, lo long, bytes binary, hot boolean"), "region-bytes")
    volume = cut.where("not hot").agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0)).alias("b"), F.count("*").alias("n")).head()
    shards = max(1, math.ceil(volume.b / shard_bytes))
    dealt = cut.where("not hot").select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "hi", "lo", "bytes").repartition(min(shards, _TASKS), "shard").sortWithinPartitions("shard")
    sorted_ = dealt.mapInArrow(_sort_shards(span, memory), "anchor long, hi long, lo long, at int, size int")
    counted = cut.where("hot").select("anchor", "hi", "lo", "bytes").mapInArrow(_window_digests(span), "anchor long, hi long, lo long, at int, w1 long, w2 long")
    common = counted.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    digested = counted.join(common, ["w1", "w2"]).select("anchor", "hi", "lo", "at", F.lit(1).alias("size"))
    whole = folded.where("copies > 1").select("anchor", "hi", "lo", F.lit(0).alias("at"), F.col("one.n").alias("size"))
    parts = materialize(sorted_.union(digested).union(whole).groupBy("anchor", "hi", "lo").agg(F.collect_list(F.struct("at", "size")).alias("parts")), "region-repeats")
    held = shared.select("doc_id", "start", "anchor", "hi", "lo").join(parts.hint("shuffle_hash"), ["anchor", "hi", "lo"])
    spans = held.select("doc_id", F.explode(F.transform("parts", lambda p: F.struct((F.col("start") + p["at"]).alias("s"), (F.col("start") + p["at"] + p["size"] + (span - 1)).alias("e")))).alias("x"))
    return spans.groupBy("doc_id").agg(F.array_sort(F.collect_set("x")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of sorted ranges."""
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, with_bytes: bool = False, **limits: int) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])`` of every row."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    key = F.coalesce("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))))
    spans = repeated_spans(own.select(key.alias("doc_id"), "text"), span, **limits).withColumnRenamed("doc_id", "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                runs = merged([(x["s"], x["e"]) for x in found or ()])
                edges = [0, *(x for r in runs for x in r), len(raw)]
                kept = b"".join(raw[a:e] for a, e in zip(edges[::2], edges[1::2]))
                out.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            n = 5 if with_bytes else 4
            arrays = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)][:n]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *arrays], names=["doc_id", *names[:n]])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return own.withColumn("_key", key).join(spans.hint("shuffle_hash"), "_key", "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
