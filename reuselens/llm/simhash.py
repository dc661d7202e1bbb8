"""SimHash near-duplicate groups by pigeonhole blocks.

A 64-bit fingerprint is cut into six blocks. Two fingerprints that differ in at
most three bits differ in at most three blocks, so they agree on some three
blocks out of six: each fingerprint is dealt to twenty buckets, one for each
choice of three blocks, and only fingerprints of one bucket are compared.

Equal fingerprints are folded before dealing, so a group of copies of any size
is one row. A bucket that is still larger than ``bucket`` is not compared but
dealt again by the pigeonhole rule over its free bits (four parts, one of them
equal), down to at most 2**13 values of free bits, which bounds every bucket
without dropping a link. Buckets give spanning edges, not all pairs.

Edge cases: null or empty text and text of white space alone has fingerprint
zero and links like any other; fewer than ``shingle`` words are one shingle;
rows with equal ids stay apart rows; a row without an id gets the component of
the rows that have one, or null; an empty table gives an empty result; columns
of the input other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..plans.materialize import materialize

SEED = 42
DISTANCE = 3
WIDTHS = (11, 11, 11, 11, 10, 10)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends[:-1])]
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        values = [hashed(joined, SEED)]
    else:
        values = [hashed(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    lanes = np.array(values, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    bits = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * bits > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _block_keys(widths: tuple[int, ...], keep: int) -> list[tuple[int, list[tuple[int, int]]]]:
    starts = [0, *accumulate(widths)][:-1]
    return [(n, [(starts[i], widths[i]) for i in chosen]) for n, chosen in enumerate(combinations(range(len(widths)), keep))]


def _mask(parts: list[tuple[int, int]]) -> int:
    return sum(((1 << w) - 1) << s for s, w in parts)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _free_parts(mask: int) -> list[int]:
    """The unmasked bits in four parts, as masks."""
    free = [k for k in range(64) if not mask >> k & 1]
    return [sum(1 << int(k) for k in part) for part in np.array_split(free, DISTANCE + 1)]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(fp: np.ndarray, rep: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that span the components of one bucket."""
    out, left = [], np.arange(1, len(fp))
    frontier = np.array([0])
    root = 0
    while True:
        grown = []
        for f in frontier:
            if not len(left):
                break
            near = _popcount(fp[left] ^ fp[f]) <= DISTANCE
            if near.any():
                hit = left[near]
                out.append((rep[hit], np.full(len(hit), rep[root])))
                grown.append(hit)
                left = left[~near]
        if not len(left):
            return out
        if grown:
            frontier = np.concatenate(grown)
        else:
            root, frontier, left = left[0], left[:1], left[1:]


def _bucket_edges(bucket: int):
    """Streams buckets in key order; holds one bucket of at most ``bucket`` rows and one batch.

    Rows out: kind 0 is an edge (a, b); kind 1 is a row (fp in a, rep in b,
    mask) of a bucket that is too large here and goes on to the next level.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [np.empty(0, np.int64) for _ in range(4)]  # mask, key, fp, rep
        over = None

        def out(kind, mask, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(mask), pa.array(a), pa.array(b)], names=["kind", "mask", "a", "b"])

        def solve(rows):
            mask, key, fp, rep = rows
            if not len(key):
                return
            new = np.r_[True, (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])]
            start = np.flatnonzero(new)
            size = np.diff(np.r_[start, len(key)])
            small = np.repeat((size > 1) & (size <= 32), size)
            f, group = fp.view(np.uint64), np.cumsum(new)
            a_out, b_out = [], []
            for d in range(1, 32):
                at = np.flatnonzero(small[:-d] & (group[:-d] == group[d:])) if len(key) > d else np.empty(0, np.int64)
                if not len(at):
                    break
                at = at[_popcount(f[at] ^ f[at + d]) <= DISTANCE]
                a_out.append(rep[at])
                b_out.append(rep[at + d])
            for k in np.flatnonzero((size > 32) & (size <= bucket)):
                s = slice(start[k], start[k] + size[k])
                for a, b in _forest(f[s], rep[s]):
                    a_out.append(a)
                    b_out.append(b)
            if a_out:
                a, b = np.concatenate(a_out), np.concatenate(b_out)
                yield out(0, np.zeros(len(a), np.int64), a, b)
            for k in np.flatnonzero(size > bucket):
                s = slice(start[k], start[k] + size[k])
                yield out(1, mask[s], fp[s], rep[s])

        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if not len(rows[0]):
                continue
            if over is not None:
                same = (rows[0] == over[0]) & (rows[1] == over[1])
                n = len(same) if same.all() else int(np.argmin(same))
                if n:
                    yield out(1, rows[0][:n], rows[2][:n], rows[3][:n])
                rows = [r[n:] for r in rows]
                if not len(rows[0]):
                    continue
                over = None
            rows = [np.concatenate([c, r]) for c, r in zip(carry, rows)]
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            yield from solve([r[:cut] for r in rows])
            carry = [r[cut:] for r in rows]
            if len(carry[0]) > bucket:
                over = (carry[0][0], carry[1][0])
                yield out(1, carry[0], carry[2], carry[3])
                carry = [c[:0] for c in carry]
        yield from solve(carry)

    return run


def links(reps: DataFrame, bucket: int = 4096) -> DataFrame:
    """``(src, dst)``: edges between ``rep`` ids that span every group of
    fingerprints linked at ``DISTANCE`` bits or fewer.

    ``reps`` holds one row ``(fp, rep)`` for each distinct fingerprint.
    """
    spec = [_mask(parts) for _, parts in _block_keys(WIDTHS, len(WIDTHS) - DISTANCE)]
    rows = reps.select("fp", "rep", F.explode(F.array(*[F.lit(_signed(m)) for m in spec])).alias("mask"))
    edges = None
    while True:
        keyed = rows.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp", "rep")
        found = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_bucket_edges(bucket), "kind int, mask long, a long, b long")
        found = materialize(found, "simhash")
        part = found.where("kind = 0").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        edges = part if edges is None else edges.union(part)
        over = found.where("kind = 1")
        spec = [r[0] for r in over.select("mask").distinct().collect()]  # at most 20 * 4 ** 4 masks
        if not spec:
            return edges
        wider = F.create_map(*[x for m in spec for x in (F.lit(m), F.array(*[F.lit(_signed((m % (1 << 64)) | p)) for p in _free_parts(m % (1 << 64))]))])
        rows = over.select(F.col("a").alias("fp"), F.col("b").alias("rep"), F.explode(wider[F.col("mask")]).alias("mask")).distinct()
        bucket = max(bucket, 1 << 13) if any(64 - bin(m % (1 << 64)).count("1") <= 18 for m in spec) else bucket


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bucket: int = 4096) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row for each input row."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fp-reps")
    groups = connected_components(links(reps.where("rep is not null"), bucket)).select(F.col("node").alias("rep"), "component")
    named = reps.join(groups, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


# -- groups by similarity of texts: bands of min-hashes over sets of word shingles

#: A pair at Jaccard similarity 0.8 shares none of the bands with probability (1 - 0.8**6)**32 = 6e-5.
_BANDS = 32
_BAND_ROWS = 6
_COEFFICIENTS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, _BANDS * _BAND_ROWS, 1), dtype=np.uint64) | np.array([1, 0], np.uint64)[:, None, None]
#: Pairs go on to their texts where this share of the min-hashes is equal: 0.8 less 4.5 deviations of 192, so a pair at 0.8 fails with probability 3e-6.
_PLAUSIBLE = 0.67
#: Rounds with pivots go on while they would leave so many pairs a row and still take off a tenth.
_LEFT_A_ROW = 2


def bands(text: str | None, shingle: int) -> tuple[np.ndarray, bytes]:
    """A key for each band of min-hashes of the set of word shingles, as signed longs, and a byte of each min-hash."""
    digest = xxhash.xxh3_64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    starts = max(1, len(words) - shingle + 1)
    x = np.unique(np.fromiter((digest(b" ".join(words[k : k + shingle])) for k in range(starts)), np.uint64, starts))
    low = np.full(_BANDS * _BAND_ROWS, 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 4096):
            low = np.minimum(low, (x[at : at + 4096] * _COEFFICIENTS[0] + _COEFFICIENTS[1]).min(axis=1))
    rows = low.reshape(_BANDS, -1)
    keys = np.array([digest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64).view(np.int64)
    return keys, np.array([digest(v) & 255 for v in low.view("V8")], np.uint8).tobytes()


def _banded(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [bands(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([k for k, _ in found], pa.list_(pa.int64())), pa.array([x for _, x in found], pa.binary())], names=["rep", "bands", "sketch"])

    return run


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, _BANDS * _BAND_ROWS)


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches are alike enough."""
    for b in batches:
        keep = (_sketches(b.column("x_sketch")) == _sketches(b.column("y_sketch"))).mean(axis=1) >= _PLAUSIBLE
        yield pa.RecordBatch.from_arrays([b.column("src"), b.column("dst")], names=["src", "dst"]).filter(pa.array(keep))


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of one band and two components whose sketches are alike enough, of rows in order of both.

    Holds the rows of one band and one batch.
    """
    band, component, rep = (np.empty(0, np.int64) for _ in range(3))
    sketch = np.empty((0, _BANDS * _BAND_ROWS), np.uint8)

    def solve(band, component, rep, sketch):
        n = len(band)
        if not n:
            return
        # each row meets the rows of its band that come after its component
        new = np.r_[True, band[1:] != band[:-1]]
        part = np.r_[True, new[1:] | (component[1:] != component[:-1])]
        ends = np.r_[np.flatnonzero(new)[1:], n][np.cumsum(new) - 1]
        begin = np.r_[np.flatnonzero(part)[1:], n][np.cumsum(part) - 1]
        count = ends - begin
        at = 0
        total = np.cumsum(count)
        while at < n:
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 16), side="right")))
            c = count[at:to]
            if c.any():
                i = np.repeat(np.arange(at, to), c)
                j = begin[i] + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
                near = (sketch[i] == sketch[j]).mean(axis=1) >= _PLAUSIBLE
                i, j = i[near], j[near]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(rep[i], rep[j])), pa.array(np.minimum(rep[i], rep[j]))], names=["src", "dst"])
            at = to

    for b in batches:
        new = [b.column(k).to_numpy() for k in ("band", "component", "rep")]
        band, component, rep = (np.concatenate(x) for x in zip((band, component, rep), new))
        sketch = np.concatenate([sketch, _sketches(b.column("sketch"))])
        if not len(band):
            continue
        cut = int(np.searchsorted(band, band[-1]))
        yield from solve(band[:cut], component[:cut], rep[:cut], sketch[:cut])
        band, component, rep, sketch = band[cut:], component[cut:], rep[cut:], sketch[cut:]
    yield from solve(band, component, rep, sketch)


def _similar(shingle: int, similarity: float):
    """Pairs of texts whose sets of word shingles are similar."""

    def shingles(text: str) -> set[int]:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if len(words) <= shingle:
            return {hash(tuple(words))}
        return set(map(hash, zip(*[words[k:] for k in range(shingle)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, last, mine = [], None, set()
            for x, y in zip(b.column("x_text").to_pylist(), b.column("y_text").to_pylist()):
                if x is not last:
                    last, mine = x, shingles(x)
                other = shingles(y)
                both = len(mine & other)
                keep.append(both >= similarity * (len(mine) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b.column("src"), b.column("dst")], names=["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    return run


def _similar_texts(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, k1, k2, h)`` of all rows, with digests of the text and of the
    row, and ``(k1, k2, component)`` of all texts, where ``component`` numbers the groups."""
    whole = F.coalesce(F.col(text_col), F.lit(""))
    digests = [F.xxhash64(whole).alias("k1"), F.unhex(F.md5(whole)).alias("k2")]
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole.alias("text"), *digests, F.xxhash64(*plain).alias("h"))
    keyed = materialize(own.select("doc_id", "k1", "k2", "h"), "similar-keys")
    # every text has a number of its own; the row with the least id and digest carries it
    counted = keyed.groupBy("k1", "k2", "doc_id", "h").agg(F.count("*").alias("equal"))
    firsts = counted.groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h", "equal")).alias("one"))
    firsts = materialize(firsts.select("k1", "k2", F.monotonically_increasing_id().alias("rep"), F.col("one.doc_id").alias("doc_id"), F.col("one.h").alias("h"), F.col("one.equal").alias("equal")), "similar-firsts")
    same = [own["k1"] == firsts["k1"], own["k2"] == firsts["k2"], own["h"] == firsts["h"], own["doc_id"].eqNullSafe(firsts["doc_id"])]
    held = own.join(firsts.where("equal = 1"), same).select("rep", "text")
    if firsts.where("equal > 1").limit(1).count():  # of rows equal in all columns one carries the text
        held = held.unionByName(own.join(firsts.where("equal > 1"), same).select("rep", "text").dropDuplicates(["rep"]))
    texts = materialize(held, "similar-texts")
    sketches = materialize(texts.select("rep", "text").mapInArrow(_banded(shingle), "rep long, bands array<long>, sketch binary"), "similar-sketches")
    rows = sketches.select(F.explode("bands").alias("band"), "rep")
    met = rows.groupBy("band").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("band")
    several = rows.join(met.hint("shuffle_hash"), "band", "left_semi").select("band", "rep", F.col("rep").alias("component"))
    rows = materialize(several, "similar-rows")

    def near(pairs: DataFrame) -> DataFrame:
        sides = [sketches.select(F.col("rep").alias(c), F.col("sketch").alias(f"{t}_sketch")) for c, t in (("src", "x"), ("dst", "y"))]
        return pairs.join(sides[0], "src").join(sides[1], "dst").mapInArrow(_plausible, "src long, dst long")

    def checked(pairs: DataFrame) -> DataFrame:
        sides = [texts.select(F.col("rep").alias(c), F.col("text").alias(f"{t}_text")) for c, t in (("src", "x"), ("dst", "y"))]
        return materialize(pairs.join(sides[0], "src").join(sides[1], "dst").mapInArrow(_similar(shingle, similarity), "src long, dst long"), "similar-edges")

    def components(edges: DataFrame) -> DataFrame:
        return connected_components(edges).select(F.col("node").alias("rep"), "component")

    def labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
        named = rows.select("band", "rep").join(components(edges), "rep", "left").select("band", "rep", F.coalesce("component", "rep").alias("component"))
        mixed = named.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("band")
        return materialize(named.join(mixed, "band", "left_semi"), "similar-rows", consumed=(rows,))

    # SimHash first: texts of one fingerprint, and of linked ones, are checked on their shingles; bands then find what fingerprints miss
    fps = materialize(fingerprints(texts, "rep", "text"), "similar-fingerprints")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "similar-reps")
    equal = fps.join(reps, "fp").where("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst"))
    linked = equal.unionByName(links(reps)).select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    tried = materialize(linked, "similar-pairs", consumed=(fps, reps))
    edges = checked(tried)
    rows = labelled(rows, edges)
    left = None
    for k in range(1 << 10):
        pivot = rows.groupBy("band").agg(F.min_by(F.struct("rep", "component"), F.struct(F.xxhash64("rep", F.lit(k)), "rep")).alias("p"))
        pairs = rows.join(pivot, "band").where(F.col("component") != F.col("p.component")).select(F.greatest("rep", "p.rep").alias("src"), F.least("rep", "p.rep").alias("dst")).distinct()
        pairs = materialize(pairs.join(tried, ["src", "dst"], "left_anti"), "similar-pairs")
        tried = tried.unionByName(pairs)
        edges = edges.unionByName(checked(materialize(near(pairs), "similar-near")))
        rows = labelled(rows, edges)
        sizes = rows.groupBy("band", "component").agg(F.count("*").cast("double").alias("n")).groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("s"))
        n, now = sizes.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("s")) / 2)).first()
        if not n or now <= _LEFT_A_ROW * n or (left is not None and now > 0.9 * left):
            break
        left = now
    apart = rows.join(sketches.select("rep", "sketch"), "rep").repartition("band").sortWithinPartitions("band", "component", "rep").mapInArrow(_apart, "src long, dst long").distinct()
    apart = materialize(apart.join(tried, ["src", "dst"], "left_anti"), "similar-pairs", consumed=(rows,))
    edges = edges.unionByName(checked(apart))
    named = firsts.join(components(edges), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    return keyed, materialize(named, "similar-groups", consumed=(texts, firsts, apart, sketches))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``(doc_id, group_id)``: groups of texts whose word shingles have a
    Jaccard similarity of ``similarity`` or more, by the smallest id.

    Equal texts are folded. Texts whose SimHash fingerprints are linked
    (``DISTANCE`` bits) are checked on their shingles first. Texts not linked by
    these meet where one of 32 bands of min-hashes is equal, which a pair at 0.8 misses with probability 6e-5, whatever the size
    of the table or of the band. Pairs that meet are held against each other by
    sketches of 192 min-hashes, and those alike enough are checked on their
    shingles, but for pairs that others have linked by then: first, rounds in
    which the rows of a band meet one pivot, then all rows still apart. Null is the empty text, and empty texts are one group.
    """
    keyed, groups = _similar_texts(docs, id_col, text_col, shingle, similarity)
    ids = keyed.groupBy("k1", "k2").agg(F.min("doc_id").alias("first")).join(groups, ["k1", "k2"])
    least = ids.groupBy("component").agg(F.min("first").alias("group_id"))
    return keyed.select("doc_id", "k1", "k2").join(groups.join(least, "component").select("k1", "k2", "group_id"), ["k1", "k2"]).select("doc_id", "group_id")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``docs`` for each group of :func:`similar_documents`: that of
    the smallest id, and of the rows with this id the one of the least digest.

    Null ids come last; one of rows that are equal in all columns stays.
    """
    keyed, groups = _similar_texts(docs, id_col, text_col, shingle, similarity)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2", "h")
    best = keyed.groupBy("k1", "k2").agg(F.min(order).alias("one")).join(groups, ["k1", "k2"]).groupBy("component").agg(F.min("one").alias("one"))
    best = materialize(best.select("one.doc_id", "one.k1", "one.h"), "similar-best", consumed=(keyed, groups))
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_k1"), F.xxhash64(*plain).alias("_h"))
    same = rows["_id"].eqNullSafe(best["doc_id"]) & (rows["_k1"] == best["k1"]) & (rows["_h"] == best["h"])
    return rows.join(best, same, "left_semi").dropDuplicates(["_id", "_k1", "_h"]).select("row.*")
