"""Byte-level BPE with a segment tree over byte positions.

Each piece of text that the split pattern gives is encoded on its own. A leaf
of the tree stands for a byte position and holds the rank of the pair that
starts there (live token and its live right neighbour), with the position in
the low bits, so the root names the leftmost pair of least rank. A merge
changes three leaves: the merged position, its left neighbour and the position
that died; each is a walk of logarithmic length to the root.

Pieces of up to ``WIDE`` bytes are encoded together, one tree a row of an
array; longer ones have a tree of their own, so a piece of n bytes takes
n log n steps however long it is. A memo of at most ``MEMO_BYTES`` keeps pieces
of up to ``WIDE`` bytes that a worker has met; it changes the time, not the
result.

Edge cases: null and empty texts have no ids; white space alone, any script and
unassigned characters are bytes like others; ids above the vocabulary raise on
decoding; repeated rows give equal values; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.int64(1) << 62
WIDE = 128
MEMO_BYTES = 64 << 20
#: What a piece takes in the memo beside its own bytes and eight for each id: two objects and a place in the table.
_ENTRY_BYTES = 210
_TREE_CELLS = 1 << 21


class Vocabulary:
    """Ranks of a .tiktoken file; the id of a token is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.memo: dict[str, tuple[int, ...]] = {}
        self.memo_bytes = 0

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """(left id, right id) -> id, for each cut of each token into two tokens; only encoders need it."""
        out = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    out[a << 32 | b] = rank
        return out

    @cached_property
    def sorted_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        keys = sorted(self.pairs)
        return np.array([*keys, NONE], dtype=np.int64), np.array([*(self.pairs[k] for k in keys), 0], dtype=np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE without one."""
        wanted = a << 32 | b
        keys, values = self.sorted_pairs
        at = np.searchsorted(keys, wanted)
        return np.where(keys[at] == wanted, values[at], NONE)

    # -- encoding

    def _encode_rows(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Pieces of at most ``width`` bytes (a power of two), one tree a row."""
        n, shift = len(pieces), width.bit_length() - 1
        size = np.fromiter(map(len, pieces), np.int64, n)
        column = np.arange(width)
        inside = column < size[:, None]
        ids = np.full((n, width), -1, dtype=np.int64)
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        after = np.where(column + 1 < size[:, None], column + 1, width)
        before = np.broadcast_to(column - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        pair = inside[:, 1:]
        first = self.rank(ids[:, :-1][pair], ids[:, 1:][pair])
        tree[:, width:-1][pair] = np.where(first < NONE, first << shift | np.broadcast_to(column[:-1], pair.shape)[pair], NONE)
        for level in range(shift, 0, -1):
            lo, hi = 1 << (level - 1), 1 << level
            tree[:, lo:hi] = np.minimum(tree[:, hi : 2 * hi : 2], tree[:, hi + 1 : 2 * hi : 2])

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = value
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def leaf(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank < NONE, rank << shift | at, NONE)

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            top = tree[rows, 1]
            at, rank = top & (width - 1), top >> shift
            dead = after[rows, at]
            right, left = after[rows, dead], before[rows, at]
            ids[rows, at], ids[rows, dead], after[rows, at] = rank, -1, right
            put(rows, dead, np.full(len(rows), NONE))
            has = right < width
            before[rows[has], right[has]] = at[has]
            fresh = np.full(len(rows), NONE)
            fresh[has] = leaf(self.rank(rank[has], ids[rows[has], right[has]]), at[has])
            put(rows, at, fresh)
            has = left >= 0
            if has.any():
                put(rows[has], left[has], leaf(self.rank(ids[rows[has], left[has]], rank[has]), left[has]))
            rows = rows[tree[rows, 1] < NONE]
        live = ids >= 0
        flat, ends = ids[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    def _encode_long(self, piece: bytes) -> tuple[int, ...]:
        """One piece of any length."""
        n = len(piece)
        shift = max(1, (n - 1).bit_length())
        width, none, pairs = 1 << shift, int(NONE), self.pairs
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = pairs.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[width + i] = rank << shift | i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        def leaf(at: int, right: int) -> int:
            rank = pairs.get(ids[at] << 32 | ids[right])
            return none if rank is None else rank << shift | at

        while tree[1] < none:
            at, rank = tree[1] & (width - 1), tree[1] >> shift
            dead = after[at]
            right, left = after[dead], before[at]
            ids[at], ids[dead], after[at] = rank, -1, right
            put(dead, none)
            if right >= 0:
                before[right] = at
            put(at, leaf(at, right) if right >= 0 else none)
            if left >= 0:
                put(left, leaf(left, at))
        return tuple(i for i in ids if i >= 0)

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        groups: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if piece in self.ranks:
                out[k] = (self.ranks[piece],)
            elif len(piece) > WIDE:
                out[k] = self._encode_long(piece)
            else:
                groups.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(k)
        for width, members in groups.items():
            step = max(1, _TREE_CELLS // (2 * width))
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for k, ids in zip(part, self._encode_rows([pieces[k] for k in part], width)):
                    out[k] = ids
        return out

    def encode_texts(self, pieces: list[list[str]]) -> Iterator[np.ndarray]:
        """Ids of texts, each given as the pieces it was split into."""
        for at in range(0, len(pieces), 256):
            part = pieces[at : at + 256]
            fresh = list(set(chain.from_iterable(part)).difference(self.memo))
            found = dict(zip(fresh, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in fresh])))
            known = self.memo.get
            for words in part:
                yield np.fromiter(chain.from_iterable(found[w] if (ids := known(w)) is None else ids for w in words), dtype="<u4")
            self._keep(found)

    def _keep(self, found: dict[str, tuple[int, ...]]) -> None:
        short = {p: ids for p, ids in found.items() if len(p) <= WIDE}
        size = sum(_ENTRY_BYTES + 4 * len(p) + 8 * len(ids) for p, ids in short.items())
        if self.memo_bytes + size > MEMO_BYTES:
            self.memo, self.memo_bytes = {}, 0
        if size <= MEMO_BYTES:
            self.memo.update(short)
            self.memo_bytes += size

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a worker process."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``; ids as bytes, four a token, little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        vocab, split = vocabulary(path), regex.compile(pattern).findall
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                found = [ids.tobytes() for ids in vocab.encode_texts([split(t or "") for t in b.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)``; decoded as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in batches:
            found = [vocab.decode(np.frombuffer(x, dtype="<u4")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
