"""Suffix order and common prefixes of one shard, by external induced sorting.

A shard is many strings, each ended by a separator of its own that is smaller
than any byte. Suffixes are L (greater than the next suffix) or S; an S suffix
after an L suffix is S*. The S* suffixes are ordered first: one induction sorts
their substrings, the substrings are named, and the string of names is ranked.
A second induction then carries tuples (suffix, common prefix with the suffix
before it in its bucket) through a monotone priority queue: buckets of first
bytes in order, tuples of a bucket in order of arrival. Tuples of one bucket
that are there at a time are handled as arrays. The queue keeps its tuples in
memory up to ``memory`` bytes and on disk beyond, in a scratch file that goes
with the task, so a shard's queue isn't bounded by memory.

Common prefixes are capped at ``cap``.
"""

from __future__ import annotations

import tempfile

import numpy as np


class BucketQueue:
    """First in, first out within a bucket; the oldest tuples of large buckets go to disk."""

    def __init__(self, buckets: int, memory: int):
        self.chunks: list[list] = [[] for _ in range(buckets)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, bucket: int, suffix: np.ndarray, prefix: np.ndarray) -> None:
        both = np.stack([suffix.astype(np.int32), prefix.astype(np.int32)])
        self.chunks[bucket].append(both)
        self.held += both.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for chunks in self.chunks:
            for k, c in enumerate(chunks):
                if isinstance(c, np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(c.tobytes())
                    chunks[k] = (at, c.shape)
        self.held = 0

    def take(self, bucket: int) -> np.ndarray | None:
        chunks, self.chunks[bucket] = self.chunks[bucket], []
        if not chunks:
            return None
        out = []
        for c in chunks:
            if isinstance(c, np.ndarray):
                self.held -= c.nbytes
                out.append(c)
            else:
                self.file.seek(c[0])
                out.append(np.frombuffer(self.file.read(4 * c[1][0] * c[1][1]), dtype=np.int32).reshape(c[1]))
        return out[0] if len(out) == 1 else np.concatenate(out, axis=1)


class Shard:
    """Strings of bytes put together with separators."""

    def __init__(self, strings: list[bytes], cap: int, memory: int = 256 << 20):
        self.cap, self.memory, self.prefixes = cap, memory, True
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.raw = np.frombuffer(b"\0".join(strings) + b"\0" + bytes(cap + 16), dtype=np.uint8)
        self.n = int(sizes.sum()) + len(strings)
        self.ends = np.cumsum(sizes + 1) - 1  # places of separators
        self.starts = self.ends - sizes
        self.text = self.raw[: self.n].astype(np.int16) + 1
        self.text[self.ends] = 0
        self.words = np.ndarray((len(self.raw) - 8,), dtype="<u8", buffer=self.raw, strides=(1,))
        change = np.r_[self.text[1:] != self.text[:-1], True]
        last = np.flatnonzero(change)  # of runs of one byte
        follow = np.r_[self.text[1:], np.int16(0)]
        size = np.diff(np.r_[-1, last])
        rising = self.text[last] < follow[last]
        rising[-1] = True
        self.s_type = np.repeat(rising, size)
        self.run = (np.repeat(last, size) - np.arange(self.n) + 1).astype(np.int32)
        star = np.r_[False, self.s_type[1:] & ~self.s_type[:-1]]
        self.star = star
        self.stars = np.flatnonzero(star)
        self.star_number = np.cumsum(star, dtype=np.int32) - 1
        self.end = np.repeat(self.ends.astype(np.int32), sizes + 1)

    # -- comparisons of bytes

    def _rest(self, at: np.ndarray) -> np.ndarray:
        """Bytes before the separator."""
        return self.end[at] - at

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes, word by word, up to the cap."""
        most = np.minimum(np.minimum(self._rest(a), self._rest(b)), self.cap)
        out = most.copy()
        alive = np.arange(len(a))
        for step in range(0, self.cap, 8):
            alive = alive[most[alive] > step]
            if not len(alive):
                break
            diff = self.words[a[alive] + step] ^ self.words[b[alive] + step]
            bad = diff != 0
            if bad.any():
                d = diff[bad]
                low = d & (~d + np.uint64(1))
                byte = np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3
                out[alive[bad]] = np.minimum(most[alive[bad]], step + byte)
                alive = alive[~bad]
        return out

    # -- induction

    def _scan(self, queue: BucketQueue, keep: int, suffix: np.ndarray, prefix: np.ndarray, carry: np.ndarray, begun: np.ndarray) -> None:
        """Sends the predecessors of scanned suffixes (those of type ``keep``) to their buckets."""
        before = suffix - 1
        target = self.text[before]
        ok = (suffix > 0) & (self.s_type[before] == keep) & (target > 0)
        at = np.flatnonzero(ok)
        if not self.prefixes:
            target = target[at]
            order = np.argsort(target, kind="stable")
            at, target = at[order], target[order]
            cut = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(at) else at
            before = before[at]
            for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(at)]):
                queue.push(int(target[s]), before[s:e], before[s:e])
            return
        least = int(prefix.min())
        if not len(at):
            np.minimum(carry, least, out=carry)
            return
        target = target[at]
        order = np.argsort(target, kind="stable")
        at, target = at[order], target[order]
        cut = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        tail = np.minimum.accumulate(prefix[::-1])[::-1]
        fresh = {}
        for s, e in zip(cut, np.r_[cut[1:], len(at)]):
            d, idx = int(target[s]), at[s:e]
            low = np.minimum.reduceat(prefix[: idx[-1] + 1], np.r_[0, idx[:-1] + 1])
            low[0] = min(int(low[0]), int(carry[d]))
            value = np.minimum(low + 1, self.cap)
            if not begun[d]:
                value[0], begun[d] = 0, True
            queue.push(d, before[idx], value)
            fresh[d] = int(tail[idx[-1] + 1]) if idx[-1] + 1 < len(prefix) else self.cap
        np.minimum(carry, least, out=carry)
        for d, value in fresh.items():
            carry[d] = value

    def _seam(self, a: int, b: int) -> int:
        """Common prefix of neighbours of one bucket, one of each type: both are runs of its byte."""
        return min(int(self.run[a]), int(self.run[b]), self.cap)

    def induce(self, stars: np.ndarray, prefixes: np.ndarray) -> tuple[list, list]:
        """The L and the S suffixes of each bucket, in order, with common prefixes.

        ``stars``: S* suffixes by bucket, and within it in order.
        """
        buckets = 257
        text = self.text
        bounds = np.searchsorted(text[stars], np.arange(buckets + 1))
        queue, carry, begun = BucketQueue(buckets, self.memory), np.zeros(buckets, np.int64), np.zeros(buckets, bool)
        lower: list = [None] * buckets
        for c in range(buckets):
            parts, last = [], None
            while (got := queue.take(c)) is not None:
                parts.append(got)
                last = int(got[0][-1])
                self._scan(queue, 0, got[0], got[1], carry, begun)
            lower[c] = np.concatenate(parts, axis=1) if parts else np.empty((2, 0), np.int32)
            own, pre = stars[bounds[c] : bounds[c + 1]], prefixes[bounds[c] : bounds[c + 1]].copy()
            if len(own):
                pre[0] = self._seam(last, int(own[0])) if last is not None else 0
                self._scan(queue, 0, own, pre, carry, begun)
        queue, carry, begun = BucketQueue(buckets, self.memory), np.zeros(buckets, np.int64), np.zeros(buckets, bool)
        upper: list = [None] * buckets
        for c in range(buckets - 1, 0, -1):
            parts, last = [], None
            while (got := queue.take(c)) is not None:
                parts.append(got)
                last = int(got[0][-1])
                self._scan(queue, 1, got[0], got[1], carry, begun)
            upper[c] = np.concatenate(parts, axis=1) if parts else np.empty((2, 0), np.int32)
            own = lower[c]
            if own.shape[1]:
                pre = np.r_[0, own[1][:0:-1]]
                suffix = own[0][::-1]
                pre[0] = self._seam(last, int(suffix[0])) if last is not None else 0
                self._scan(queue, 1, suffix, pre, carry, begun)
        upper[0] = np.empty((2, 0), np.int32)
        return lower, upper

    # -- S* suffixes

    def ordered_stars(self) -> np.ndarray:
        """S* suffixes in order: sort their substrings by induction, name them, rank the names."""
        stars, text = self.stars, self.text
        first = stars[np.argsort(text[stars], kind="stable")]
        self.prefixes = False
        _, upper = self.induce(first, np.zeros(len(first), np.int64))
        self.prefixes = True
        by_substring = np.concatenate([self.ends, *[u[0][::-1] for u in upper]])
        by_substring = by_substring[self.star[by_substring]]
        index = self.star_number[by_substring]
        following = np.r_[stars[1:], self.n - 1]
        a, b = by_substring[:-1], by_substring[1:]
        size_a, size_b = following[index[:-1]] - a, following[index[1:]] - b
        end = following[index[1:]]
        same = (size_a == size_b) & (text[end] > 0) & (text[following[index[:-1]]] > 0) & (text[a] > 0)
        check = np.flatnonzero(same)
        same[check] = self._equal(a[check], b[check], size_a[check] + 1)
        names = np.empty(len(stars), np.int64)
        names[index] = np.cumsum(np.r_[0, ~same])
        return stars[np.argsort(_ranked(names), kind="stable")]

    def _equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        alive, step = np.arange(len(a)), 0
        while len(alive):
            left = size[alive] - step
            shift = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
            bad = ((self.words[a[alive] + step] ^ self.words[b[alive] + step]) << shift) != 0
            out[alive[bad]] = False
            alive, step = alive[~bad & (left > 8)], step + 8
        return out

    # -- result

    def repeated(self) -> np.ndarray:
        """For each place of the text, whether ``cap`` bytes from it also start at another place."""
        stars = self.ordered_stars()
        prefixes = np.r_[0, self.common(stars[:-1], stars[1:])]
        prefixes[self.text[stars] == 0] = 0
        lower, upper = self.induce(stars, prefixes)
        out = np.zeros(self.n, bool)
        for c in range(1, 257):
            low, up = lower[c], upper[c]
            for part in (low, up):  # neighbours of one type; of S suffixes the order is reversed, which pairs the same
                hit = np.flatnonzero(part[1] >= self.cap)
                out[part[0][hit]] = True
                out[part[0][hit[hit > 0] - 1]] = True
            if low.shape[1] and up.shape[1]:
                a, b = int(low[0][-1]), int(up[0][-1])
                if self._seam(a, b) >= self.cap:
                    out[[a, b]] = True
        return out


def _ranked(names: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of a string of names, by doubling."""
    rank, n, step = names, len(names), 1
    while n and rank.max() < n - 1:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ranked[1:] != ranked[:-1]])
        step *= 2
    return rank
