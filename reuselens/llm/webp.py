"""Lossless WebP: an encoder and a decoder that work on many images at a time.

The decoder reads the container, the prefix codes (simple and normal), literal
pixels, back-references with the two-dimensional distance codes, the colour
cache and meta prefix codes, and inverts the predictor, cross-colour,
subtract-green and palette transforms. Images of a batch advance together, one
pixel a step, so a step is a few array operations for all of them; tables of
prefix codes that recur are parsed once.

The encoder writes literals, runs and colour-cache hits with one of three fixed
prefix-code profiles (whichever is shorter for an image), and on demand any of
the transforms. ``encode_best`` chooses for each image, by an estimate of its
bits, between no transform, subtract-green, and a predictor after either.

``store`` keeps a text as images of 12 pixels a row, four bytes a pixel, at
most ``TILE`` blocks of 576 bytes an image; ``features`` reads them back.

Edge cases: null and empty texts are one block of padding; a text longer than
a tile is several images, in order; equal texts have equal stored bytes; a
damaged stream raises; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 576
WIDTH = 12
TILE = 16
CACHE_BITS = 8
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
# Fixed values of the format: the order of code-length codes, and the offsets (x, y) of the 120 short distance codes.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3),
    (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3),
    (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5),
    (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7),
    (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7),
    (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6),
    (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
HASH = 0x1E35A7BD
_NEAR = np.array(NEAR, dtype=np.int64)


# -- prefix codes


def _codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes, bit-reversed for a stream that is read from the low end."""
    codes, code, last = np.zeros(len(lengths), np.int64), 0, 0
    for n, s in sorted((int(n), s) for s, n in enumerate(lengths) if n):
        code <<= n - last
        codes[s], last = int(f"{code:0{n}b}"[::-1], 2), n
        code += 1
    return codes


def _table(lengths: np.ndarray) -> np.ndarray:
    """Entry for each window of bits: length << 16 | symbol."""
    used = np.flatnonzero(lengths)
    if len(used) == 1:
        return np.array([used[0]], dtype=np.int64)
    if not len(used):
        return np.zeros(1, np.int64)
    if (2.0 ** -lengths[used]).sum() != 1:
        raise ValueError("a prefix code is not complete")
    width, codes = int(lengths.max()), _codes(lengths)
    out = np.zeros(1 << width, np.int64)
    for s in used:
        out[codes[s] :: 1 << lengths[s]] = int(lengths[s]) << 16 | int(s)
    return out


def _profile(name: str, cache: int) -> list[np.ndarray]:
    """Code lengths of green, red, blue, alpha and distance."""
    byte = np.ones(256, dtype=np.int64)
    if name == "prose":
        # how often a byte is met: lower case, space, marks of prose, then the rest of ASCII and of UTF-8
        byte[128:192] = 8
        for chars, n in (("abcdefghijklmnopqrstuvwxyz", 512), (" ", 1024), ("\n,.", 128), ("Ã", 256), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16)):
            byte[[ord(c) for c in chars]] = n
    if name == "steps":  # what a prediction leaves: none, or a little up or down
        byte[:] = 4
        for near, n in ((64, 16), (16, 64), (4, 256), (1, 2048)):
            byte[:near], byte[256 - near :] = n, n
        byte[0] = 16384
    byte *= 64
    total = int(byte.sum())
    same = _huffman_lengths(byte, 15)
    # an eighth of the pixels from the cache, few runs
    green = np.r_[byte, np.full(24, max(1, total >> 12)), np.full(cache, max(1, (total >> 3) // max(1, cache)))]
    distance = np.zeros(40, np.int64)
    distance[1] = 1
    return [_huffman_lengths(green, 15), same, same, same, distance]


PROFILES = ("prose", "flat", "steps")


# -- encoder


class _Tokens:
    """A list of (value, bits) for headers."""

    def __init__(self) -> None:
        self.items: list[tuple[int, int]] = []

    def put(self, value: int, bits: int) -> None:
        self.items.append((int(value), bits))

    def lengths(self, lengths: np.ndarray) -> None:
        """One prefix code."""
        used = np.flatnonzero(lengths)
        if len(used) == 1 and used[0] < 256:
            self.put(1, 1), self.put(0, 1), self.put(1, 1), self.put(used[0], 8)
            return
        runs, k = [], 0
        while k < len(lengths):
            n = 1
            while k + n < len(lengths) and lengths[k + n] == lengths[k]:
                n += 1
            value, left = int(lengths[k]), n
            if value:
                runs.append((value, 0, 0))
                left -= 1
                while left >= 3:
                    step = min(left, 6)
                    runs.append((16, step - 3, 2))
                    left -= step
            else:
                while left >= 3:
                    step = min(left, 138)
                    runs.append((17, step - 3, 3) if step < 11 else (18, step - 11, 7))
                    left -= step
            runs += [(value, 0, 0)] * left
            k += n
        weight = np.bincount([r[0] for r in runs], minlength=19)
        code = _huffman_lengths(weight, 7)
        self.put(0, 1), self.put(len(LENGTH_ORDER) - 4, 4)
        for s in LENGTH_ORDER:
            self.put(code[s], 3)
        self.put(0, 1)
        codes = _codes(code)
        single = np.count_nonzero(code) == 1
        for symbol, extra, bits in runs:
            if not single:
                self.put(codes[symbol], int(code[symbol]))
            if bits:
                self.put(extra, bits)


def _huffman_lengths(weight: np.ndarray, most: int) -> np.ndarray:
    """Lengths of at most ``most`` bits; small weights are raised until they fit."""
    used = np.flatnonzero(weight)
    out = np.zeros(len(weight), np.int64)
    if len(used) == 1:
        out[used] = 1
        return out
    floor = 1
    while True:
        heap = [(max(int(weight[s]), floor), int(s), (int(s),)) for s in used]
        heapq.heapify(heap)
        out[:] = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                out[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if out.max() <= most:
            return out
        floor *= 2


@lru_cache(maxsize=64)
def _coded(name: str, cache: int) -> tuple:
    """Lengths, codes and header tokens of a profile."""
    lengths = _profile(name, cache)
    head = _Tokens()
    for n in lengths:
        head.lengths(n)
    return lengths, [_codes(n) for n in lengths], head.items


def _length_symbol(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix symbol, extra bits and their number, of lengths of 1 and more."""
    v = n - 1
    top = np.maximum(np.floor(np.log2(np.maximum(v, 1))).astype(np.int64), 1)
    second = (v >> (top - 1)) & 1
    small = v < 2
    return np.where(small, v, 2 * top + second), np.where(small, 0, v & ((1 << (top - 1)) - 1)), np.where(small, 0, top - 1)


def _or_bits(words: np.ndarray, at: np.ndarray, value: np.ndarray, bits: np.ndarray) -> None:
    """Puts tokens, in order of their places, into a stream of 64-bit words."""
    keep = bits > 0
    at, value, bits = at[keep], value[keep].astype(np.uint64), bits[keep]
    if not len(at):
        return
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    words[word[first]] |= np.bitwise_or.reduceat(value << shift, first)
    over = np.flatnonzero((at & 63) + bits > 64)
    words[word[over] + 1] |= value[over] >> (np.uint64(64) - shift[over])  # at most one token crosses a word's end


def _encode_profile(pixels: np.ndarray, image: np.ndarray, n: int, name: str, cache_bits: int, lead: list[list[tuple[int, int]]]) -> list[tuple[np.ndarray, int]]:
    """The bits of each image: words and the number of bits. ``pixels`` are those of all images, one after the other."""
    lengths, codes, head = _coded(name, 1 << cache_bits if cache_bits else 0)
    g, r, b, a = ((pixels >> np.uint32(s) & np.uint32(255)).astype(np.int64) for s in (8, 16, 0, 24))
    start = np.r_[True, image[1:] != image[:-1]]
    same = np.r_[False, pixels[1:] == pixels[:-1]] & ~start
    bits = lengths[0][g] + lengths[1][r] + lengths[2][b] + lengths[3][a]
    value, at = codes[0][g], lengths[0][g]
    for k, channel in ((1, r), (2, b), (3, a)):
        value = value | codes[k][channel] << at
        at = at + lengths[k][channel]
    if cache_bits:
        slot = ((pixels * np.uint32(HASH)) >> np.uint32(32 - cache_bits)).astype(np.int64)
        key = image << cache_bits | slot
        order = np.argsort(key, kind="stable")
        hit = np.zeros(len(pixels), bool)
        hit[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (pixels[order[1:]] == pixels[order[:-1]])
        cached = 280 + slot
        hit &= lengths[0][cached] < bits
        value, bits = np.where(hit, codes[0][cached], value), np.where(hit, lengths[0][cached], bits)
    # Runs of a pixel: a back-reference to the pixel before, of at most 4096 pixels
    edge = np.flatnonzero(~same)
    size = np.diff(np.r_[edge, len(pixels)]) - 1
    for k in np.flatnonzero(size >= 3):
        for s in range(edge[k] + 1, edge[k] + 1 + size[k], 4096):
            e = min(s + 4096, edge[k] + 1 + size[k])
            symbol, extra, more = (int(x[0]) for x in _length_symbol(np.array([e - s])))
            code_bits = int(lengths[0][256 + symbol])
            value[s], bits[s] = int(codes[0][256 + symbol]) | extra << code_bits, code_bits + more
            bits[s + 1 : e] = 0
    total = np.bincount(image, weights=bits, minlength=n).astype(np.int64)
    heads = [lead[k] + head for k in range(n)]
    head_bits = np.array([sum(x[1] for x in h) for h in heads], dtype=np.int64)
    words = (head_bits + total + 63) // 64 + 1
    base = np.r_[0, np.cumsum(words)] * 64
    out = np.zeros(int(words.sum()), np.uint64)
    inner = np.cumsum(bits) - bits
    inner -= inner[np.flatnonzero(start)][image] if len(pixels) else 0
    _or_bits(out, base[image] + head_bits[image] + inner, value, bits)
    flat = [(v, w) for h in heads for v, w in h]
    hv, hw = np.array([x[0] for x in flat], dtype=np.int64), np.array([x[1] for x in flat], dtype=np.int64)
    owner = np.repeat(np.arange(n), [len(h) for h in heads])
    place = np.cumsum(hw) - hw
    place -= np.r_[0, np.cumsum(head_bits)][owner]
    _or_bits(out, base[owner] + place, hv, hw)
    return [(out[base[k] // 64 : base[k + 1] // 64], int(head_bits[k] + total[k])) for k in range(n)]


def _container(words: np.ndarray, bits: int) -> bytes:
    body = words.tobytes()[: (bits + 7) // 8]
    pad = b"\0" * (len(body) % 2)
    return b"RIFF" + struct.pack("<I", 12 + len(body) + len(pad)) + b"WEBPVP8L" + struct.pack("<I", len(body)) + body + pad


def encode(images: list[np.ndarray], cache_bits: int = CACHE_BITS, transforms: tuple[int, ...] = (), mode: int = 11) -> list[bytes]:
    """WebP files of images, given as arrays (height, width) of ARGB words."""
    lead, coded = [], []
    for image in images:
        head = _Tokens()
        h, w = image.shape
        head.put(0x2F, 8), head.put(w - 1, 14), head.put(h - 1, 14), head.put(1, 1), head.put(0, 3)
        for kind in transforms:
            image = _forward(kind, image, head, mode)
        head.put(0, 1)  # no more transforms
        head.put(1 if cache_bits else 0, 1)
        if cache_bits:
            head.put(cache_bits, 4)
        head.put(0, 1)  # one group of prefix codes
        lead.append(head.items)
        coded.append(image)
    flat = np.concatenate([c.ravel() for c in coded]).astype(np.uint32) if coded else np.empty(0, np.uint32)
    owner = np.repeat(np.arange(len(coded)), [c.size for c in coded])
    tries = [_encode_profile(flat, owner, len(coded), p, cache_bits, lead) for p in PROFILES] if coded else []
    return [_container(*min(options, key=lambda x: x[1])) for options in zip(*tries)]


#: Ways to store an image: transforms, in the order they are made, and the predictor's mode.
WAYS = (((), 0), ((SUBTRACT_GREEN,), 0), ((PREDICTOR,), 1), ((PREDICTOR,), 2), ((SUBTRACT_GREEN, PREDICTOR), 1), ((SUBTRACT_GREEN, PREDICTOR), 2))


def _residues(flat: np.ndarray, start: np.ndarray, width: int) -> list[np.ndarray]:
    """Pixels of all images, one after the other, in each of ``WAYS``; ``start`` is where the image of each pixel begins."""
    k = np.arange(len(flat))
    place = k - start
    green = flat.view(np.uint8).reshape(-1, 4).copy()
    green[:, 0] -= green[:, 1]
    green[:, 2] -= green[:, 1]
    bases = {(): flat, (SUBTRACT_GREEN,): green.view(np.uint32).ravel()}
    left, top = np.where(place % width > 0, k - 1, k - width), np.where(place >= width, k - width, k - 1)
    out = []
    for transforms, mode in WAYS:
        base = bases[transforms[:1] if transforms[:1] == (SUBTRACT_GREEN,) else ()]
        if PREDICTOR in transforms:
            guess = np.where(place > 0, base[np.maximum(left if mode == 1 else top, 0)], np.uint32(0xFF000000)).astype(np.uint32)
            base = (base.view(np.uint8) - guess.view(np.uint8)).view(np.uint32)
        out.append(base)
    return out


def encode_best(images: list[np.ndarray], cache_bits: int = CACHE_BITS) -> list[bytes]:
    """WebP files of images of one width, each with the transforms and the profile that take the fewest bits by an estimate."""
    if not images:
        return []
    width, n = images[0].shape[1], len(images)
    flat = np.concatenate([i.ravel() for i in images]).astype(np.uint32)
    sizes = np.array([i.size for i in images])
    owner = np.repeat(np.arange(n), sizes)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = np.cumsum(sizes) - sizes
    ways = _residues(flat, start, width)
    leads, bits = [], []
    for (transforms, mode), pixels in zip(WAYS, ways):
        heads: dict[int, list[tuple[int, int]]] = {}
        for h in sorted({i.shape[0] for i in images}):
            head = _Tokens()
            head.put(0x2F, 8), head.put(width - 1, 14), head.put(h - 1, 14), head.put(1, 1), head.put(0, 3)
            for kind in transforms:
                head.put(1, 1), head.put(kind, 2)
                if kind == PREDICTOR:
                    head.put(1, 3)
                    _sub_image(head, np.uint32(0xFF000000) | np.full((-(-h >> 3), -(-width >> 3)), mode, np.uint32) << np.uint32(8))
            head.put(0, 1), head.put(1, 1), head.put(cache_bits, 4), head.put(0, 1)
            heads[h] = head.items
        leads.append(heads)
        spent = np.array([sum(b for _, b in heads[i.shape[0]]) for i in images])
        new = np.r_[True, (pixels[1:] != pixels[:-1]) | (owner[1:] != owner[:-1])]  # runs are nearly free
        for name in PROFILES:
            lengths, _, items = _coded(name, 1 << cache_bits)
            byte = lengths[1][:256].astype(np.uint8)
            each = byte[pixels.view(np.uint8)].reshape(-1, 4).sum(axis=1) * new
            bits.append(np.add.reduceat(each, first) + spent + sum(b for _, b in items))
    chosen = np.argmin(bits, axis=0)
    out: list[bytes] = [b""] * n
    for c in np.unique(chosen).tolist():
        way, name = divmod(c, len(PROFILES))
        of = np.flatnonzero(chosen == c)
        taken = chosen[owner] == c
        lead = [leads[way][images[k].shape[0]] for k in of]
        for k, found in zip(of.tolist(), _encode_profile(ways[way][taken], np.repeat(np.arange(len(of)), sizes[of]), len(of), PROFILES[name], cache_bits, lead)):
            out[k] = _container(*found)
    return out


def _sub_image(head: _Tokens, image: np.ndarray) -> None:
    """A small image inside the stream: no cache, plain codes."""
    head.put(0, 1)
    lengths, codes, items = _coded("flat", 0)
    head.items += items
    for px in image.ravel().tolist():
        for k, s in ((0, 8), (1, 16), (2, 0), (3, 24)):
            head.put(codes[k][px >> s & 255], int(lengths[k][px >> s & 255]))


def _forward(kind: int, image: np.ndarray, head: _Tokens, mode: int) -> np.ndarray:
    head.put(1, 1), head.put(kind, 2)
    if kind == SUBTRACT_GREEN:
        g = image >> 8 & 255
        return _join(image >> 24, (image >> 16) - g, g, image - g)
    if kind == PALETTE:
        colours, index = np.unique(image, return_inverse=True)
        if len(colours) > 256:
            raise ValueError("a palette holds 256 colours at most")
        head.put(len(colours) - 1, 8)
        deltas = _channels(np.r_[colours[:1], colours[1:]]) - _channels(np.r_[np.uint32(0), colours[:-1]])
        _sub_image(head, _join(*deltas))
        shift = _bundle(len(colours))
        index, (h, w) = index.reshape(image.shape).astype(np.uint32), image.shape
        index = np.pad(index, ((0, 0), (0, -w % (1 << shift)))).reshape(h, -1, 1 << shift)
        packed = (index << (np.arange(1 << shift, dtype=np.uint32) * np.uint32(8 >> shift))).sum(axis=2).astype(np.uint32)
        return np.uint32(0xFF000000) | packed << np.uint32(8)
    size = 3
    head.put(size - 2, 3)
    h, w = image.shape
    blocks = (-(-h >> size), -(-w >> size))
    if kind == PREDICTOR:
        modes = np.full(blocks, mode, dtype=np.uint32)
        _sub_image(head, np.uint32(0xFF000000) | modes << np.uint32(8))
        planes, guess = _channels(image), _channels(image)
        for y in range(h):
            for x in range(w):
                guess[:, y, x] = _predict(planes, y, x, mode, w)
        return _join(*(planes - guess))
    elements = np.full(blocks, 0xFF000000 | 24 << 16 | 200 << 8 | 9, dtype=np.uint32)
    _sub_image(head, elements)
    a, r, g, b = _channels(image)
    to_blue_r, to_blue_g, to_red = 24, 200 - 256, 9
    return _join(a, r - (_signed8(g) * to_red >> 5), g, b - (_signed8(g) * to_blue_g >> 5) - (_signed8(r) * to_blue_r >> 5))


# -- pixels


def _channels(image: np.ndarray) -> np.ndarray:
    return np.stack([(image >> np.uint32(s) & np.uint32(255)).astype(np.int64) for s in (24, 16, 8, 0)])


def _join(a: np.ndarray, r: np.ndarray, g: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, r, g, b = (np.asarray(x).astype(np.int64) & 255 for x in (a, r, g, b))
    return (a << 24 | r << 16 | g << 8 | b).astype(np.uint32)


def _signed8(x: np.ndarray) -> np.ndarray:
    x = x & 255
    return x - ((x >> 7) << 8)


def _bundle(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def _predict(p: np.ndarray, y: int, x: int, mode: int, w: int) -> np.ndarray:
    """The four predicted channels of a pixel."""
    if y == 0 and x == 0:
        return np.array([255, 0, 0, 0])
    if y == 0:
        return p[:, y, x - 1]
    if x == 0:
        return p[:, y - 1, x]
    left, top, diagonal = p[:, y, x - 1], p[:, y - 1, x], p[:, y - 1, x - 1]
    right = p[:, y - 1, x + 1] if x + 1 < w else p[:, y, 0]
    if mode == 11:
        near_left = np.abs(top - diagonal).sum()  # how far the estimate left + top - diagonal is from left
        near_top = np.abs(left - diagonal).sum()
        return left if near_left < near_top else top
    if mode == 12:
        return np.clip(left + top - diagonal, 0, 255)
    if mode == 13:
        mean = left + top >> 1
        return np.clip(mean + np.trunc((mean - diagonal) / 2).astype(np.int64), 0, 255)
    simple = {
        1: lambda: left,
        2: lambda: top,
        3: lambda: right,
        4: lambda: diagonal,
        5: lambda: (left + right >> 1) + top >> 1,
        6: lambda: left + diagonal >> 1,
        7: lambda: left + top >> 1,
        8: lambda: diagonal + top >> 1,
        9: lambda: top + right >> 1,
        10: lambda: (left + diagonal >> 1) + (top + right >> 1) >> 1,
    }
    return simple[mode]() if mode in simple else np.array([255, 0, 0, 0])


# -- decoder


class _Bits:
    """A reader for headers."""

    def __init__(self, data: bytes, at: int = 0):
        self.value, self.at, self.end = int.from_bytes(data, "little"), at, 8 * len(data)

    def read(self, n: int) -> int:
        if self.at + n > self.end:
            raise ValueError("the stream ends early")
        out = self.value >> self.at & ((1 << n) - 1)
        self.at += n
        return out

    def symbol(self, table: np.ndarray) -> int:
        entry = int(table[(self.value >> self.at) & (len(table) - 1)])
        self.at += entry >> 16
        return entry & 0xFFFF

    def code(self, size: int) -> np.ndarray:
        """The table of one prefix code over ``size`` symbols."""
        lengths = np.zeros(size, np.int64)
        if self.read(1):
            both, wide = self.read(1), self.read(1)
            lengths[self.read(8 if wide else 1)] = 1
            if both:
                lengths[self.read(8)] = 1
            return _table(lengths)
        own = np.zeros(19, np.int64)
        for s in LENGTH_ORDER[: 4 + self.read(4)]:
            own[s] = self.read(3)
        left = size
        if self.read(1):
            left = 2 + self.read(2 + 2 * self.read(3))
        table, k, last = _table(own), 0, 8
        while k < size and left:
            left -= 1
            s = self.symbol(table)
            if s < 16:
                lengths[k], k = s, k + 1
                last = s or last
            else:
                value, n = (last, 3 + self.read(2)) if s == 16 else (0, 3 + self.read(3)) if s == 17 else (0, 11 + self.read(7))
                if k + n > size:
                    raise ValueError("a prefix code is too long")
                lengths[k : k + n], k = value, k + n
        return _table(lengths)


class _Image:
    """What the header of one image tells: transforms, cache, code groups, and where the pixels begin."""

    def __init__(self, bits: _Bits, width: int, height: int, inner: bool):
        self.width, self.height, self.transforms = width, height, []
        while not inner and bits.read(1):
            kind = bits.read(2)
            if kind in [t[0] for t in self.transforms]:
                raise ValueError("a transform comes twice")
            if kind in (PREDICTOR, CROSS_COLOUR):
                size = bits.read(3) + 2
                self.transforms.append((kind, size, _inner_image(bits, -(-self.width >> size), -(-height >> size)), self.width))
            elif kind == PALETTE:
                n = bits.read(8) + 1
                table = np.cumsum(_channels(_inner_image(bits, n, 1)[0]), axis=1)
                self.transforms.append((kind, _bundle(n), _join(*table), self.width))
                self.width = -(-self.width >> _bundle(n))
            else:
                self.transforms.append((kind, 0, None, self.width))
        self.cache_bits = bits.read(4) if bits.read(1) else 0
        self.meta_bits, self.meta = 0, None
        if not inner and bits.read(1):
            self.meta_bits = bits.read(3) + 2
            found = _inner_image(bits, -(-self.width >> self.meta_bits), -(-height >> self.meta_bits))
            self.meta = (found >> np.uint32(8) & np.uint32(0xFFFF)).astype(np.int64)
        groups = 1 if self.meta is None else int(self.meta.max()) + 1
        extra = 1 << self.cache_bits if self.cache_bits else 0
        self.groups = [[bits.code(n) for n in (280 + extra, 256, 256, 256, 40)] for _ in range(groups)]
        self.at = bits.at


def _inner_image(bits: _Bits, width: int, height: int) -> np.ndarray:
    image = _Image(bits, width, height, True)
    data = bits.value.to_bytes(bits.end // 8, "little")
    pixels, ends = _pixels([data], [image])
    bits.at = int(ends[0])
    return pixels[0].reshape(height, width)


class _Headers:
    """Headers met before, by their bits: each is parsed once."""

    def __init__(self, most: int = 64):
        self.known: dict[tuple[int, int], list[tuple[int, int, _Image]]] = {}
        self.most = most

    def parse(self, body: bytes, width: int, height: int) -> _Image:
        start = int.from_bytes(body[5:1029], "little")
        for size, value, image in self.known.get((width, height), ()):
            if start & ((1 << size) - 1) == value:
                return image
        image = _Image(_Bits(body, 40), width, height, False)
        size = image.at - 40
        if not image.transforms and image.meta is None and size <= 8 * 1024:
            held = self.known.setdefault((width, height), [])
            if len(held) < self.most:
                held.append((size, start & ((1 << size) - 1), image))
        return image


def _pixels(bodies: list[bytes], images: list[_Image]) -> tuple[list[np.ndarray], np.ndarray]:
    """The pixels of all images, advancing together, and the bit after each."""
    n = len(bodies)
    count = np.array([i.width * i.height for i in images], dtype=np.int64)
    order = np.argsort(-count, kind="stable")
    count = count[order]
    images = [images[k] for k in order]
    sizes = np.array([len(bodies[k]) + 16 for k in order], dtype=np.int64)
    buffer = np.frombuffer(b"".join(bodies[k] + bytes(16) for k in order) + bytes(16), dtype=np.uint8)
    window = np.ndarray((len(buffer) - 8,), dtype="<u8", buffer=buffer, strides=(1,))
    first = np.r_[0, np.cumsum(sizes)[:-1]] * 8
    limit = first + 8 * (sizes - 16)
    pos = first + np.array([i.at for i in images], dtype=np.int64)
    width = np.array([i.width for i in images], dtype=np.int64)
    cache_bits = np.array([i.cache_bits for i in images], dtype=np.int64)
    # Tables of all groups, one after the other; equal groups once
    bases, masks, tables, seen, group = [], [], [], {}, np.zeros(n, np.int64)
    at = 0
    for k, i in enumerate(images):
        if id(i) not in seen:
            seen[id(i)] = len(bases)
            for codes in i.groups:
                bases.append([])
                masks.append([len(c) - 1 for c in codes])
                for c in codes:
                    bases[-1].append(at)
                    tables.append(c)
                    at += len(c)
        group[k] = seen[id(i)]
    base, mask, table = np.array(bases), np.array(masks, dtype=np.uint64), np.concatenate(tables)
    metas = any(i.meta is not None for i in images)
    out = np.zeros((n, int(count[0]) if n else 0), dtype=np.uint32)
    cache = np.zeros((n, 1 << int(cache_bits.max())), dtype=np.uint32)
    hash_shift = (32 - cache_bits).astype(np.uint32)
    left, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    now = group.copy()

    def bits_at(rows: np.ndarray) -> np.ndarray:
        p = pos[rows]
        return window[p >> 3] >> (p & 7).astype(np.uint64)

    def symbol(rows: np.ndarray, k: int) -> np.ndarray:
        g = now[rows]
        entry = table[base[g, k] + (bits_at(rows) & mask[g, k]).astype(np.int64)]
        pos[rows] += entry >> 16
        return entry & 0xFFFF

    def counted(rows: np.ndarray, s: np.ndarray) -> np.ndarray:
        """A length or distance from its prefix symbol."""
        extra = np.maximum(s - 2, 0) >> 1
        more = (bits_at(rows) & ((np.uint64(1) << extra.astype(np.uint64)) - np.uint64(1))).astype(np.int64)
        pos[rows] += extra
        return np.where(s < 4, s + 1, ((2 + (s & 1)) << extra) + more + 1)

    active = n
    for p in range(out.shape[1]):
        while active and count[active - 1] <= p:
            active -= 1
        busy = left[:active] > 0
        rows = np.flatnonzero(~busy)
        if len(rows):
            if metas:
                for k in rows:
                    i = images[k]
                    if i.meta is not None:
                        now[k] = group[k] + i.meta[p // i.width >> i.meta_bits, p % i.width >> i.meta_bits]
            green = symbol(rows, 0)
            plain = green < 256
            some = rows[plain]
            if len(some):
                red = symbol(some, 1)
                blue = symbol(some, 2)
                alpha = symbol(some, 3)
                out[some, p] = (alpha << 24 | red << 16 | green[plain] << 8 | blue).astype(np.uint32)
            if len(some) < len(rows):
                cached = green >= 280
                held = rows[cached]
                if len(held):
                    out[held, p] = cache[held, green[cached] - 280]
                back = ~plain & ~cached
                some = rows[back]
                if len(some):
                    left[some] = counted(some, green[back] - 256)
                    d = counted(some, symbol(some, 4))
                    near = _NEAR[np.minimum(d, 120) - 1]
                    distance[some] = np.where(d > 120, d - 120, np.maximum(near[:, 0] + near[:, 1] * width[some], 1))
                    if (distance[some] > p).any() or (left[some] + p > count[some]).any():
                        raise ValueError("a back-reference leaves the image")
                    busy[some] = True
        if busy.any():
            rows = np.flatnonzero(busy)
            out[rows, p] = out[rows, p - distance[rows]]
            left[rows] -= 1
        if cache.shape[1] > 1:
            px = out[:active, p]
            slot = (px * np.uint32(HASH)) >> np.minimum(hash_shift[:active], np.uint32(31))
            cache[np.arange(active), np.where(cache_bits[:active] > 0, slot, 0)] = px
    if (pos > limit).any():
        raise ValueError("the stream ends early")
    result, ends = [None] * n, np.zeros(n, np.int64)
    for k, j in enumerate(order):
        result[j] = out[k, : count[k]]
        ends[j] = pos[k] - first[k]
    return result, ends


def _invert(image: np.ndarray, kind: int, size: int, data: np.ndarray | None, width: int) -> np.ndarray:
    if kind == SUBTRACT_GREEN:
        a, r, g, b = _channels(image)
        return _join(a, r + g, g, b + g)
    if kind == PALETTE:
        index = (image >> np.uint32(8) & np.uint32(255)).astype(np.int64)
        step = 8 >> size
        index = (index[:, :, None] >> (np.arange(1 << size) * step) & ((1 << step) - 1)).reshape(len(image), -1)[:, :width]
        return np.where(index < len(data), data[np.minimum(index, len(data) - 1)], np.uint32(0)).astype(np.uint32)
    h, w = image.shape
    blocks = np.repeat(np.repeat(data, 1 << size, axis=0)[:h], 1 << size, axis=1)[:, :w]
    if kind == CROSS_COLOUR:
        _, to_blue_r, to_blue_g, to_red = (_signed8(c) for c in _channels(blocks))
        a, r, g, b = _channels(image)
        r = (r + (to_red * _signed8(g) >> 5)) & 255
        b = b + (to_blue_g * _signed8(g) >> 5) + (to_blue_r * _signed8(r) >> 5)
        return _join(a, r, g, b)
    modes = (blocks >> np.uint32(8) & np.uint32(15)).astype(np.int64)
    planes = _channels(image)
    if modes.min() == modes.max() and modes[0, 0] in (1, 2):  # sums along rows and columns
        planes[0, 0, 0] += 255
        line = 2 if modes[0, 0] == 1 else 1
        edge = planes[:, :, 0] if line == 2 else planes[:, 0]
        edge[:] = np.cumsum(edge, axis=1)
        return _join(*np.cumsum(planes, axis=line))
    for y in range(h):
        for x in range(w):
            planes[:, y, x] = (planes[:, y, x] + _predict(planes, y, x, int(modes[y, x]), w)) & 255
    return _join(*planes)


def split_files(data: bytes) -> list[bytes]:
    """WebP files that lie one after the other."""
    out, at = [], 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF":
            raise ValueError("not a RIFF container")
        size = 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        out.append(data[at : at + size])
        at += size
    return out


def decode(files: list[bytes], headers: _Headers | None = None) -> list[np.ndarray]:
    """Arrays (height, width) of ARGB words."""
    headers = headers or _Headers()
    bodies, images, shapes = [], [], []
    for f in files:
        if f[:4] != b"RIFF" or f[8:16] != b"WEBPVP8L":
            raise ValueError("not a lossless WebP file")
        body = f[20 : 20 + int.from_bytes(f[16:20], "little")]
        dims = int.from_bytes(body[1:5], "little")
        if body[:1] != b"\x2f" or dims >> 29:
            raise ValueError("not a lossless WebP stream")
        width, height = (dims & 0x3FFF) + 1, (dims >> 14 & 0x3FFF) + 1
        bodies.append(body)
        images.append(headers.parse(body, width, height))
        shapes.append((height, width))
    found, _ = _pixels(bodies, images) if files else ([], None)
    out = []
    for flat, i, (h, w) in zip(found, images, shapes):
        image = flat.reshape(h, i.width)
        for kind, size, data, width in reversed(i.transforms):
            image = _invert(image, kind, size, data, width)
        out.append(image)
    return out


# -- texts as media


def payload(text: str | None) -> bytes:
    """UTF-8 with bytes 255 up to a positive multiple of a block."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % BLOCK if raw else BLOCK)


def _tiles(data: bytes) -> list[np.ndarray]:
    step = TILE * BLOCK
    return [np.frombuffer(data[k : k + step], dtype="<u4").reshape(-1, WIDTH) for k in range(0, len(data), step)]


def _chunks(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of a column."""
    start, held = 0, 0
    for k, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        if held and held + (n or 0) > most:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, media)``; media are WebP files, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for whole in batches:
            for b in _chunks(whole, 1, 4 << 20):
                texts = b.column(1).to_pylist()
                tiles = [_tiles(payload(t)) for t in texts]
                files = iter(encode_best([x for t in tiles for x in t]))
                media = [b"".join(next(files) for _ in t) for t in tiles]
                sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def read_pixels(stored: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, media, pixels)``: the samples of each document's images, read from the stored bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        headers = _Headers()
        for whole in batches:
            for b in _chunks(whole, 2, 3 << 20):
                files = [split_files(m) for m in b.column(2).to_pylist()]
                images = iter(decode([f for x in files for f in x], headers))
                pixels = [b"".join(next(images).tobytes() for _ in x) for x in files]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pixels, pa.binary())], names=["doc_id", "n_bytes", "media", "pixels"])

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, media binary, pixels binary")


def features(pixels: DataFrame) -> DataFrame:
    """Digests and a feature of the samples: size, and for each channel the mean and the mean step to the next pixel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, n, media, px in zip(*(b.column(k).to_pylist() for k in range(4))):
                raw = px
                samples = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 4)
                mean, step = samples.mean(axis=0), np.abs(np.diff(samples.astype(np.int16), axis=0)).mean(axis=0)
                feature = f"{WIDTH}x{len(samples) // WIDTH};" + ",".join(f"{x:.3f}" for x in (*mean, *step))
                out.append((doc, n, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds)], names=names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return pixels.mapInArrow(run, schema)
