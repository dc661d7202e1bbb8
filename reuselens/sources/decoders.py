"""Pixels of encoded images: PNG, JPEG (baseline and progressive) and binary pixmaps, as height x width x RGB.

Anything else, and anything damaged (a wrong check sum, missing data, an
undefined code), is None: no partial picture is given. Transparency is left
out, sixteen bits become eight, and four-colour JPEG isn't read.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array

import numpy as np


def portable_pixels(content: bytes) -> np.ndarray | None:
    """A binary pixmap (P6, 8 bits) as an array of height, width and three channels; None for anything else."""
    parts = content[:64].split(None, 4)
    if len(parts) < 5 or parts[0] != b"P6" or parts[3] != b"255":
        return None
    w, h = int(parts[1]), int(parts[2])
    data = content[len(content) - 3 * w * h :]
    return np.frombuffer(data, np.uint8).reshape(h, w, 3) if len(data) == 3 * w * h else None


def any_pixels(content: bytes) -> np.ndarray | None:
    """The picture in a file of any known kind, told by its first bytes; None where there is none."""
    kinds = ((b"\x89PNG\r\n\x1a\n", png_pixels), (b"\xff\xd8\xff", jpeg_pixels), (b"P6", portable_pixels))
    decode = next((f for head, f in kinds if content.startswith(head)), None)
    try:
        return decode(content) if decode else None
    except (ValueError, IndexError, KeyError, TypeError, struct.error, zlib.error):
        return None


# -- PNG

# Samples a pixel by colour type, and the seven passes (first column and row, steps).
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))


def _unfiltered(data: bytes, rows: int, width: int, step: int) -> np.ndarray:
    """Rows of ``width`` bytes from filtered ones; ``step`` bytes are one pixel."""
    if len(data) < rows * (width + 1):
        raise ValueError("missing rows")
    lines = np.frombuffer(data, np.uint8, rows * (width + 1)).reshape(rows, width + 1)
    out = np.zeros((rows + 1, width), np.uint8)
    for r, (kind, line) in enumerate(zip(lines[:, 0].tolist(), lines[:, 1:])):
        above = out[r]
        if kind == 0:
            out[r + 1] = line
        elif kind == 1:
            padded = np.pad(line, (0, -width % step)).reshape(-1, step)
            out[r + 1] = np.add.accumulate(padded, axis=0, dtype=np.uint8).ravel()[:width]
        elif kind == 2:
            out[r + 1] = line + above
        elif kind in (3, 4):
            up, own = above.tolist(), line.tolist()
            for i in range(width):
                left, corner = (own[i - step], up[i - step]) if i >= step else (0, 0)
                if kind == 3:
                    own[i] = (own[i] + (left + up[i] >> 1)) & 255
                else:
                    to_left, to_up, to_corner = abs(up[i] - corner), abs(left - corner), abs(left + up[i] - 2 * corner)
                    near = left if to_left <= to_up and to_left <= to_corner else up[i] if to_up <= to_corner else corner
                    own[i] = (own[i] + near) & 255
            out[r + 1] = own
        else:
            raise ValueError("no such filter")
    return out[1:]


def png_pixels(content: bytes) -> np.ndarray:
    at, header, palette, packed, ended = 8, None, None, [], False
    while at < len(content) and not ended:
        size, kind = struct.unpack_from(">I4s", content, at)
        body = content[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", content, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError("check sum")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if header is None or not ended:
        raise ValueError("no end")
    w, h, depth, colour, _, _, laced = header
    samples = _SAMPLES[colour]
    if h * w * samples * depth > 8 * 1040 * len(content):
        raise ValueError("more than packed bytes can hold")
    data = zlib.decompress(b"".join(packed))
    step = max(1, samples * depth // 8)

    def part(data: bytes, rows: int, columns: int) -> np.ndarray:
        raw = _unfiltered(data, rows, -(-columns * samples * depth // 8), step)
        if depth == 16:
            return raw[:, ::2].reshape(rows, columns, samples)
        if depth < 8:
            bits = np.unpackbits(raw, axis=1).reshape(rows, -1, depth)
            raw = (bits << np.arange(depth)[::-1].astype(np.uint8)).sum(axis=2, dtype=np.uint8)
        return raw[:, : columns * samples].reshape(rows, columns, samples)

    if laced:
        out = np.zeros((h, w, samples), np.uint8)
        for x, y, dx, dy in _PASSES:
            rows, columns = -(-(h - y) // dy) if h > y else 0, -(-(w - x) // dx) if w > x else 0
            if rows and columns:
                out[y::dy, x::dx] = part(data, rows, columns)
                data = data[rows * (1 + -(-columns * samples * depth // 8)) :]
    else:
        out = part(data, h, w)
    if colour == 3:
        return palette[out[..., 0]]
    if depth < 8:
        out = out * np.uint8(255 // ((1 << depth) - 1))
    return np.repeat(out[..., :1], 3, axis=2) if colour in (0, 4) else np.ascontiguousarray(out[..., :3])


# -- JPEG

_ZIGZAG = np.array(sorted(range(64), key=lambda k: (k // 8 + k % 8, k // 8 if (k // 8 + k % 8) % 2 else k % 8))).tolist()
_COSINES = np.array([[np.cos((2 * n + 1) * k * np.pi / 16) * (np.sqrt(0.5) if k == 0 else 1) / 2 for n in range(8)] for k in range(8)])


def _codes(counts: bytes, symbols: bytes) -> list[int]:
    """For each sixteen bits the length and the symbol of the code they begin with; 0 where there is none."""
    table, code, at = np.zeros(1 << 16, np.int64), 0, 0
    for length, n in enumerate(counts, 1):
        for symbol in symbols[at : at + n]:
            table[code << 16 - length : code + 1 << 16 - length] = length << 8 | symbol
            code += 1
        at, code = at + n, code << 1
    return table.tolist()


class _Bits:
    """Codes and numbers out of one run of entropy-coded bytes."""

    def __init__(self, data: bytes) -> None:
        data = data.replace(b"\xff\x00", b"\xff")
        self.p, self.end = 0, 8 * len(data)
        d = np.frombuffer(data + b"\xff" * 8, np.uint8).astype(np.int64)
        self.w = array("q", (d[:-4] << 32 | d[1:-3] << 24 | d[2:-2] << 16 | d[3:-1] << 8 | d[4:]).tobytes())

    def number(self, size: int) -> int:
        p = self.p
        self.p = p + size
        return self.w[p >> 3] >> 40 - (p & 7) - size & (1 << size) - 1

    def symbol(self, table: list[int]) -> int:
        p = self.p
        found = table[self.w[p >> 3] >> 24 - (p & 7) & 0xFFFF]
        if not found:
            raise ValueError("no such code")
        self.p = p + (found >> 8)
        return found & 255

    def signed(self, size: int) -> int:
        if not size:
            return 0
        v = self.number(size)
        return v if v >> size - 1 else v - (1 << size) + 1


def _sequential(bits: _Bits, c: array, at: int, state: dict, which: int, dc: list[int], ac: list[int]) -> None:
    """All 64 coefficients of one block."""
    state[which] = c[at] = state.get(which, 0) + bits.signed(bits.symbol(dc))
    k, w, p = 1, bits.w, bits.p
    while k < 64:
        found = ac[w[p >> 3] >> 24 - (p & 7) & 0xFFFF]
        if not found:
            raise ValueError("no such code")
        p += found >> 8
        run, size = found >> 4 & 15, found & 15
        if size:
            k += run
            v = w[p >> 3] >> 40 - (p & 7) - size & (1 << size) - 1
            p += size
            c[at + _ZIGZAG[k]] = v if v >> size - 1 else v - (1 << size) + 1
            k += 1
        elif run == 15:
            k += 16
        else:
            break
    bits.p = p


def _first_run(bits: _Bits, c: array, at: int, state: dict, ac: list[int], start: int, stop: int, shift: int) -> None:
    """The upper bits of coefficients ``start`` to ``stop`` of one block."""
    if state.get("ends", 0):
        state["ends"] -= 1
        return
    k = start
    while k <= stop:
        found = bits.symbol(ac)
        run, size = found >> 4, found & 15
        if size:
            k += run
            c[at + _ZIGZAG[k]] = bits.signed(size) * (1 << shift)
            k += 1
        elif run == 15:
            k += 16
        else:
            state["ends"] = (1 << run) - 1 + (bits.number(run) if run else 0)
            return


def _next_bit(bits: _Bits, c: array, at: int, state: dict, ac: list[int], start: int, stop: int, shift: int) -> None:
    """One more bit of coefficients ``start`` to ``stop`` of one block."""
    one, k = 1 << shift, start

    def sharper(i: int) -> None:
        if bits.number(1) and not abs(c[i]) & one:
            c[i] += one if c[i] > 0 else -one

    if not state.get("ends", 0):
        while k <= stop:
            found = bits.symbol(ac)
            run, size = found >> 4, found & 15
            new = 0
            if size:
                new = one if bits.number(1) else -one
            elif run < 15:
                state["ends"] = (1 << run) + (bits.number(run) if run else 0)
                break
            while k <= stop:
                i = at + _ZIGZAG[k]
                k += 1
                if c[i]:
                    sharper(i)
                elif run:
                    run -= 1
                else:
                    if new:
                        c[i] = new
                    break
    if state.get("ends", 0):
        for z in range(k, stop + 1):
            if c[at + _ZIGZAG[z]]:
                sharper(at + _ZIGZAG[z])
        state["ends"] -= 1


def _entropy_end(content: bytes, at: int) -> int:
    """Where the coded bytes that begin at ``at`` end: at the next marker that isn't a restart."""
    found = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]").search(content, at)
    if not found:
        raise ValueError("no end")
    return found.start()


def _doubled(a: np.ndarray, both: bool) -> np.ndarray:
    """Twice as wide (and as high), each sample three parts of the nearest and one of the next one over."""
    a = a.astype(np.int32)
    if both:
        above, below = np.concatenate([a[:1], a[:-1]]), np.concatenate([a[1:], a[-1:]])
        a = np.stack([3 * a + above, 3 * a + below], axis=1).reshape(-1, a.shape[1])
    left, right = np.concatenate([a[:, :1], a[:, :-1]], axis=1), np.concatenate([a[:, 1:], a[:, -1:]], axis=1)
    up, down, parts = (8, 7, 4) if both else (1, 2, 2)
    return np.stack([3 * a + left + up >> parts, 3 * a + right + down >> parts], axis=2).reshape(len(a), -1)


def jpeg_pixels(content: bytes) -> np.ndarray:
    at, tables, quant, frame, interval, adobe, progressive, coefficients = 2, {}, {}, None, 0, None, False, []
    while True:
        while content[at] == 0xFF and content[at + 1] == 0xFF:
            at += 1
        if content[at] != 0xFF:
            raise ValueError("no marker")
        marker = content[at + 1]
        if marker == 0xD9:
            break
        size = struct.unpack_from(">H", content, at + 2)[0]
        body, at = content[at + 4 : at + 2 + size], at + 2 + size
        if at > len(content):
            raise ValueError("no end")
        if marker == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                quant[body[0] & 15] = np.frombuffer(body, ">u2" if wide == 2 else np.uint8, 64, 1).astype(np.float64)
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _codes(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xEE and body[:5] == b"Adobe":
            adobe = body[11]
        elif marker in (0xC0, 0xC1, 0xC2):
            depth, h, w, n = struct.unpack_from(">BHHB", body)
            parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
            if depth != 8 or n not in (1, 3) or not h or not w or frame:
                raise ValueError("not a picture of this kind")
            progressive, most = marker == 0xC2, (max(p[1] for p in parts), max(p[2] for p in parts))
            across, down = -(-w // (8 * most[0])), -(-h // (8 * most[1]))
            frame = h, w, parts, most, across, down
            if sum(across * p[1] * down * p[2] for p in parts) > 8 * len(content):
                raise ValueError("fewer bits than blocks")
            coefficients = [array("i", bytes(256 * across * p[1] * down * p[2])) for p in parts]
        elif marker in (0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xD0)):
            raise ValueError("not a picture of this kind")
        elif marker == 0xDA:
            end = _entropy_end(content, at)
            _scan(body, content[at:end], frame, coefficients, tables, interval, progressive)
            at = end
    h, w, parts, most, across, down = frame
    planes = []
    for c, (_, x, y, table) in zip(coefficients, parts):
        scale = np.empty(64)
        scale[_ZIGZAG] = quant[table]
        blocks = (np.frombuffer(c, np.int32).reshape(-1, 64) * scale).reshape(-1, 8, 8)
        values = np.rint(_COSINES.T @ blocks @ _COSINES + 128).clip(0, 255)
        plane = values.reshape(down * y, across * x, 8, 8).swapaxes(1, 2).reshape(down * y * 8, across * x * 8)
        plane = plane[: -(-h * y // most[1]), : -(-w * x // most[0])]
        wide, high = most[0] // x, most[1] // y
        if (wide, high) in ((2, 1), (2, 2)) and plane.shape[1] > 2:
            plane = _doubled(plane, high == 2)
        else:
            plane = plane.repeat(high, axis=0).repeat(wide, axis=1)
        planes.append(plane[:h, :w].astype(np.float64))
    if len(planes) == 1:
        return np.repeat(planes[0][..., None], 3, axis=2).astype(np.uint8)
    if adobe == 0 or (adobe is None and bytes(p[0] for p in parts) == b"RGB"):
        return np.stack(planes, axis=2).astype(np.uint8)
    y, blue, red = planes[0], planes[1] - 128, planes[2] - 128
    rgb = np.stack([y + 1.402 * red, y - 0.344136286 * blue - 0.714136286 * red, y + 1.772 * blue], axis=2)
    return np.rint(rgb).clip(0, 255).astype(np.uint8)


def _scan(head: bytes, data: bytes, frame: tuple, coefficients: list[array], tables: dict, interval: int, progressive: bool) -> None:
    """Adds one scan to the coefficients."""
    h, w, parts, most, across, down = frame
    names = [p[0] for p in parts]
    chosen = [(names.index(head[1 + 2 * k]), head[2 + 2 * k] >> 4, head[2 + 2 * k] & 15) for k in range(head[0])]
    start, stop, bits_ = head[1 + 2 * head[0] : 4 + 2 * head[0]]
    high, low = bits_ >> 4, bits_ & 15
    if len(chosen) == 1:
        which = chosen[0][0]
        _, x, y, _ = parts[which]
        rows, columns = -(-(-(-h * y // most[1])) // 8), -(-(-(-w * x // most[0])) // 8)
        units = [[(which, 64 * (r * across * x + c))] for r in range(rows) for c in range(columns)]
    else:
        inside = [(k, x, v, u) for k, _, _ in chosen for _, x, y, _ in (parts[k],) for v in range(y) for u in range(x)]
        rise = {k: parts[k][2] for k, _, _ in chosen}
        units = [[(k, 64 * ((r * rise[k] + v) * across * x + c * x + u)) for k, x, v, u in inside] for r in range(down) for c in range(across)]
    used = {k: (tables.get(dc), tables.get(16 + ac)) for k, dc, ac in chosen}
    runs = re.split(rb"\xff+[\xd0-\xd7]", data) if interval else [data]
    step = interval or len(units)
    if len(runs) != -(-len(units) // step):
        raise ValueError("missing runs")
    for k, run in enumerate(runs):
        bits, state = _Bits(run), {}
        for unit in units[k * step : (k + 1) * step]:
            for which, at in unit:
                c, (dc, ac) = coefficients[which], used[which]
                if not progressive:
                    _sequential(bits, c, at, state, which, dc, ac)
                elif start == 0 and high == 0:
                    state[which] = state.get(which, 0) + bits.signed(bits.symbol(dc))
                    c[at] = state[which] * (1 << low)
                elif start == 0:
                    c[at] |= bits.number(1) << low
                else:
                    (_next_bit if high else _first_run)(bits, c, at, state, ac, start, stop, low)
            if bits.p > bits.end:
                raise ValueError("missing data")
