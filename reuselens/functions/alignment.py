"""Laying one image onto another: corners, oriented binary descriptors, cross-checked matches, a robust homography and a warp.

Arrays only; an image is height, width and three channels of bytes. Everything
random is seeded, so two images always give the same result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# The circle of sixteen pixels (right, down), least contrast of a corner, and how many of the sixteen in a row it takes.
_CIRCLE = ((0, -3), (1, -3), (2, -2), (3, -1), (3, 0), (3, 1), (2, 2), (1, 3), (0, 3), (-1, 3), (-2, 2), (-3, 1), (-3, 0), (-3, -1), (-2, -2), (-1, -3))
_CONTRAST, _ROW = 20, 9
#: Half the side of the patch that a descriptor looks at, and the pyramid of smaller images.
_PATCH, _LEVELS, _STEP = 15, 8, 1.2
#: Inliers a homography needs, in number and as a share of the matches, and how far off they may be.
MIN_INLIERS, MIN_SHARE, REACH = 12, 0.25, 5.0


def _pattern() -> np.ndarray:
    """256 pairs of places within the patch."""
    rng = np.random.default_rng(256)
    found = rng.normal(0, (2 * _PATCH + 1) / 5, (4096, 2, 2))
    return found[(np.hypot(found[..., 0], found[..., 1]) < _PATCH).all(axis=1)][:256]


_PAIRS = _pattern()
_DISC = np.array([(x, y) for y in range(-_PATCH, _PATCH + 1) for x in range(-_PATCH, _PATCH + 1) if x * x + y * y <= _PATCH * _PATCH])


def sampled(image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values at places between pixels, linear in both directions; the border goes on outside."""
    h, w = image.shape[:2]
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    left, top = np.floor(x).astype(int), np.floor(y).astype(int)
    right, low = np.minimum(left + 1, w - 1), np.minimum(top + 1, h - 1)
    fx, fy = x - left, y - top
    if image.ndim == 3:
        fx, fy = fx[..., None], fy[..., None]
    upper = image[top, left] * (1 - fx) + image[top, right] * fx
    return upper * (1 - fy) + (image[low, left] * (1 - fx) + image[low, right] * fx) * fy


def resized(image: np.ndarray, h: int, w: int) -> np.ndarray:
    y, x = np.meshgrid((np.arange(h) + 0.5) * image.shape[0] / h - 0.5, (np.arange(w) + 0.5) * image.shape[1] / w - 0.5, indexing="ij")
    return sampled(image, x, y)


def _box(a: np.ndarray, side: int) -> np.ndarray:
    """Means over squares; the border goes on outside."""
    half = side // 2
    padded = np.pad(a, half, mode="edge")
    s = np.pad(padded.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    return (s[side:, side:] - s[:-side, side:] - s[side:, :-side] + s[:-side, :-side]) / (side * side)


def corners(gray: np.ndarray, most: int) -> np.ndarray:
    """``(x, y)`` of the strongest corners: nine of sixteen pixels around in a row are all brighter or all darker; each is the strongest of its neighbours."""
    h, w = gray.shape
    edge = _PATCH + 1
    if h <= 2 * edge or w <= 2 * edge:
        return np.empty((0, 2), int)
    inner = gray[3:-3, 3:-3]
    around = [gray[3 + dy : h - 3 + dy, 3 + dx : w - 3 + dx] - inner for dx, dy in _CIRCLE]
    found = np.zeros(inner.shape, bool)
    for sign in (1, -1):
        bits = sum((sign * d > _CONTRAST).astype(np.uint32) << k for k, d in enumerate(around))
        bits |= bits << 16
        two = bits & bits >> 1
        four = two & two >> 2
        found |= (four & four >> 4 & bits >> (_ROW - 1) & 0xFFFF) != 0
    dy, dx = np.gradient(gray)
    xx, yy, xy = _box(dx * dx, 7), _box(dy * dy, 7), _box(dx * dy, 7)
    strength = xx * yy - xy * xy - 0.04 * (xx + yy) ** 2
    own = np.full(gray.shape, -np.inf)
    own[3:-3, 3:-3][found] = strength[3:-3, 3:-3][found]
    padded = np.pad(own, 1, constant_values=-np.inf)
    best = np.max([padded[1 + a : h + 1 + a, 1 + b : w + 1 + b] for a in (-1, 0, 1) for b in (-1, 0, 1)], axis=0)
    keep = (own == best) & np.isfinite(own)
    keep[:edge], keep[-edge:], keep[:, :edge], keep[:, -edge:] = False, False, False, False
    y, x = np.nonzero(keep)
    top = np.argsort(-own[y, x], kind="stable")[:most]
    return np.stack([x[top], y[top]], axis=1)


def described(gray: np.ndarray, points: np.ndarray) -> np.ndarray:
    """256 bits for each point: which of two places is the darker, the pairs turned by the direction of the patch's centre of mass."""
    x, y = points[:, :1], points[:, 1:]
    patch = gray[y + _DISC[:, 1], x + _DISC[:, 0]]
    angle = np.arctan2(patch @ _DISC[:, 1], patch @ _DISC[:, 0])
    c, s = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
    px, py = _PAIRS[None, ..., 0], _PAIRS[None, ..., 1]
    tx, ty = np.rint(c * px - s * py).astype(int), np.rint(s * px + c * py).astype(int)
    smooth = _box(_box(gray, 5), 3)
    values = smooth[y[:, :, None] + ty, x[:, :, None] + tx]
    return np.packbits(values[..., 0] < values[..., 1], axis=1).view(np.uint64)


def features(image: np.ndarray, most: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Places and descriptors of at most ``most`` corners, over a pyramid of images each 1.2 times smaller than the last."""
    gray = image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])
    shares = _STEP ** -np.arange(_LEVELS)
    places, bits = [np.empty((0, 2))], [np.empty((0, 4), np.uint64)]
    for level, share in enumerate(shares / shares.sum()):
        scale = _STEP**level
        h, w = round(gray.shape[0] / scale), round(gray.shape[1] / scale)
        small = gray if level == 0 else resized(_box(gray, 3), h, w)
        found = corners(small, round(most * share))
        if len(found):
            places.append((found + 0.5) * np.array([gray.shape[1] / w, gray.shape[0] / h]) - 0.5)
            bits.append(described(small, found))
    return np.concatenate(places), np.concatenate(bits)


def matched(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b that are each other's nearest, the nearest pairs first: a third of them, ten at least."""
    if not len(a) or not len(b):
        return np.empty(0, int), np.empty(0, int)
    gaps = np.concatenate([np.bitwise_count(a[k : k + 128, None] ^ b[None]).sum(axis=2, dtype=np.int16) for k in range(0, len(a), 128)])
    near, back = gaps.argmin(axis=1), gaps.argmin(axis=0)
    i = np.flatnonzero(back[near] == np.arange(len(a)))
    i = i[np.argsort(gaps[i, near[i]], kind="stable")]
    i = i[: max(10, len(i) // 3)]
    return i, near[i]


def _solved(p: np.ndarray, q: np.ndarray) -> np.ndarray | None:
    """The homography that takes points p to q with the least squares, in coordinates of mean zero and like size."""

    def unit(z: np.ndarray) -> np.ndarray:
        m = z.mean(axis=0)
        s = np.sqrt(2) / max(np.hypot(*(z - m).T).mean(), 1e-9)
        return np.array([[s, 0, -s * m[0]], [0, s, -s * m[1]], [0, 0, 1]])

    a, b = unit(p), unit(q)
    one = np.ones((len(p), 1))
    (x, y, w), (u, v, _) = (a @ np.hstack([p, one]).T), (b @ np.hstack([q, one]).T)
    zero = np.zeros_like(x)
    rows = np.concatenate([np.stack([x, y, w, zero, zero, zero, -u * x, -u * y, -u * w], 1), np.stack([zero, zero, zero, x, y, w, -v * x, -v * y, -v * w], 1)])
    h = np.linalg.svd(rows)[2][-1].reshape(3, 3)
    h = np.linalg.solve(b, h @ a)
    return h / h[2, 2] if abs(h[2, 2]) > 1e-12 else None


def _through_four(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Homographies that take four points each exactly to four others; sets without one are left out."""
    (x, y), (u, v) = np.moveaxis(p, -1, 0), np.moveaxis(q, -1, 0)
    one, zero = np.ones_like(x), np.zeros_like(x)
    rows = np.concatenate([np.stack([x, y, one, zero, zero, zero, -u * x, -u * y], -1), np.stack([zero, zero, zero, x, y, one, -v * x, -v * y], -1)], axis=1)
    able = np.abs(np.linalg.det(rows)) > 1e-6
    h = np.linalg.solve(rows[able], np.concatenate([u, v], axis=1)[able][..., None])[..., 0]
    return np.concatenate([h, np.ones((len(h), 1))], axis=1).reshape(-1, 3, 3)


def _moved(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    x, y, w = h @ np.hstack([p, np.ones((len(p), 1))]).T
    w = np.where(np.abs(w) < 1e-12, 1e-12, w)
    return np.stack([x / w, y / w], axis=1)


def homography(p: np.ndarray, q: np.ndarray, reach: float = REACH, tries: int = 2000) -> tuple[np.ndarray | None, np.ndarray]:
    """The homography from p to q that most pairs agree with, solved again over those, and which they are.

    Sets of four pairs are drawn, 250 at a time, until another set would
    better the result with a probability under half a percent.
    """
    rng, n = np.random.default_rng(4), len(p)
    best = np.zeros(n, bool)
    if n < 4:
        return None, best
    done, wanted = 0, tries
    whole = np.hstack([p, np.ones((n, 1))]).T
    while done < wanted:
        chosen = rng.random((250, n)).argpartition(3, axis=1)[:, :4] if n > 4 else np.arange(4)[None]
        drawn = _through_four(p[chosen], q[chosen])
        x, y, w = np.moveaxis(drawn @ whole, 1, 0)
        with np.errstate(all="ignore"):
            off = np.hypot(x / w - q[:, 0], y / w - q[:, 1]) <= reach
        most = off.sum(axis=1).argmax() if len(off) else 0
        if len(off) and off[most].sum() > best.sum():
            best = off[most]
        share = min(best.mean() ** 4, 1 - 1e-12)
        done += len(chosen) if n > 4 else tries
        wanted = min(tries, np.log(0.005) / np.log1p(-share)) if share > 0 else tries
    h = None
    for _ in range(3):  # those that agree with what they give
        if best.sum() < 4 or (h := _solved(p[best], q[best])) is None:
            return None, best
        best = np.hypot(*(_moved(h, p) - q).T) <= reach
    return h, best


def warped(image: np.ndarray, onto: np.ndarray, h: int, w: int) -> np.ndarray:
    """An image of the given size whose pixel at ``onto(p)`` is the pixel p of ``image``."""
    y, x = np.meshgrid(np.arange(h), np.arange(w), indexing="ij")
    back = _moved(np.linalg.inv(onto), np.stack([x.ravel(), y.ravel()], axis=1))
    return np.rint(sampled(image, back[:, 0].reshape(h, w), back[:, 1].reshape(h, w))).astype(np.uint8)


def orb_align(most: int = 1000, min_inliers: int = MIN_INLIERS, min_share: float = MIN_SHARE) -> Callable[[np.ndarray, np.ndarray], np.ndarray | None]:
    """A function that lays its second image onto the first, or gives None: too few features, or too few
    pairs that agree (``min_inliers``, and ``min_share`` of those matched)."""

    held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def known(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of one image, kept for the next edges of the same image."""
        key = image.shape, image.tobytes()
        if key not in held:
            while len(held) >= 32:
                held.pop(next(iter(held)))
            held[key] = features(image, most)
        return held[key]

    def align(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
        (px, dx), (py, dy) = known(x), known(y)
        if len(px) < 4 or len(py) < 4:
            return None
        i, j = matched(dx, dy)
        onto, agree = homography(py[j], px[i])
        if onto is None or agree.sum() < min_inliers or agree.mean() < min_share or abs(np.linalg.det(onto)) < 1e-9:
            return None
        return warped(y, onto, *x.shape[:2])

    return align
