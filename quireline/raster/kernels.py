"""Pixel kernels in numpy: what the page operators are made of. Gray images are uint8 (h, w), colour ones BGR (h, w, 3)."""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of a BGR image; a gray one as it is."""
    if image.ndim == 2:
        return image
    b, g, r = (image[..., k].astype(np.float64) for k in range(3))
    return np.clip(np.rint(0.114 * b + 0.587 * g + 0.299 * r), 0, 255).astype(np.uint8)


def _pad(a: np.ndarray, y: int, x: int, mode: str = "reflect") -> np.ndarray:
    if mode == "reflect" and (a.shape[0] <= y or a.shape[1] <= x):
        mode = "edge"
    return np.pad(a, ((y, y), (x, x)), mode=mode)


def gaussian_weights(size: int, sigma: float = 0.0) -> np.ndarray:
    """Normalised weights; without a sigma it follows from the size."""
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - (size - 1) / 2
    w = np.exp(-x * x / (2 * sigma * sigma))
    return w / w.sum()


def _along(a: np.ndarray, w: np.ndarray, axis: int, mode: str) -> np.ndarray:
    r = len(w) // 2
    padded = _pad(a, r if axis == 0 else 0, r if axis == 1 else 0, mode)
    out = np.zeros(a.shape)
    for k, v in enumerate(w):
        out += v * (padded[k : k + a.shape[0]] if axis == 0 else padded[:, k : k + a.shape[1]])
    return out


def gaussian(a: np.ndarray, size: int, sigma: float = 0.0, mode: str = "reflect") -> np.ndarray:
    w = gaussian_weights(size, sigma)
    return _along(_along(a.astype(np.float64), w, 1, mode), w, 0, mode)


def box_mean(a: np.ndarray, size: int) -> np.ndarray:
    """Mean over size x size with edges repeated, by an integral image."""
    r = size // 2
    s = np.pad(_pad(a.astype(np.float64), r, r, "edge").cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h, w = a.shape
    return (s[size : size + h, size : size + w] - s[:h, size : size + w] - s[size : size + h, :w] + s[:h, :w]) / (size * size)


def median(a: np.ndarray, size: int) -> np.ndarray:
    """Median filter of a gray image, edges repeated; large windows go by running histograms of levels."""
    r = size // 2
    if size <= 7:
        return np.median(sliding_window_view(_pad(a, r, r, "edge"), (size, size)), axis=(2, 3)).astype(np.uint8)
    half, kind, padded = size * size // 2, np.uint16 if size < 256 else np.uint32, _pad(a, r, r, "edge")
    out = np.empty(a.shape, np.uint8)
    for top in range(0, a.shape[0], MEDIAN_ROWS):
        own = padded[top : top + MEDIAN_ROWS + 2 * r]
        levels = np.unique(own)
        low = np.zeros(out[top : top + MEDIAN_ROWS].shape, np.int16)
        high = np.full_like(low, len(levels) - 1)
        while (open_ := low < high).any():  # each pixel's level by bisection; a level that several ask for is counted once
            middle = (low + high) >> 1
            for level in np.unique(middle[open_]):
                here = open_ & (middle == level)
                right = _box_count(own <= levels[level], size, kind) > half
                high[here & right], low[here & ~right] = level, level + 1
        out[top : top + MEDIAN_ROWS] = levels[low]
    return out


#: Rows whose medians are sought together: few have few different levels to ask for.
MEDIAN_ROWS = 96


def _box_count(mask: np.ndarray, size: int, kind: type) -> np.ndarray:
    """How many of size x size are set; running sums may overflow, as their differences don't."""
    down = np.zeros((mask.shape[0] + 1, mask.shape[1]), kind)
    np.cumsum(mask, axis=0, dtype=kind, out=down[1:])
    down = down[size:] - down[:-size]
    over = np.zeros((down.shape[0], down.shape[1] + 1), kind)
    np.cumsum(down, axis=1, dtype=kind, out=over[:, 1:])
    return over[:, size:] - over[:, :-size]


def otsu_level(a: np.ndarray) -> int:
    """Threshold that parts the levels best; pixels over it are foreground."""
    n = np.bincount(a.ravel(), minlength=256).astype(np.float64)
    p = n / max(n.sum(), 1)
    w, m = p.cumsum(), (p * np.arange(256)).cumsum()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.where((w > 1e-7) & (w < 1 - 1e-7), (m[-1] * w - m) ** 2 / (w * (1 - w)), 0)
    return int(between.argmax())


def otsu(a: np.ndarray, inverse: bool = False) -> np.ndarray:
    over = a > otsu_level(a)
    return ~over if inverse else over


def adaptive(a: np.ndarray, block: int, c: float, kind: str = "gaussian", inverse: bool = True) -> np.ndarray:
    """Pixels at or under (inverse) or over their neighbourhood's mean less c."""
    local = gaussian(a, block, mode="edge") if kind == "gaussian" else box_mean(a, block)
    local = np.rint(local)
    return a <= local - c if inverse else a > local - c


def _running(a: np.ndarray, size: int, axis: int, least: bool) -> np.ndarray:
    """Any, or all, of a mask in a window of size along an axis."""
    before, after = size // 2, size - 1 - size // 2
    pad = [(0, 0), (0, 0)]
    pad[axis] = (before + 1, after)
    s = np.pad(a.astype(np.int32), pad, constant_values=1 if least else 0).cumsum(axis)
    n = a.shape[axis]
    total = s.take(range(size, size + n), axis) - s.take(range(n), axis)
    return total == size if least else total > 0


def dilate(mask: np.ndarray, w: int, h: int, times: int = 1) -> np.ndarray:
    for _ in range(times):
        mask = _running(_running(mask, w, 1, False), h, 0, False)
    return mask


def erode(mask: np.ndarray, w: int, h: int, times: int = 1) -> np.ndarray:
    for _ in range(times):
        mask = _running(_running(mask, w, 1, True), h, 0, True)
    return mask


def opened(mask: np.ndarray, w: int, h: int, times: int = 1) -> np.ndarray:
    return dilate(erode(mask, w, h, times), w, h, times)


def closed(mask: np.ndarray, w: int, h: int, times: int = 1) -> np.ndarray:
    return erode(dilate(mask, w, h, times), w, h, times)


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels from 1 of the 8-connected components and how many there are; runs of rows are joined by union-find."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(edge == 1)
    ends = np.nonzero(edge == -1)[1]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first = np.searchsorted(rows, np.arange(h + 1))
    for y in range(1, h):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if starts[i] <= ends[j] and starts[j] <= ends[i]:  # ends are exclusive, so this counts diagonals
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    roots = np.array([find(k) for k in range(len(rows))], np.int64)
    _, label = np.unique(roots, return_inverse=True)
    out = np.zeros((h, w), np.int32)
    for y, s, e, k in zip(rows, starts, ends, label, strict=True):
        out[y, s:e] = k + 1
    return out, int(label.max()) + 1 if len(label) else 0


def boxes(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(x, y, w, h) of each component."""
    labels, n = components(mask)
    if not n:
        return []
    ys, xs = np.nonzero(labels)
    k = labels[ys, xs] - 1
    x0, y0, x1, y1 = np.full(n, 1 << 30), np.full(n, 1 << 30), np.full(n, -1), np.full(n, -1)
    np.minimum.at(x0, k, xs)
    np.minimum.at(y0, k, ys)
    np.maximum.at(x1, k, xs)
    np.maximum.at(y1, k, ys)
    return [(int(a), int(b), int(c - a + 1), int(d - b + 1)) for a, b, c, d in zip(x0, y0, x1, y1, strict=True)]


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull of (n, 2) points, counter-clockwise."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def half(q):
        out: list = []
        for v in q:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (v[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (v[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(v)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def least_rectangle(points: np.ndarray) -> tuple[float, float, float]:
    """(width, height, angle in (-90, 0]) of the rectangle of least area around points."""
    c = hull(points).astype(np.float64)
    if len(c) < 3:
        d = c[-1] - c[0]
        return float(np.hypot(*d)), 0.0, float(np.degrees(np.arctan2(d[1], d[0])) % 90 - 90)
    best = (np.inf, 0.0, 0.0, 0.0)
    for a in np.unique(np.arctan2(*(np.roll(c, -1, 0) - c).T[::-1]) % (np.pi / 2)):
        u, v = c @ (np.cos(a), np.sin(a)), c @ (-np.sin(a), np.cos(a))
        w, h = np.ptp(u), np.ptp(v)
        if w * h < best[0]:
            best = (w * h, w, h, np.degrees(a))
    _, w, h, angle = best
    return (h, w, angle - 90) if angle > 0 else (w, h, 0.0)


def outline_area(points: np.ndarray, mask_area: int) -> float:
    """Area inside the outline through pixel centres of a filled component of so many pixels and so many outline pixels (Pick's theorem)."""
    return max(0.0, mask_area - len(points) / 2 - 1)


def outline(mask: np.ndarray) -> np.ndarray:
    return mask & ~(_running(mask, 3, 1, True) & _running(mask, 3, 0, True))


def laplacian_variance(a: np.ndarray) -> float:
    p = _pad(a.astype(np.float64), 1, 1)
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def sample(image: np.ndarray, y: np.ndarray, x: np.ndarray, fill: float | None = None) -> np.ndarray:
    """Cubic interpolation at (y, x); outside: fill, or the edge repeated."""
    h, w = image.shape[:2]
    a = image.astype(np.float64)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)

    def weights(t):
        t = np.abs(t)
        c = -0.75
        return np.where(t <= 1, (c + 2) * t**3 - (c + 3) * t**2 + 1, np.where(t < 2, c * t**3 - 5 * c * t**2 + 8 * c * t - 4 * c, 0))

    out = np.zeros((*y.shape, *image.shape[2:]))
    for j in range(-1, 3):
        for i in range(-1, 3):
            yy, xx = y0 + j, x0 + i
            v = a[np.clip(yy, 0, h - 1), np.clip(xx, 0, w - 1)]
            if fill is not None:
                gone = (yy < 0) | (yy >= h) | (xx < 0) | (xx >= w)
                v = np.where(gone[..., None] if v.ndim > y.ndim else gone, fill, v)
            k = weights(y - yy) * weights(x - xx)
            out += v * (k[..., None] if v.ndim > y.ndim else k)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    h, w = image.shape[:2]
    y, x = (np.arange(height) + 0.5) * h / height - 0.5, (np.arange(width) + 0.5) * w / width - 0.5
    return sample(image, *np.meshgrid(y, x, indexing="ij"))


def long_side(image: np.ndarray, target: int) -> np.ndarray:
    """Enlarged so that the long side is the target; never made smaller."""
    h, w = image.shape[:2]
    if max(h, w) >= target:
        return image
    k = target / max(h, w)
    return resized(image, max(1, round(h * k)), max(1, round(w * k)))


def rotated(image: np.ndarray, angle: float, keep_size: bool = False, fill: float = 255) -> np.ndarray:
    """Turned counter-clockwise about its centre on white, the frame grown to hold all unless told otherwise."""
    h, w = image.shape[:2]
    a = np.radians(angle)
    c, s = abs(np.cos(a)), abs(np.sin(a))
    nh, nw = (h, w) if keep_size else (int(h * c + w * s), int(h * s + w * c))
    y, x = np.meshgrid(np.arange(nh) - nh / 2, np.arange(nw) - nw / 2, indexing="ij")
    return sample(image, np.sin(a) * x + np.cos(a) * y + h / 2, np.cos(a) * x - np.sin(a) * y + w / 2, fill)


def rotated_mask(mask: np.ndarray, angle: float) -> np.ndarray:
    """A mask turned counter-clockwise about its centre within its frame, each pixel from its nearest one."""
    h, w = mask.shape
    a = np.radians(angle)
    y, x = np.arange(h)[:, None] - h / 2, np.arange(w)[None] - w / 2
    yy = np.rint(np.sin(a) * x + np.cos(a) * y + h / 2).astype(np.int32)
    xx = np.rint(np.cos(a) * x - np.sin(a) * y + w / 2).astype(np.int32)
    inside = (yy >= 0) & (yy < h) & (xx >= 0) & (xx < w)
    return mask[np.clip(yy, 0, h - 1), np.clip(xx, 0, w - 1)] & inside


def clahe(a: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Equalised by tiles with a limit on contrast, blended between tiles."""
    h, w = a.shape
    th, tw = -(-h // tiles), -(-w // tiles)
    padded = np.pad(a, ((0, th * tiles - h), (0, tw * tiles - w)), mode="reflect" if h > th and w > tw else "edge")
    area = th * tw
    limit = max(1, int(clip * area / 256))
    table = np.empty((tiles, tiles, 256))
    for j in range(tiles):
        for i in range(tiles):
            n = np.bincount(padded[j * th : (j + 1) * th, i * tw : (i + 1) * tw].ravel(), minlength=256)
            over = int(np.maximum(n - limit, 0).sum())
            n = np.minimum(n, limit) + over // 256
            n[: over % 256] += 1
            table[j, i] = np.clip(np.rint(n.cumsum() * 255 / area), 0, 255)
    y, x = (np.arange(h) + 0.5) / th - 0.5, (np.arange(w) + 0.5) / tw - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None]
    at = lambda j, i: table[np.clip(j, 0, tiles - 1)[:, None], np.clip(i, 0, tiles - 1)[None], a]
    top = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx
    bottom = at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    return np.clip(np.rint(top * (1 - fy) + bottom * fy), 0, 255).astype(np.uint8)


def _window_sum(a: np.ndarray, size: int, axis: int) -> np.ndarray:
    """Sums of ``size`` neighbours along an axis, made of sums of 1, 2, 4 and so on."""
    cut = lambda x, begin, n: x[begin : begin + n] if axis == 0 else x[:, begin : begin + n]
    n, total, at, power, sums = a.shape[axis] - size + 1, None, 0, 1, a
    while True:
        if size & power:
            part = cut(sums, at, n)
            total, at = part if total is None else total + part, at + power
        if 2 * power > size:
            return total
        m = sums.shape[axis] - power
        sums, power = cut(sums, 0, m) + cut(sums, power, m), 2 * power


#: Pixels that are denoised together, so that what is summed stays near the processor.
STRIP = 1 << 17


def denoised(a: np.ndarray, h: float, patch: int = 7, window: int = 21) -> np.ndarray:
    """Non-local means: each pixel a mean of the window's, weighed by how alike their patches are.

    Two pixels are as alike from one as from the other, so half of the window's places are compared and count for both; strips
    of rows are gone through one by one.
    """
    r, p = window // 2, patch // 2
    padded = _pad(a, r + p, r + p).astype(np.float32)
    out, rows, w = np.empty(a.shape, np.uint8), max(16, STRIP // max(1, a.shape[1])), a.shape[1]
    for top in range(0, a.shape[0], rows):
        n = min(rows, a.shape[0] - top)
        own = padded[top : top + n + 2 * (r + p)]
        near = own[p : p + n + 2 * r, p : p + w + 2 * r]  # the strip and half a window around it
        total, weight = near[r : r + n, r : r + w].copy(), np.ones((n, w), np.float32)
        for dy in range(r + 1):
            for dx in range(-r if dy else 1, r + 1):
                # how alike each pixel is to the one a step on: those of the strip, and those a step before them
                y, x, height, width = r - dy, r - max(dx, 0), n + dy + 2 * p, w + abs(dx) + 2 * p
                d = own[y : y + height, x : x + width] - own[y + dy : y + dy + height, x + dx : x + dx + width]
                d *= d
                alike = np.exp(_window_sum(_window_sum(d, patch, 0), patch, 1) * np.float32(-1 / (patch * patch * h * h)))
                on, back = alike[dy:, max(dx, 0) : max(dx, 0) + w], alike[:n, max(-dx, 0) : max(-dx, 0) + w]
                total += on * near[r + dy : r + dy + n, r + dx : r + dx + w]
                total += back * near[r - dy : r - dy + n, r - dx : r - dx + w]
                weight += on
                weight += back
        out[top : top + n] = np.clip(np.rint(total / weight), 0, 255)
    return out


def normalised(a: np.ndarray) -> np.ndarray:
    lo, hi = float(a.min()), float(a.max())
    return np.zeros_like(a, np.uint8) if hi <= lo else np.clip(np.rint((a.astype(np.float64) - lo) * 255 / (hi - lo)), 0, 255).astype(np.uint8)


def stretched(a: np.ndarray, low: float, high: float, within: np.ndarray | None = None) -> np.ndarray:
    """From the low to the high percentile to the full range; as it is where the two are the same."""
    lo, hi = np.percentile(a if within is None or not within.any() else a[within], [low, high])
    return a if hi <= lo else np.clip((a.astype(np.float64) - lo) * 255 / (hi - lo), 0, 255).astype(np.uint8)


def edges(a: np.ndarray, low: float, high: float) -> np.ndarray:
    """Thinned gradient edges over high, and those over low that touch them."""
    p = _pad(a.astype(np.float64), 1, 1)
    gx = p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:] - p[:-2, :-2] - 2 * p[1:-1, :-2] - p[2:, :-2]
    gy = p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:] - p[:-2, :-2] - 2 * p[:-2, 1:-1] - p[:-2, 2:]
    m = np.abs(gx) + np.abs(gy)
    q = np.pad(m, 1)
    way = (np.rint(np.degrees(np.arctan2(gy, gx)) / 45) % 4).astype(int)
    keep = np.zeros(a.shape, bool)
    for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        one = q[1 + dy : 1 + dy + a.shape[0], 1 + dx : 1 + dx + a.shape[1]]
        two = q[1 - dy : 1 - dy + a.shape[0], 1 - dx : 1 - dx + a.shape[1]]
        keep |= (way == k) & (m > one) & (m >= two)
    weak = keep & (m > low)
    labels, n = components(weak)
    strong = np.zeros(n + 1, bool)
    strong[labels[keep & (m > high)]] = True
    strong[0] = False
    return strong[labels]


def inpainted(image: np.ndarray, mask: np.ndarray, radius: int = 3) -> np.ndarray:
    """Masked pixels filled from their rim inwards by the mean of the known ones within the radius."""
    out = image.astype(np.float64)
    if out.ndim == 2:
        out = out[..., None]
    known = ~mask
    size = 2 * radius + 1
    while not known.all():
        ring = ~known & dilate(known, 3, 3)
        if not ring.any():
            break
        n = box_mean(known.astype(np.float64), size)
        for k in range(out.shape[2]):
            mean = box_mean(np.where(known, out[..., k], 0), size)
            out[..., k][ring] = mean[ring] / n[ring]
        known = known | ring
    return np.clip(np.rint(out), 0, 255).astype(np.uint8).reshape(image.shape)
