"""Page operators over images: metrics, lines, skew, lightening. All in numpy; the Spark side is in ``udfs``."""

from __future__ import annotations

import numpy as np

from quireline.config import AdvancedLightenParams, DeskewParams, LightenParams
from quireline.raster import kernels as K

# --- metrics


def document_roi(image: np.ndarray) -> tuple[int, int, int, int, float]:
    """(x1, y1, x2, y2, share of the page) of the largest bright region's box; the whole page and 0 without one."""
    g = K.gray(image)
    h, w = g.shape
    smooth = np.clip(np.rint(K.gaussian(g, 5)), 0, 255).astype(np.uint8)
    found = max(K.boxes(K.otsu(smooth)), key=lambda b: b[2] * b[3], default=None)
    if found is None:
        return 0, 0, w, h, 0.0
    x, y, bw, bh = found
    return x, y, x + bw, y + bh, bw * bh / (w * h) if w * h else 1.0


def cropped(image: np.ndarray) -> tuple[np.ndarray, float]:
    """The page's region and its share; the whole page if a side of the region is under a fifth of it."""
    x1, y1, x2, y2, share = document_roi(image)
    h, w = image.shape[:2]
    return (image if x2 - x1 < 0.2 * w or y2 - y1 < 0.2 * h else image[y1:y2, x1:x2]), share


def blur(image: np.ndarray) -> float:
    return K.laplacian_variance(K.gray(image))


def text_density(image: np.ndarray) -> float:
    ink = K.opened(K.adaptive(K.median(K.gray(image), 3), 35, 15), 3, 3)
    return float(ink.mean()) if ink.size else 0.0


def table_like(image: np.ndarray) -> bool:
    ink = K.adaptive(K.gray(image), 31, 10, "mean")
    return bool((K.opened(ink, 40, 1).sum() + K.opened(ink, 1, 40).sum()) / max(ink.size, 1) > 0.010)


def _inner(a: np.ndarray, share: float = 0.06) -> np.ndarray:
    m = int(min(a.shape[:2]) * share)
    return a[m : a.shape[0] - m, m : a.shape[1] - m] if m and min(a.shape[:2]) > 2 * m else a


def _rectangles(ink: np.ndarray, least_area: float):
    """(area, width, height, angle) of the least rectangles around components of so much area."""
    labels, n = K.components(ink)
    rim = K.outline(ink)
    size = np.bincount(labels.ravel(), minlength=n + 1)
    ys, xs = np.nonzero(rim)
    order = np.argsort(labels[ys, xs], kind="stable")
    ys, xs = ys[order], xs[order]
    at = np.searchsorted(labels[ys, xs], np.arange(1, n + 2))
    for k in range(n):
        points = np.column_stack([xs[at[k] : at[k + 1]], ys[at[k] : at[k + 1]]])
        area = K.outline_area(points, size[k + 1])
        if area >= least_area:
            w, h, angle = K.least_rectangle(points)
            if w > 1 and h > 1:
                yield area, w, h, angle


def skew(image: np.ndarray) -> float:
    """Median distance of text lines from an axis, in degrees."""
    g = _inner(K.gray(image))
    ink = K.dilate(K.adaptive(g, 31, 11), max(20, g.shape[1] // 50), 3)
    found = []
    for _, _, _, angle in _rectangles(ink, 3e-4 * g.size):
        a = angle if angle <= 0 else angle - 90
        found.append(min(abs(a), abs(90 - abs(a))))
    return float(np.median(found)) if found else 0.0


def core_fraction(image: np.ndarray) -> float:
    """Share of the largest connected body of content."""
    g = K.gray(image)
    body = K.closed(K.adaptive(K.median(g, 3), 41, 15), 15, 15, 2)
    labels, n = K.components(body)
    if not n:
        return 0.0
    rim = np.bincount(labels[K.outline(body)], minlength=n + 1)
    size = np.bincount(labels.ravel(), minlength=n + 1)
    return float(max(max(0.0, a - p / 2 - 1) for a, p in zip(size[1:], rim[1:], strict=True)) / g.size)


def for_ocr(image: np.ndarray) -> np.ndarray:
    g = K.clahe(K.gray(K.long_side(image, 1800)), 2.0, 8)
    return K.median((K.otsu(g) * 255).astype(np.uint8), 3)


def brightness(image: np.ndarray) -> dict[str, float]:
    g = K.gray(image)
    return {
        "mean_brightness": float(g.mean()), "median_brightness": float(np.median(g)), "dark_pixels_percent": float((g < 100).mean() * 100),
        "very_dark_pixels_percent": float((g < 50).mean() * 100), "contrast": float(g.std()),
    }


def metrics(image: np.ndarray) -> dict[str, float | bool]:
    """All metrics of a page; its gray region is made once for all of them."""
    region, share = cropped(K.gray(image))
    return {
        "roi_frac": share, "blur": blur(region), "text_density": text_density(region), "core_frac": core_fraction(region), "skew_deg": skew(region), "is_table": table_like(region),
    }


# --- lines


def detect_lines(image: np.ndarray, ratio: float = 0.9, thickness: int = 8, table_lines: int = 3) -> dict:
    """{has_line, orientation, score, boxes} of the long thin lines and dark borders that scanning leaves; tables aren't lines."""
    g = K.gray(image)
    h, w = g.shape
    ink = K.otsu(g, inverse=True)
    found = {}
    for way, length, mask in (("h", int(ratio * w), K.opened(ink, max(10, int(ratio * w)), 1)), ("v", int(ratio * h), K.opened(ink, 1, max(10, int(ratio * h))))):
        across = (lambda b: b[2]) if way == "h" else (lambda b: b[3])
        thick = (lambda b: b[3]) if way == "h" else (lambda b: b[2])
        found[way] = [b for b in K.boxes(K.dilate(mask, 3, 3)) if across(b) >= length and thick(b) <= thickness]
    band = max(4, int(0.01 * min(h, w)))
    for way, part, box in (("h", ink[:band], (0, 0, w, band)), ("h", ink[-band:], (0, h - band, w, band)), ("v", ink[:, :band], (0, 0, band, h)), ("v", ink[:, -band:], (w - band, 0, band, h))):
        if part.mean() > 0.12:
            found[way].append(box)
    score = {}
    for way, dim, at in (("h", h, 1), ("v", w, 0)):
        own = found[way]
        if len(own) >= table_lines and (max(b[at] for b in own) - min(b[at] for b in own)) / dim > 0.6:
            own = found[way] = []
        along, thick = (2, 3) if way == "h" else (3, 2)
        side = w if way == "h" else h
        score[way] = 0.8 * max(b[along] for b in own) / side + 0.2 * max(0.0, 1 - min(b[thick] for b in own) / max(1, thickness)) if own else 0.0
    if not any(score.values()):
        return {"has_line": False, "orientation": None, "score": 0.0, "boxes": []}
    way = "h" if score["h"] >= score["v"] else "v"
    return {"has_line": True, "orientation": way, "score": float(score[way]), "boxes": found[way]}


def remove_lines(image: np.ndarray, ratio: float = 0.55, thickness: int = 3) -> np.ndarray:
    g = K.gray(image)
    h, w = g.shape
    ink = K.otsu(g, inverse=True)
    mask = K.opened(ink, max(10, int(ratio * w)), 1) | K.opened(ink, 1, max(10, int(ratio * h)))
    band = max(4, int(0.01 * min(h, w)))
    for part in (np.s_[:band], np.s_[-band:], np.s_[:, :band], np.s_[:, -band:]):
        if ink[part].mean() > 0.12:
            mask[part] = True
    return K.inpainted(image, K.dilate(mask, thickness, thickness), 3) if mask.any() else image


# --- skew


def printed(image: np.ndarray) -> np.ndarray:
    """Dark, unsaturated ink: print rather than stamps or pens."""
    b = image.astype(np.float64) if image.ndim == 3 else np.repeat(image[..., None], 3, 2).astype(np.float64)
    top, low = b.max(2), b.min(2)
    k = (255 - top).astype(np.uint8)
    plain = (top - low) / np.maximum(top, 1) < 0.40
    mask = K.adaptive(k, 31, -5, inverse=False) & plain & (k >= 20)
    return K.median((mask * 255).astype(np.uint8), 3) > 0


def projection_score(mask: np.ndarray) -> float:
    rows = K._along(mask.sum(1, dtype=np.float64)[:, None] * 255, K.gaussian_weights(61, 9), 0, "reflect")[:, 0]
    return float(np.abs(np.diff(rows)).sum() / mask.size)


def weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    run = weights[order].cumsum()
    return float(values[order][np.searchsorted(run, run[-1] / 2)])


def skew_angle(image: np.ndarray, limit: float = 35.0) -> float:
    """Angle to turn by: lines' weighted median, refined, or searched for over the whole range, so that row sums vary most."""
    mask = printed(_inner(image))
    h, w = mask.shape
    joined = K.dilate(mask, max(20, w // 50), 3)
    found = []
    for area, rw, rh, angle in _rectangles(joined, 3e-4 * mask.size):
        if max(rw, rh) / min(rw, rh) >= 3:
            a = angle + 90 if angle < -45 else angle
            if abs(a) <= limit:
                found.append((a, area * (max(rw, rh) / min(rw, rh) - 1)))
    best, steps = 0.0, ((1.0, limit), (0.2, 6), (0.05, 2))
    if found and (seed := weighted_median(*np.array(found).T)):  # lines that lie straight say nothing: all angles are tried
        best, steps = seed, ((0.5, 8), (0.2, 3), (0.05, 1))
    top = -1.0
    for step, reach in steps:
        around = best
        for a in around + step * np.arange(-round(reach / step), round(reach / step) + 1):
            s = projection_score(K.rotated_mask(mask, a))
            if s > top:
                top, best = s, float(a)
    return best


def deskewed(image: np.ndarray, p: DeskewParams = DeskewParams()) -> tuple[np.ndarray, float]:
    angle = skew_angle(image, p.angle_limit)
    return (image, 0.0) if abs(angle) < 0.05 else (K.rotated(image, angle, p.keep_size), angle)


def right_angle(image: np.ndarray, degrees: int) -> np.ndarray:
    """Turned clockwise by a multiple of 90 degrees."""
    return np.ascontiguousarray(np.rot90(image, -(degrees // 90)))


def upright_guess(image: np.ndarray) -> int:
    """0 or 90: whether text lines run across or down, by which way row sums vary more. For use without a model."""
    ink = K.otsu(K.gray(image), inverse=True)
    return 0 if projection_score(ink) >= projection_score(ink.T) else 90


# --- light


def _unsharp(g: np.ndarray, amount: float, sigma: float, where: np.ndarray, minus: float | None = None) -> np.ndarray:
    smooth = K.gaussian(g, int(2 * np.ceil(3 * sigma) + 1), sigma)
    less = amount - 1 if minus is None else minus
    return np.where(where, np.clip(np.rint(amount * g - less * smooth), 0, 255), g).astype(np.uint8)


def _lightness(image: np.ndarray) -> np.ndarray:
    """Perceived lightness, 0 to 255, of a BGR or gray image."""
    c = (image if image.ndim == 3 else np.repeat(image[..., None], 3, 2)).astype(np.float64) / 255
    c = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    y = c @ (0.072169, 0.715160, 0.212671)
    return np.clip(np.rint(255 / 100 * np.where(y > 0.008856, 116 * np.cbrt(y) - 16, 903.3 * y)), 0, 255).astype(np.uint8)


def _as(image: np.ndarray, light: np.ndarray, before: np.ndarray, keep_color: bool) -> np.ndarray:
    """A gray image, or the colours of the image made as light as ``light`` against what they were before."""
    if not keep_color or image.ndim == 2:
        return light
    return np.clip(np.rint(image * (light.astype(np.float64) / np.maximum(before, 1))[..., None]), 0, 255).astype(np.uint8)


def lightened(image: np.ndarray, p: LightenParams = LightenParams()) -> np.ndarray:
    """First pass: even background, local contrast, less noise, sharp edges."""
    image = K.long_side(image, p.long_side)
    light = before = _lightness(image)
    size = max(31, int(min(light.shape) * p.background_ratio))
    background = K.median(light, size + 1 - size % 2)
    light = np.clip(light.astype(np.float64) / np.maximum(background, 1) * 255, 0, 255).astype(np.uint8)
    light = K.denoised(K.clahe(light, p.clahe_clip), p.denoise_h)
    edge = K.dilate(K.edges(light, p.canny_low, p.canny_high), 3, 3)
    light = K.denoised(K.normalised(_unsharp(light, p.unsharp, 1.0, edge)), 4)
    return _as(image, light, before, p.keep_color)


def lightened_again(image: np.ndarray, p: LightenParams = LightenParams()) -> np.ndarray:
    """Later passes: only the darker part is evened out and stretched."""
    light = before = _lightness(image)
    size = max(31, int(min(light.shape) * p.background_ratio))
    background = K.median(light, size + 1 - size % 2)
    flat = np.clip(light.astype(np.float64) / np.maximum(background, 1) * 255, 0, 255).astype(np.uint8)
    light = np.where(~K.otsu(before), K.stretched(flat, 2, 99.8), flat)
    light = K.normalised(np.rint(K.gaussian(light, 5, 0.6)))
    edge = K.edges(before, p.canny_low, p.canny_high)
    return _as(image, _unsharp(light, 1.15, 0.8, edge, 0.15), before, p.keep_color)


def lightened_more(image: np.ndarray, p: AdvancedLightenParams = AdvancedLightenParams()) -> np.ndarray:
    """Background and text treated apart."""
    image = K.long_side(image, p.long_side)
    light = before = _lightness(image)
    short = min(light.shape)
    radius = max(25, int(p.open_ratio * short))
    background = gray_opened(light, 2 * radius + 1)
    sigma = max(3.0, p.sigma_ratio * short)
    background = K.gaussian(background, int(2 * np.ceil(3 * sigma) + 1), sigma)
    flat = np.clip(light * 255.0 / np.maximum(background, 10), 0, 255).astype(np.uint8)
    block = max(25, int(p.block_ratio * short))
    text = K.dilate(K.opened(K.adaptive(flat, block + 1 - block % 2, 10), 3, 3), 2, 2)
    calm = np.rint(K.gaussian(K.denoised(flat, p.denoise_h), 7, 1.0)).astype(np.uint8)
    both = np.where(text, flat, calm).astype(np.uint8)
    light = K.clahe(np.where(text, both, K.stretched(both, p.stretch_low, p.stretch_high)).astype(np.uint8), p.clahe_clip)
    edge = K.dilate(K.edges(light, p.canny_low, p.canny_high), 3, 3) & text
    return _as(image, _unsharp(light, 1 + p.unsharp, 1.0, edge), before, p.keep_color)


def filled(image: np.ndarray, boxes: list[tuple[int, int, int, int]], ring: int = 4) -> np.ndarray:
    """The image with boxes (x, y, width, height) painted over in the colour around each: the median of a ring, white where there is none."""
    out = image.copy()
    for x, y, w, h in boxes:
        y0, y1, x0, x1 = max(y, 0), min(y + h, image.shape[0]), max(x, 0), min(x + w, image.shape[1])
        if y0 < y1 and x0 < x1:
            around = np.zeros(image.shape[:2], bool)
            around[max(y0 - ring, 0) : y1 + ring, max(x0 - ring, 0) : x1 + ring] = True
            around[y0:y1, x0:x1] = False
            out[y0:y1, x0:x1] = np.median(image[around], axis=0) if around.any() else 255
    return out


def gray_opened(a: np.ndarray, size: int) -> np.ndarray:
    """Gray opening by an octagon of about that width: lines along both axes after one another."""
    from numpy.lib.stride_tricks import sliding_window_view

    def run(x, f):
        for axis in (0, 1):
            r = min(size // 2, x.shape[axis] - 1)
            pad = [(0, 0), (0, 0)]
            pad[axis] = (r, r)
            x = f(sliding_window_view(np.pad(x, pad, mode="edge"), 2 * r + 1, axis=axis), axis=-1)
        return x

    return run(run(a, np.min), np.max)


def passes(image: np.ndarray, n: int = 2, p: LightenParams | AdvancedLightenParams = LightenParams()) -> np.ndarray:
    if isinstance(p, AdvancedLightenParams):
        return lightened_more(image, p)
    for k in range(n):
        image = lightened(image, p) if k == 0 else lightened_again(image, p)
    return image
