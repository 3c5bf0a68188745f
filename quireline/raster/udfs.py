"""Page operators on columns of images, a few pages an Arrow batch. An error in a page is a value of its row, not of the job."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.config import AdvancedLightenParams, DeskewParams, LightenParams, LineDetectParams, LineRemovalParams
from quireline.raster import pages
from quireline.schemas import BOX, IMAGE

METRICS = "roi_frac double, blur double, text_density double, core_frac double, skew_deg double, is_table boolean"
BRIGHTNESS = "mean_brightness double, median_brightness double, dark_pixels_percent double, very_dark_pixels_percent double, contrast double"
LINES = f"has_line boolean, orientation string, score double, boxes array<{BOX}>"


def array(image) -> np.ndarray:
    """An image struct as gray (h, w) or BGR (h, w, 3)."""
    h, w, n = image["height"], image["width"], image["nChannels"]
    a = np.frombuffer(image["data"], np.uint8).reshape(h, w, n)
    return a[..., 0] if n == 1 else a[..., :3]


def struct(a: np.ndarray) -> dict:
    n = 1 if a.ndim == 2 else 3
    return {"height": a.shape[0], "width": a.shape[1], "nChannels": n, "mode": 0 if n == 1 else 16, "data": np.ascontiguousarray(a, np.uint8).tobytes()}


def with_values(df: DataFrame, f: Callable[[np.ndarray], dict], schema: str, image: str = "image") -> DataFrame:
    """Adds the columns of ``schema`` that f makes of each image, and ``error`` where it fails or there already was one."""
    names = [x.split()[0] for x in _fields(schema)]
    kept = [c for c in df.columns if c != "error"]
    before = "error" in df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, errors = [], []
            for k, own in enumerate(frame[image]):
                error = frame["error"].iloc[k] if before else None
                try:
                    rows.append(f(array(own)) if error is None and own is not None else {})
                    errors.append(error)
                except Exception as e:
                    rows.append({})
                    errors.append(f"{type(e).__name__}: {e}")
            out = frame[kept].copy()
            for name in names:
                out[name] = pd.Series([r.get(name) for r in rows], index=frame.index, dtype=object)
            out["error"] = pd.Series(errors, index=frame.index, dtype=object)
            yield out

    own = ", ".join(f"`{c}` {kind}" for c, kind in df.select(*kept).dtypes)
    return df.mapInPandas(run, f"{own}, {schema}, error string")


def _fields(schema: str) -> list[str]:
    out, depth, own = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(own.strip())
            own = ""
        else:
            own += c
    return [*out, own.strip()]


def page_metrics(df: DataFrame) -> DataFrame:
    return with_values(df, pages.metrics, METRICS)


def page_brightness(df: DataFrame) -> DataFrame:
    return with_values(df, pages.brightness, BRIGHTNESS)


def lines(df: DataFrame, p: LineDetectParams = LineDetectParams()) -> DataFrame:
    def own(a: np.ndarray) -> dict:
        found = pages.detect_lines(a, p.min_len_ratio, p.max_thickness, p.table_lines)
        return found | {"boxes": [dict(zip("xywh", b, strict=True)) for b in found["boxes"]]}

    return with_values(df, own, LINES)


def _changed(df: DataFrame, f: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    out = with_values(df, lambda a: {"_changed": struct(f(a))}, f"_changed {IMAGE}")
    return out.withColumn("image", F.coalesce("_changed", "image")).drop("_changed")


def cleaned(df: DataFrame, p: LineRemovalParams = LineRemovalParams()) -> DataFrame:
    return _changed(df, lambda a: pages.remove_lines(a, p.min_len_ratio, p.thickness))


def deskewed(df: DataFrame, p: DeskewParams = DeskewParams()) -> DataFrame:
    def own(a: np.ndarray) -> dict:
        image, angle = pages.deskewed(a, p)
        return {"_changed": struct(image), "angle": angle}

    out = with_values(df, own, f"_changed {IMAGE}, angle double")
    return out.withColumn("image", F.coalesce("_changed", "image")).drop("_changed")


def turned(df: DataFrame, angle: str = "angle") -> DataFrame:
    """Pages turned by the right angle in a column; one whose angle is unknown has an error."""
    kept = [c for c in df.columns if c != "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[kept].copy()
            known = frame[angle].notna()
            out["image"] = [struct(pages.right_angle(array(i), int(a))) if k and a else i for i, a, k in zip(frame["image"], frame[angle], known, strict=True)]
            out["error"] = pd.Series([None if k else "ValueError: orientation unknown" for k in known], index=frame.index, dtype=object)
            yield out

    return df.mapInPandas(run, ", ".join(f"`{c}` {kind}" for c, kind in df.select(*kept).dtypes) + ", error string")


def lightened(df: DataFrame, n: int = 2, p: LightenParams | AdvancedLightenParams = LightenParams()) -> DataFrame:
    return _changed(df, lambda a: pages.passes(a, n, p))


def without_stamps(df: DataFrame, stamps: str = "stamps", conf_threshold: float = 0.8) -> DataFrame:
    """Pages with the stamps that a detector found (an array of x, y, w, h, conf) painted over, ``num_stamps`` of them, and ``error``.

    Null stamps are none; a page that has an error stays as it is with 0 of them.
    """
    kept = [c for c in df.columns if c != "error"]
    had = "error" in df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            images, counts, errors = [], [], []
            for k, (image, found) in enumerate(zip(frame["image"], frame[stamps], strict=True)):
                error, n = (frame["error"].iloc[k] if had else None), 0
                if error is None and image is not None:
                    try:
                        boxes = [(b["x"], b["y"], b["w"], b["h"]) for b in (found if found is not None else []) if b["conf"] is not None and b["conf"] >= conf_threshold]
                        image, n = struct(pages.filled(array(image), boxes)), len(boxes)
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                images.append(image)
                counts.append(n)
                errors.append(error)
            out = frame[kept].copy()
            out["image"], out["num_stamps"], out["error"] = images, counts, pd.Series(errors, index=frame.index, dtype=object)
            yield out

    return df.mapInPandas(run, ", ".join(f"`{c}` {kind}" for c, kind in df.select(*kept).dtypes) + ", num_stamps int, error string")
