"""Small pages drawn by rule, to try operators on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from quireline.raster import kernels as K
from quireline.raster.udfs import struct
from quireline.schemas import PAGE_RASTER


def text_lines(h: int = 480, w: int = 400, ink: int = 0, paper: int = 255) -> np.ndarray:
    a = np.full((h, w), paper, np.uint8)
    for k, y in enumerate(range(40, h - 48, 36)):
        a[y : y + 10, 40 : w - 40 - (k * 37) % 90] = ink
    return a


def drawn() -> dict[str, np.ndarray]:
    out = {"blank_white": np.full((48, 64), 255, np.uint8), "dark_page": text_lines(ink=20, paper=60), "text_lines": text_lines()}
    out |= {f"skewed_{a}": K.rotated(text_lines(), a) for a in (-7, -2, 3, 10)}
    table = np.full((240, 200), 255, np.uint8)
    table[20:220:25, 10:190] = 0
    table[20:220, 10:190:30] = 0
    line = text_lines()
    line[240:243] = 0
    band = text_lines()
    band[:, :6] = 0
    small = np.zeros((200, 200), np.uint8)
    small[40:150, 40:150] = 255
    return out | {"table_grid": table, "scan_line": line, "border_band": band, "small_roi": small}


def frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name, 1, struct(a), None) for name, a in drawn().items()], PAGE_RASTER)
