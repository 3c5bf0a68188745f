"""Parameters with their defaults; every one can be given by the caller."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, fields
from typing import Any

PREFIX = "quireline"


def overridden(kind: type, get: Callable[[str], str | None] | None = None, **given: Any):
    """Parameters of a kind: those that are given, else what the session says, else the environment, else the defaults.

    The session's key of ``LightenParams.long_side`` is ``quireline.LightenParams.long_side`` (``get``: ``spark.conf``'s, which
    gives null for what isn't set), the environment's ``QUIRELINE_LIGHTENPARAMS_LONG_SIDE``. A value is read as its default's type;
    one that can't be is an error that names its key.
    """
    out = {}
    for f in fields(kind):
        key = f"{PREFIX}.{kind.__name__}.{f.name}"
        said = get(key) if get else None
        said = os.environ.get(key.replace(".", "_").upper()) if said is None else said
        if said is not None and f.name not in given:
            try:
                out[f.name] = _read(said, f.default)
            except ValueError as e:
                raise ValueError(f"{key}: {e}") from e
    return kind(**{**out, **given})


def _read(said: str, like: Any) -> Any:
    if isinstance(like, bool):
        if said.lower() not in ("true", "false"):
            raise ValueError(f"true or false, not {said!r}")
        return said.lower() == "true"
    if isinstance(like, tuple):
        return tuple(x.strip() for x in said.split(",") if x.strip())
    return type(like)(said) if isinstance(like, (int, float)) else said


@dataclass(frozen=True)
class ClassifierParams:
    dpi: int = 400
    roi_min: float = 0.45
    skew_bad: float = 12.0
    skew_warn: float = 7.0
    blur_low: float = 800.0  # 300 for the base rule set
    languages: tuple[str, ...] = ("rus", "eng")


@dataclass(frozen=True)
class LineDetectParams:
    dpi: int = 300
    min_len_ratio: float = 0.9
    max_thickness: int = 8
    table_lines: int = 3


@dataclass(frozen=True)
class LineRemovalParams:
    dpi: int = 300
    quality: int = 95
    min_len_ratio: float = 0.55
    thickness: int = 3


@dataclass(frozen=True)
class DeskewParams:
    dpi: int = 400
    angle_limit: float = 35.0
    quality: int = 85
    keep_size: bool = False


@dataclass(frozen=True)
class LightenParams:
    long_side: int = 2200
    background_ratio: float = 0.06
    clahe_clip: float = 2.0
    denoise_h: float = 6.0
    unsharp: float = 1.4
    canny_low: int = 50
    canny_high: int = 150
    keep_color: bool = False


@dataclass(frozen=True)
class AdvancedLightenParams:
    long_side: int = 2400
    open_ratio: float = 0.08
    sigma_ratio: float = 0.02
    block_ratio: float = 0.035
    stretch_low: float = 2.0
    stretch_high: float = 99.0
    clahe_clip: float = 1.5
    denoise_h: float = 5.0
    unsharp: float = 1.0
    canny_low: int = 50
    canny_high: int = 150
    keep_color: bool = True


@dataclass(frozen=True)
class RotateParams:
    dpi: int = 300
    mode: str = "physical"
    min_confidence: float = 0.5

    def __post_init__(self):
        if self.mode not in ("logical", "physical"):
            raise ValueError(f"mode is logical or physical, not {self.mode!r}")


@dataclass(frozen=True)
class OcrParams:
    timeout_s: float = 120.0
    retries: int = 3
    backoff_s: float = 1.0
    raw: bool = False


@dataclass(frozen=True)
class Paths:
    """Where the stages' tables are under one root."""

    root: str

    def stage(self, name: str) -> str:
        if name not in STAGES:
            raise ValueError(f"no stage {name!r}; there are {', '.join(STAGES)}")
        return f"{self.root.rstrip('/')}/{name}"


STAGES = ("all", "split", "rotated", "failed", "deskewed", "failed_deskew", "no_lines", "no_lines_ok", "dark", "processed", "ocr", "training", "model")
CATEGORIES = ("good", "medium", "failed", "trash")
LABELS = ("failed", "medium", "good")
