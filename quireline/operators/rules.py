"""Ordered rules: the first that holds gives a document's category and reason. Rule sets are data, evaluated by one CASE."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quireline.config import ClassifierParams


@dataclass(frozen=True)
class Rule:
    category: str
    reason: str
    when: str = "true"


def decide(rules: list[Rule]) -> Column:
    """struct(category, reason) of the first rule that holds."""
    first, *rest = [(F.expr(r.when), F.struct(F.lit(r.category).alias("category"), F.lit(r.reason).alias("reason"))) for r in rules]
    out = F.when(*first)
    for condition, result in rest:
        out = out.when(condition, result)
    return out


# The thresholds of the rule sets, in order.


def _page(p: ClassifierParams) -> list[Rule]:
    return [Rule("trash", "roi<min", f"roi_frac < {p.roi_min}D"), Rule("trash", "skew_bad", f"avg_skew_deg >= {p.skew_bad}D")]


def _table() -> list[Rule]:
    return [
        Rule("good", "table_strong", "is_table_like and median_ocr_conf >= 65 and pct80 >= 0.45D and avg_blur >= 800"),
        Rule("medium", "table_ok", "is_table_like and median_ocr_conf >= 55 and pct80 >= 0.30D and avg_blur >= 220"),
        Rule("failed", "table_weak", "is_table_like"),
    ]


_DEAD = [Rule("trash", "ocr_dead", "median_ocr_conf < 25 and pct80 < 0.10D"), Rule("trash", "blur_dead", "avg_blur < 120 and pct80 < 0.20D")]
_MINIATURE = Rule("trash", "miniature_poor", "core_frac < 0.12D and pct80 < 0.25D and avg_blur < 260 and median_ocr_conf < 55")


def base(p: ClassifierParams | None = None) -> list[Rule]:
    p = p or ClassifierParams(blur_low=300.0)
    return [
        *_page(p), *_DEAD, _MINIATURE, *_table(),
        Rule("good", "text_strong", f"median_ocr_conf >= 90 and pct80 >= 0.55D and avg_blur >= {p.blur_low}D"),
        Rule("medium", "text_ok", "median_ocr_conf >= 70 and pct80 >= 0.35D"),
        Rule("failed", "text_weak"),
    ]


def extended(p: ClassifierParams | None = None) -> list[Rule]:
    p = p or ClassifierParams()
    return [
        *_page(p), *_DEAD,
        Rule("trash", "no_text_content", "bbox_area_text_frac < 0.03D and median_ocr_conf < 50"),
        Rule("failed", "unstable_ocr", "conf_iqr >= 35 and pct80 < 0.30D"),
        Rule("medium", "irregular_lines", "line_height_var > 100 and median_ocr_conf < 70"),
        _MINIATURE, *_table(),
        Rule("good", "text_strong", f"median_ocr_conf >= 90 and pct80 >= 0.55D and avg_blur >= {p.blur_low}D and bbox_area_text_frac >= 0.15D and conf_iqr <= 20"),
        Rule("medium", "text_ok", "median_ocr_conf >= 70 and pct80 >= 0.35D and bbox_area_text_frac >= 0.05D"),
        Rule("failed", "text_weak"),
    ]


def easy(p: ClassifierParams | None = None) -> list[Rule]:
    """For a reader whose confidences are low throughout."""
    p = p or ClassifierParams()
    return [
        *_page(p),
        Rule("trash", "ocr_dead", "words_count < 10 and median_ocr_conf < 10 and pct80 < 0.05D"),
        Rule("trash", "blur_dead", "avg_blur < 120 and pct80 < 0.10D"),
        Rule("trash", "miniature_poor", "core_frac < 0.12D and pct80 < 0.15D and avg_blur < 260 and median_ocr_conf < 20"),
        Rule("good", "table_strong", "is_table_like and median_ocr_conf >= 40 and pct80 >= 0.20D and avg_blur >= 800 and words_count >= 50"),
        Rule("medium", "table_ok", "is_table_like and median_ocr_conf >= 20 and pct80 >= 0.08D and avg_blur >= 220 and words_count >= 20"),
        Rule("medium", "table_readable", "is_table_like and words_count >= 30"),
        Rule("failed", "table_weak", "is_table_like"),
        Rule("good", "text_strong", f"median_ocr_conf >= 60 and pct80 >= 0.30D and avg_blur >= {p.blur_low}D"),
        Rule("medium", "text_good", "median_ocr_conf >= 35 and pct80 >= 0.15D and avg_blur >= 400 and words_count >= 30"),
        Rule("medium", "text_ok", "median_ocr_conf >= 20 and pct80 >= 0.08D and avg_blur >= 200 and words_count >= 20"),
        Rule("medium", "text_readable", "words_count >= 50"),
        Rule("failed", "text_weak"),
    ]


# How reasons say the measured values.
DARK_REASONS = {
    "mean<100": "very_low_brightness (%.1f < 100)",
    "mean<220": "medium_low_brightness (%.1f < 220)",
    "dark>40": "too_many_dark_pixels (%.1f%% > 40%%)",
    "vdark>25": "too_many_very_dark_pixels (%.1f%% > 25%%)",
    "contrast<10": "extremely_low_contrast (%.1f < 10)",
}


def dark() -> Column:
    """struct(is_dark, reason) from the brightness columns. Rules that an earlier one always forestalls aren't listed."""
    m, d, v, c = (F.col(n) for n in ("mean_brightness", "dark_pixels_percent", "very_dark_pixels_percent", "contrast"))
    say = lambda key, x: F.struct(F.lit(True).alias("is_dark"), F.format_string(DARK_REASONS[key], x).alias("reason"))
    return (
        F.when(m < 100, say("mean<100", m))
        .when(m < 220, say("mean<220", m))
        .when(d > 40, say("dark>40", d))
        .when(v > 25, say("vdark>25", v))
        .when(c < 10, say("contrast<10", c))
        .otherwise(F.struct(F.lit(False).alias("is_dark"), F.lit("normal_brightness").alias("reason")))
    )


def thresholds(pct80_failed, pct80_good, conf_failed, conf_good, bbox_failed, bbox_good, conf_iqr_max, line_var_max) -> Column:
    """The parametric classifier; parameters may be numbers or columns of a grid."""
    p80, conf, bbox, iqr, lines = (F.col(n) for n in ("pct80", "median_ocr_conf", "bbox_area_text_frac", "conf_iqr", "line_height_var"))
    return (
        F.when((p80 < pct80_failed) | (conf < conf_failed) | (bbox < bbox_failed), "failed")
        .when((iqr > conf_iqr_max) & (p80 < 0.4), "failed")
        .when((lines > line_var_max) & (conf < 70), "medium")
        .when((p80 >= pct80_good) & (conf >= conf_good) & (bbox >= bbox_good) & (iqr <= 25), "good")
        .otherwise("medium")
    )


def best_method(ml: Column, rules: Column) -> Column:
    """A model is chosen only if it is better; a tie goes to the thresholds."""
    return F.when(ml > rules, "ml").otherwise("thresholds")
