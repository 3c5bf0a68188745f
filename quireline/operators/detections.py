"""OCR detections to page metrics, and pages to a document's record: grouped aggregates that Catalyst plans.

Metrics are rounded to ``DIGITS`` digits where they are made, so that a threshold decides alike in whatever order rows were
added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireline.functions.text import not_blank

DIGITS = 9
PAGE_TEXT_METRICS = ("conf_med", "conf_mean", "pct80", "bbox_area_text_frac", "conf_iqr", "line_height_med", "line_height_var", "line_spacing_med", "line_spacing_var", "block_w", "block_h")


def _or0(c: Column) -> Column:
    return F.round(F.coalesce(c.cast("double"), F.lit(0.0)), DIGITS)


def from_polygon(polygon: Column) -> Column:
    """Box of a polygon of four points or more, else null."""
    x, y = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    box = F.struct(F.array_min(x).alias("left"), F.array_min(y).alias("top"), (F.array_max(x) - F.array_min(x)).alias("width"), (F.array_max(y) - F.array_min(y)).alias("height"))
    return F.when(F.size(polygon) >= 4, box)


def usable(detections: DataFrame, conf_scale: float = 1.0, boxes_of_blank_text: bool = True) -> DataFrame:
    """Detections that count: confidence over 0, scaled; ``boxed`` where the box has an area and the backend admits it."""
    boxed = (F.col("width") > 0) & (F.col("height") > 0)
    text = not_blank(F.col("text"))
    return detections.withColumn("conf", F.col("conf") * conf_scale).where("conf > 0").withColumn("is_word", text).withColumn("boxed", boxed if boxes_of_blank_text else boxed & text)


def with_gap(detections: DataFrame, page: tuple[str, ...] = ("path", "page_no")) -> DataFrame:
    """``gap`` from the box above: top less the bottom of the box before it by top."""
    order = Window.partitionBy(*page, "boxed").orderBy("top", "det_no", "height", "width", "conf")
    return detections.withColumn("gap", F.when(F.col("boxed"), F.col("top") - F.lag(F.col("top") + F.col("height")).over(order)))


def page_text_metrics(detections: DataFrame, image_area: Column, page: tuple[str, ...] = ("path", "page_no")) -> DataFrame:
    """One row a page that has detections; ``detections`` as ``usable`` gives them."""
    box = lambda c: F.when(F.col("boxed"), c)
    gap = F.when(F.col("gap") > 0, F.col("gap"))
    many = lambda c, agg: F.when(F.count(c) >= 2, agg(c))
    quarters = F.percentile("conf", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))  # in one table of values
    return (
        with_gap(detections, page)
        .groupBy(*page)
        .agg(
            _or0(quarters[1]).alias("conf_med"),
            _or0(F.avg("conf")).alias("conf_mean"),
            _or0(F.avg((F.col("conf") >= 80).cast("double"))).alias("pct80"),
            F.count_if("is_word").cast("int").alias("words"),
            _or0(F.sum(box(F.col("width") * F.col("height"))) / image_area).alias("bbox_area_text_frac"),
            _or0(F.when(F.count("conf") >= 2, quarters[2] - quarters[0])).alias("conf_iqr"),
            _or0(F.median(box(F.col("height")))).alias("line_height_med"),
            _or0(many(box(F.col("height")), F.var_pop)).alias("line_height_var"),
            _or0(F.median(gap)).alias("line_spacing_med"),
            _or0(many(gap, F.var_pop)).alias("line_spacing_var"),
            F.count_if("boxed").cast("int").alias("text_blocks"),
            _or0(F.avg(box(F.col("width")))).alias("block_w"),
            _or0(F.avg(box(F.col("height")))).alias("block_h"),
        )
    )


def all_pages(pages: DataFrame, metrics: DataFrame, page: tuple[str, ...] = ("path", "page_no"), tasks: int | None = None) -> DataFrame:
    """Every page with its text metrics; a page without detections has zeros. ``tasks``: over how many pages are dealt, else the session's number."""
    if tasks:
        pages, metrics = pages.repartition(tasks, *page), metrics.repartition(tasks, *page)
    out = pages.join(metrics, list(page), "left")
    return out.fillna(0.0, list(PAGE_TEXT_METRICS)).fillna(0, ["words", "text_blocks"])


def unread_pages(pages: DataFrame) -> DataFrame:
    """Every page with zeros for its text metrics: records of a reader that doesn't measure them."""
    zeros = {name: F.lit(0.0) for name in PAGE_TEXT_METRICS}
    return pages.withColumns({**zeros, "words": F.lit(0), "text_blocks": F.lit(0)})


def document_metrics(pages: DataFrame, doc: str = "path") -> DataFrame:
    """A document's record from its pages: means, medians of medians, sums and any."""
    return pages.groupBy(doc).agg(
        _or0(F.avg("blur")).alias("avg_blur"),
        _or0(F.median("conf_med")).alias("median_ocr_conf"),
        _or0(F.avg("conf_mean")).alias("mean_ocr_conf"),
        _or0(F.avg("pct80")).alias("pct80"),
        F.sum("words").cast("int").alias("words_count"),
        _or0(F.avg("text_density")).alias("text_density"),
        F.round(F.coalesce(F.median("roi_frac"), F.lit(1.0)), DIGITS).alias("roi_frac"),
        _or0(F.median("core_frac")).alias("core_frac"),
        F.coalesce(F.bool_or("is_table"), F.lit(False)).alias("is_table_like"),
        _or0(F.median("skew_deg")).alias("avg_skew_deg"),
        _or0(F.avg("bbox_area_text_frac")).alias("bbox_area_text_frac"),
        _or0(F.avg("conf_iqr")).alias("conf_iqr"),
        _or0(F.median("line_height_med")).alias("line_height_med"),
        _or0(F.avg("line_height_var")).alias("line_height_var"),
        _or0(F.median("line_spacing_med")).alias("line_spacing_med"),
        _or0(F.avg("line_spacing_var")).alias("line_spacing_var"),
        F.sum("text_blocks").cast("int").alias("text_blocks_count"),
        _or0(F.avg("block_w")).alias("avg_block_width"),
        _or0(F.avg("block_h")).alias("avg_block_height"),
    )


def brightness(pixels: DataFrame, page: tuple[str, ...] = ("path", "page_no"), px: str = "px") -> DataFrame:
    """Brightness of pages from one row a pixel (0 to 255)."""
    return pixels.groupBy(*page).agg(
        _or0(F.avg(px)).alias("mean_brightness"),
        _or0(F.median(px)).alias("median_brightness"),
        _or0(F.avg((F.col(px) < 100).cast("double")) * 100).alias("dark_pixels_percent"),
        _or0(F.avg((F.col(px) < 50).cast("double")) * 100).alias("very_dark_pixels_percent"),
        _or0(F.stddev_pop(px)).alias("contrast"),
    )


def document_brightness(pages: DataFrame, doc: str = "path") -> DataFrame:
    names = ("mean_brightness", "median_brightness", "dark_pixels_percent", "very_dark_pixels_percent", "contrast")
    return pages.groupBy(doc).agg(*(_or0(F.avg(n)).alias(n) for n in names))
