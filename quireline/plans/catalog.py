"""The engine's queries by name, each with the same query in SQL where SQL can say it.

The tables at hand hold no scans, so relational operators run over stand-ins of the same shape: lines of orders are
detections, orders are pages, customers are documents. Thresholds are applied to values of nine digits and results are
rounded to six, so that both engines decide and print alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireline.functions import text as T
from quireline.ml import features, grid
from quireline.operators import compare, detections, reports, rules
from quireline.tables import tasks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PAGE = ("path", "page_no")
IMAGE_AREA = 39989.0


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- stand-ins


def ocr(t: Tables) -> DataFrame:
    """Dealt by page, so that windows and groups of pages need no deal of their own."""
    lines, orders = t("lineitem"), t("orders")
    n = tasks(lines, orders)
    own = lines.repartition(n, "l_orderkey").join(orders.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return own.select(
        F.col("o_custkey").alias("path"), F.col("l_orderkey").alias("page_no"), F.col("l_linenumber").alias("det_no"),
        F.when(F.col("l_linenumber") == 7, " ").otherwise(F.col("l_returnflag")).alias("text"), (F.col("l_quantity") * 2 - 4).alias("conf"),
        (F.col("l_partkey") % 1000).cast("double").alias("top"), (5 + F.col("l_partkey") % 20).cast("double").alias("height"), (F.col("l_suppkey") % 90).cast("double").alias("width"),
    )


def page_rasters(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t("orders").select(
        F.col("o_custkey").alias("path"), k.alias("page_no"), (F.floor("o_totalprice") % 2000).cast("double").alias("blur"), ((k % 37) / 101).alias("text_density"),
        (0.3 + (k % 70) / 100).alias("roi_frac"), ((k % 100) / 100).alias("core_frac"), ((k % 16) * 0.9).alias("skew_deg"), (k % 5 == 0).alias("is_table"),
    )


def page_metrics(t: Tables) -> DataFrame:
    return detections.page_text_metrics(detections.usable(ocr(t)), F.lit(IMAGE_AREA), PAGE)


def documents(t: Tables) -> DataFrame:
    return detections.document_metrics(detections.all_pages(page_rasters(t), page_metrics(t), PAGE, tasks(t("orders"))))


def classified(t: Tables, rule_set, docs: DataFrame | None = None) -> DataFrame:
    """``docs``: the documents, where they are at hand."""
    return (documents(t) if docs is None else docs).withColumn("d", rules.decide(rule_set)).select("*", "d.category", "d.reason").drop("d")


def training(t: Tables, docs: DataFrame | None = None) -> DataFrame:
    """Documents with a label: a known one from elsewhere, here by the document's number."""
    label = F.element_at(F.array(F.lit("failed"), F.lit("medium"), F.lit("good")), (F.col("path") % 3 + 1).cast("int"))
    return classified(t, rules.extended(), docs).withColumn("label", label).withColumn("correct", (F.col("category") == F.col("label")).cast("int"))


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


_OCR = """ocr AS (
    SELECT o_custkey AS path, l_orderkey AS page_no, l_linenumber AS det_no, CASE WHEN l_linenumber = 7 THEN ' ' ELSE l_returnflag END AS text, l_quantity * 2 - 4 AS conf,
           CAST(l_partkey % 1000 AS DOUBLE) AS top, CAST(5 + l_partkey % 20 AS DOUBLE) AS height, CAST(l_suppkey % 90 AS DOUBLE) AS width
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  det AS (SELECT *, width > 0 AND height > 0 AS boxed FROM ocr WHERE conf > 0),
  gaps AS (SELECT *, CASE WHEN boxed THEN top - lag(top + height) OVER (PARTITION BY path, page_no, boxed ORDER BY top, det_no, height, width, conf) END AS gap FROM det),
  pm AS (
    SELECT path, page_no, round(median(conf), 9) AS conf_med, round(avg(conf), 9) AS conf_mean, round(avg(CASE WHEN conf >= 80 THEN 1.0 ELSE 0.0 END), 9) AS pct80,
           CAST(count(*) FILTER (trim(text) <> '') AS INTEGER) AS words,
           round(coalesce(sum(width * height) FILTER (boxed) / 39989.0, 0.0), 9) AS bbox_area_text_frac,
           round(CASE WHEN count(*) >= 2 THEN quantile_cont(conf, 0.75) - quantile_cont(conf, 0.25) ELSE 0.0 END, 9) AS conf_iqr,
           round(coalesce(median(height) FILTER (boxed), 0.0), 9) AS line_height_med,
           round(CASE WHEN count(*) FILTER (boxed) >= 2 THEN var_pop(height) FILTER (boxed) ELSE 0.0 END, 9) AS line_height_var,
           round(coalesce(median(gap) FILTER (gap > 0), 0.0), 9) AS line_spacing_med,
           round(CASE WHEN count(*) FILTER (gap > 0) >= 2 THEN var_pop(gap) FILTER (gap > 0) ELSE 0.0 END, 9) AS line_spacing_var,
           CAST(count(*) FILTER (boxed) AS INTEGER) AS text_blocks,
           round(coalesce(avg(width) FILTER (boxed), 0.0), 9) AS block_w, round(coalesce(avg(height) FILTER (boxed), 0.0), 9) AS block_h
    FROM gaps GROUP BY path, page_no)"""
_DOC = f"""{_OCR},
  pg AS (
    SELECT o_custkey AS path, o_orderkey AS page_no, CAST(CAST(floor(o_totalprice) AS BIGINT) % 2000 AS DOUBLE) AS blur, CAST(o_orderkey % 37 AS DOUBLE) / 101 AS text_density,
           0.3::DOUBLE + CAST(o_orderkey % 70 AS DOUBLE) / 100 AS roi_frac, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS core_frac, CAST(o_orderkey % 16 AS DOUBLE) * 0.9::DOUBLE AS skew_deg, o_orderkey % 5 = 0 AS is_table
    FROM orders),
  doc AS (
    SELECT pg.path, round(avg(blur), 9) AS avg_blur, round(median(coalesce(conf_med, 0.0)), 9) AS median_ocr_conf, round(avg(coalesce(conf_mean, 0.0)), 9) AS mean_ocr_conf,
           round(avg(coalesce(pct80, 0.0)), 9) AS pct80, CAST(sum(coalesce(words, 0)) AS INTEGER) AS words_count, round(avg(text_density), 9) AS text_density, round(median(roi_frac), 9) AS roi_frac,
           round(median(core_frac), 9) AS core_frac, bool_or(is_table) AS is_table_like, round(median(skew_deg), 9) AS avg_skew_deg, round(avg(coalesce(bbox_area_text_frac, 0.0)), 9) AS bbox_area_text_frac,
           round(avg(coalesce(conf_iqr, 0.0)), 9) AS conf_iqr, round(median(coalesce(line_height_med, 0.0)), 9) AS line_height_med, round(avg(coalesce(line_height_var, 0.0)), 9) AS line_height_var,
           round(median(coalesce(line_spacing_med, 0.0)), 9) AS line_spacing_med, round(avg(coalesce(line_spacing_var, 0.0)), 9) AS line_spacing_var, CAST(sum(coalesce(text_blocks, 0)) AS INTEGER) AS text_blocks_count,
           round(avg(coalesce(block_w, 0.0)), 9) AS avg_block_width, round(avg(coalesce(block_h, 0.0)), 9) AS avg_block_height
    FROM pg LEFT JOIN pm ON pg.path = pm.path AND pg.page_no = pm.page_no GROUP BY pg.path)"""
_TABLE = """WHEN is_table_like THEN CASE WHEN median_ocr_conf >= 65 AND pct80 >= 0.45 AND avg_blur >= 800 THEN 'good/table_strong'
                                     WHEN median_ocr_conf >= 55 AND pct80 >= 0.30 AND avg_blur >= 220 THEN 'medium/table_ok' ELSE 'failed/table_weak' END"""
_BASE = f"""CASE WHEN roi_frac < 0.45 THEN 'trash/roi<min' WHEN avg_skew_deg >= 12 THEN 'trash/skew_bad' WHEN median_ocr_conf < 25 AND pct80 < 0.10 THEN 'trash/ocr_dead'
    WHEN avg_blur < 120 AND pct80 < 0.20 THEN 'trash/blur_dead' WHEN core_frac < 0.12 AND pct80 < 0.25 AND avg_blur < 260 AND median_ocr_conf < 55 THEN 'trash/miniature_poor' {_TABLE}
    WHEN median_ocr_conf >= 90 AND pct80 >= 0.55 AND avg_blur >= 300 THEN 'good/text_strong' WHEN median_ocr_conf >= 70 AND pct80 >= 0.35 THEN 'medium/text_ok' ELSE 'failed/text_weak' END"""
_EXTENDED = f"""CASE WHEN roi_frac < 0.45 THEN 'trash/roi<min' WHEN avg_skew_deg >= 12 THEN 'trash/skew_bad' WHEN median_ocr_conf < 25 AND pct80 < 0.10 THEN 'trash/ocr_dead'
    WHEN avg_blur < 120 AND pct80 < 0.20 THEN 'trash/blur_dead' WHEN bbox_area_text_frac < 0.03 AND median_ocr_conf < 50 THEN 'trash/no_text_content'
    WHEN conf_iqr >= 35 AND pct80 < 0.30 THEN 'failed/unstable_ocr' WHEN line_height_var > 100 AND median_ocr_conf < 70 THEN 'medium/irregular_lines'
    WHEN core_frac < 0.12 AND pct80 < 0.25 AND avg_blur < 260 AND median_ocr_conf < 55 THEN 'trash/miniature_poor' {_TABLE}
    WHEN median_ocr_conf >= 90 AND pct80 >= 0.55 AND avg_blur >= 800 AND bbox_area_text_frac >= 0.15 AND conf_iqr <= 20 THEN 'good/text_strong'
    WHEN median_ocr_conf >= 70 AND pct80 >= 0.35 AND bbox_area_text_frac >= 0.05 THEN 'medium/text_ok' ELSE 'failed/text_weak' END"""
_EASY = """CASE WHEN roi_frac < 0.45 THEN 'trash/roi<min' WHEN avg_skew_deg >= 12 THEN 'trash/skew_bad' WHEN words_count < 10 AND median_ocr_conf < 10 AND pct80 < 0.05 THEN 'trash/ocr_dead'
    WHEN avg_blur < 120 AND pct80 < 0.10 THEN 'trash/blur_dead' WHEN core_frac < 0.12 AND pct80 < 0.15 AND avg_blur < 260 AND median_ocr_conf < 20 THEN 'trash/miniature_poor'
    WHEN is_table_like THEN CASE WHEN median_ocr_conf >= 40 AND pct80 >= 0.20 AND avg_blur >= 800 AND words_count >= 50 THEN 'good/table_strong' WHEN median_ocr_conf >= 20 AND pct80 >= 0.08 AND avg_blur >= 220 AND words_count >= 20 THEN 'medium/table_ok'
        WHEN words_count >= 30 THEN 'medium/table_readable' ELSE 'failed/table_weak' END
    WHEN median_ocr_conf >= 60 AND pct80 >= 0.30 AND avg_blur >= 800 THEN 'good/text_strong' WHEN median_ocr_conf >= 35 AND pct80 >= 0.15 AND avg_blur >= 400 AND words_count >= 30 THEN 'medium/text_good'
    WHEN median_ocr_conf >= 20 AND pct80 >= 0.08 AND avg_blur >= 200 AND words_count >= 20 THEN 'medium/text_ok' WHEN words_count >= 50 THEN 'medium/text_readable' ELSE 'failed/text_weak' END"""
_SPLIT = "split_part(d, '/', 1) AS category, split_part(d, '/', 2) AS reason"
_CLASSED = f"WITH {_DOC}, cls AS (SELECT *, {_SPLIT} FROM (SELECT *, {_EXTENDED} AS d FROM doc))"
_TRAIN = f"{_CLASSED}, tr AS (SELECT *, ['failed', 'medium', 'good'][path % 3 + 1] AS label, CASE WHEN category = ['failed', 'medium', 'good'][path % 3 + 1] THEN 1 ELSE 0 END AS correct FROM cls)"
_NAMES = [*features.BASE]


def _r6(names) -> str:
    whole = ("words_count", "text_blocks_count", "is_table_like", "words", "text_blocks")
    return ", ".join(n if n in whole else f"round({n}, 6) AS {n}" for n in names)


# --- detections, pages, documents


_PAGE_NAMES = ("conf_med", "conf_mean", "pct80", "words", "bbox_area_text_frac", "conf_iqr", "line_height_med", "line_height_var", "line_spacing_med", "line_spacing_var", "text_blocks", "block_w", "block_h")


@query(f"WITH {_OCR} SELECT path, page_no, {_r6(_PAGE_NAMES)} FROM pm")
def page_ocr_metrics(t):
    return rounded(page_metrics(t))


@query(f"WITH {_OCR} SELECT path, page_no, CAST(count(*) AS BIGINT) AS n, round(sum(gap), 6) AS total FROM gaps WHERE gap > 0 GROUP BY path, page_no")
def line_spacing(t):
    own = detections.with_gap(detections.usable(ocr(t)), PAGE).where("gap > 0")
    return own.groupBy(*PAGE).agg(F.count("*").alias("n"), F.round(F.sum("gap"), 6).alias("total"))


@query(f"WITH {_DOC} SELECT path, {_r6(_NAMES)} FROM doc")
def doc_metrics(t):
    return rounded(documents(t))


@query(f"WITH {_DOC} SELECT path, {_SPLIT} FROM (SELECT path, {_BASE} AS d FROM doc)")
def quality_base(t):
    return classified(t, rules.base()).select("path", "category", "reason")


@query(f"WITH {_DOC} SELECT path, {_SPLIT}, round(median_ocr_conf, 6) AS median_ocr_conf, round(pct80, 6) AS pct80 FROM (SELECT *, {_EXTENDED} AS d FROM doc)")
def quality_extended(t):
    return rounded(classified(t, rules.extended()).select("path", "category", "reason", "median_ocr_conf", "pct80"))


@query(f"WITH {_DOC} SELECT path, {_SPLIT} FROM (SELECT path, {_EASY} AS d FROM doc)")
def quality_easyocr(t):
    return classified(t, rules.easy()).select("path", "category", "reason")


@query(f"{_CLASSED} SELECT c.category, coalesce(n, 0) AS n FROM (VALUES ('good'), ('medium'), ('failed'), ('trash')) c(category) LEFT JOIN (SELECT category, count(*) AS n FROM cls GROUP BY category) x ON c.category = x.category")
def category_counts(t):
    return reports.category_counts(classified(t, rules.extended()))


# --- brightness


def _pixels(t: Tables) -> DataFrame:
    px = F.explode(F.transform("embedding", lambda e: F.least(F.greatest(F.round(210 + 256 * e.cast("double")), F.lit(0.0)), F.lit(255.0))))
    return t("embeddings").select(F.col("label").alias("path"), F.col("vec_id").alias("page_no"), px.alias("px"))


def _brightness(t: Tables) -> DataFrame:
    return detections.document_brightness(detections.brightness(_pixels(t), PAGE))


_BRIGHT = """px AS (SELECT label AS path, vec_id AS page_no, least(greatest(round(210 + 256 * CAST(e AS DOUBLE)), 0.0), 255.0) AS px FROM (SELECT label, vec_id, unnest(embedding) AS e FROM embeddings)),
  pb AS (SELECT path, page_no, round(avg(px), 9) AS mean_brightness, round(median(px), 9) AS median_brightness, round(avg(CASE WHEN px < 100 THEN 1.0 ELSE 0.0 END) * 100, 9) AS dark_pixels_percent,
         round(avg(CASE WHEN px < 50 THEN 1.0 ELSE 0.0 END) * 100, 9) AS very_dark_pixels_percent, round(stddev_pop(px), 9) AS contrast FROM px GROUP BY path, page_no),
  db AS (SELECT path, round(avg(mean_brightness), 9) AS mean_brightness, round(avg(median_brightness), 9) AS median_brightness, round(avg(dark_pixels_percent), 9) AS dark_pixels_percent,
         round(avg(very_dark_pixels_percent), 9) AS very_dark_pixels_percent, round(avg(contrast), 9) AS contrast FROM pb GROUP BY path)"""
_BRIGHT_NAMES = ("mean_brightness", "median_brightness", "dark_pixels_percent", "very_dark_pixels_percent", "contrast")
_DARK = """CASE WHEN mean_brightness < 100 THEN 'very_low_brightness (' || printf('%.1f', mean_brightness) || ' < 100)' WHEN mean_brightness < 220 THEN 'medium_low_brightness (' || printf('%.1f', mean_brightness) || ' < 220)'
  WHEN dark_pixels_percent > 40 THEN 'too_many_dark_pixels (' || printf('%.1f', dark_pixels_percent) || '% > 40%)' WHEN very_dark_pixels_percent > 25 THEN 'too_many_very_dark_pixels (' || printf('%.1f', very_dark_pixels_percent) || '% > 25%)'
  WHEN contrast < 10 THEN 'extremely_low_contrast (' || printf('%.1f', contrast) || ' < 10)' ELSE 'normal_brightness' END"""


@query(f"WITH {_BRIGHT} SELECT path, page_no, {', '.join(f'round({n}, 6) AS {n}' for n in _BRIGHT_NAMES)} FROM pb")
def dark_stats(t):
    return rounded(detections.brightness(_pixels(t), PAGE))


@query(f"WITH {_BRIGHT} SELECT path, reason <> 'normal_brightness' AS is_dark, reason FROM (SELECT path, {_DARK} AS reason FROM db)")
def dark_classify(t):
    return _brightness(t).withColumn("d", rules.dark()).select("path", "d.is_dark", "d.reason")


def _dark_records(t: Tables) -> DataFrame:
    pages = detections.brightness(_pixels(t), PAGE).withColumn("d", rules.dark())
    return pages.select(*PAGE, "d.is_dark", F.when(F.col("page_no") % 17 == 0, "ValueError: bad page").alias("error"))


@query(f"WITH {_BRIGHT} SELECT count(*) FILTER (is_dark AND page_no % 17 <> 0) AS dark, count(*) FILTER (NOT is_dark AND page_no % 17 <> 0) AS normal, count(*) FILTER (page_no % 17 = 0) AS errors FROM (SELECT page_no, {_DARK} <> 'normal_brightness' AS is_dark FROM pb)")
def dark_counts(t):
    return reports.dark_counts(_dark_records(t))


# --- runs, training, models


@query("SELECT count(*) AS processed, count(*) FILTER (event_type <> 'error') AS success, count(*) FILTER (event_type = 'error') AS failed FROM events")
def run_summary(t):
    return reports.run_summary(t("events").select(F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status")))


@query(f"{_TRAIN} SELECT path, label AS true_label, category AS predicted_label, reason, {_r6(_NAMES)}, correct FROM tr")
def training_rows(t):
    return rounded(training(t).select("path", F.col("label").alias("true_label"), F.col("category").alias("predicted_label"), "reason", *features.BASE, "correct"))


@query(f"{_TRAIN} SELECT count(*) AS n, CAST(coalesce(sum(correct), 0) AS BIGINT) AS n_correct, coalesce(round(avg(correct), 6), 0.0) AS accuracy FROM tr")
def accuracy_overall(t):
    return reports.accuracy(training(t))


@query(f"{_TRAIN} SELECT label, count(*) AS n, CAST(sum(correct) AS BIGINT) AS n_correct, round(avg(correct), 6) AS accuracy FROM tr GROUP BY label")
def accuracy_by_label(t):
    return reports.accuracy(training(t), "label")


@query(f"{_TRAIN} SELECT label, count(*) AS n FROM tr GROUP BY label")
def class_distribution(t):
    return training(t).groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


@query(f"{_TRAIN} SELECT path, category, label FROM tr ORDER BY path LIMIT 5")
def head5(t):
    return training(t).select("path", "category", "label").orderBy("path").limit(5)


@query(f"{_TRAIN}, gain AS (" + " UNION ALL ".join(f"SELECT '{n}' AS feature, round(abs(coalesce(corr(CAST({n} AS DOUBLE), CAST(correct AS DOUBLE)), 0)), 6) AS score FROM tr" for n in _NAMES if n != "is_table_like") + ") SELECT feature, score FROM gain ORDER BY score DESC, feature LIMIT 10")
def topk_importance(t):
    own = training(t).select("correct", *(F.col(n).cast("double").alias(n) for n in features.BASE if n != "is_table_like"))
    gains = own.agg(*(F.round(F.abs(F.coalesce(F.corr(n, F.col("correct").cast("double")), F.lit(0.0))), 6).alias(n) for n in own.columns if n != "correct"))
    return gains.unpivot([], gains.columns, "feature", "score").orderBy(F.desc("score"), "feature").limit(10)


@query(f"""WITH {_DOC} SELECT path, round(round(mean_ocr_conf - median_ocr_conf, 9), 6) AS conf_range, round(round(avg_blur / (words_count + 1), 9), 6) AS blur_per_word, round(round(text_density * median_ocr_conf, 9), 6) AS density_per_conf,
    round(round(pct80 * pct80, 9), 6) AS pct80_squared, round(round(ln(1 + median_ocr_conf), 9), 6) AS conf_log, round(round(ln(1 + words_count), 9), 6) AS words_log, round(round(ln(1 + bbox_area_text_frac * 1000), 9), 6) AS bbox_area_log,
    round(round(line_height_var / (line_height_med + 1), 9), 6) AS line_height_cv, round(round(line_spacing_var / (line_spacing_med + 1), 9), 6) AS line_spacing_cv FROM doc""")
def derived_features(t):
    return features.derived(documents(t)).select("path", *(F.round(F.round(d, 9), 6).alias(d) for d in features.DERIVED))


_LISTS = {g: f"[{', '.join(f'{x}::DOUBLE' for x in v)}]" for g, v in grid.GRID.items()}
_GRID_SQL = ", ".join(f"(SELECT unnest({v}) AS {g})" for g, v in _LISTS.items())
_SEQ = " + ".join(f"(list_position({v}, {g}) - 1) * {4 ** (7 - k)}" for k, (g, v) in enumerate(_LISTS.items()))
_TRIED = f"""{_TRAIN}, g AS (SELECT * FROM {_GRID_SQL}),
  said AS (SELECT g.*, label, CASE WHEN pct80 < pct80_failed OR median_ocr_conf < conf_failed OR bbox_area_text_frac < bbox_failed THEN 'failed' WHEN conf_iqr > conf_iqr_max AND pct80 < 0.4 THEN 'failed'
    WHEN line_height_var > line_var_max AND median_ocr_conf < 70 THEN 'medium' WHEN pct80 >= pct80_good AND median_ocr_conf >= conf_good AND bbox_area_text_frac >= bbox_good AND conf_iqr <= 25 THEN 'good' ELSE 'medium' END AS p FROM tr, g),
  tried AS (SELECT {', '.join(grid.GRID)}, count(*) AS n, count(*) FILTER (p = label) AS n_correct, round(count(*) FILTER (p = label) / count(*), 9) AS accuracy FROM said GROUP BY {', '.join(grid.GRID)})"""


@query(f"{_TRIED} SELECT * FROM tried")
def threshold_grid(t):
    """All 65,536 combinations."""
    return grid.search(training(t)).select(*grid.GRID, "n", F.col("n_correct").cast("long").alias("n_correct"), "accuracy")


@query(f"{_TRIED} SELECT CAST({_SEQ} AS INTEGER) AS seq, * FROM tried ORDER BY accuracy DESC, seq LIMIT 1")
def threshold_best(t):
    """The best of all 65,536 combinations, the first of equal ones."""
    own = reports.best_first(grid.search(training(t)), "accuracy", "seq")
    return own.select("seq", *grid.GRID, "n", F.col("n_correct").cast("long").alias("n_correct"), "accuracy")


@query(f"{_TRAIN} SELECT label, category AS predicted, count(*) AS n FROM tr GROUP BY label, category")
def confusion_matrix(t):
    return training(t).groupBy("label", F.col("category").alias("predicted")).agg(F.count("*").alias("n"))


@query(f"""{_TRAIN}, each AS (
  SELECT name, CASE WHEN said = 0 THEN 0.0 ELSE hit / said END AS p, CASE WHEN support = 0 THEN 0.0 ELSE hit / support END AS r, support FROM (
    SELECT name, (SELECT count(*) FROM tr WHERE label = name) AS support, (SELECT count(*) FROM tr WHERE category = name) AS said, (SELECT count(*) FROM tr WHERE label = name AND category = name) AS hit
    FROM (SELECT label AS name FROM tr UNION SELECT category FROM tr))),
  f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM each)
  SELECT name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM f
  UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM f
  UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(t):
    return reports.classification_report(training(t), "label", "category")


@query(f"{_TRAIN} SELECT path, label, CAST((row_number() OVER (PARTITION BY label ORDER BY (path * 7919) % 10007, path) - 1) % 5 AS INTEGER) AS fold FROM tr")
def kfold_assign(t):
    own = training(t).select("path", "label", F.struct((F.col("path") * 7919) % 10007, "path").alias("key"))
    return reports.folds(own, "label", F.col("key")).select("path", "label", "fold")


@query(f"WITH {_DOC}, s AS (SELECT avg(avg_blur) AS m, stddev_pop(avg_blur) AS s FROM doc) SELECT path, round(round((avg_blur - m) / s, 9), 6) AS avg_blur FROM doc, s")
def standardize(t):
    docs = documents(t).select("path", "avg_blur")
    stats = docs.agg(F.avg("avg_blur").alias("m"), F.stddev_pop("avg_blur").alias("s"))
    return docs.crossJoin(F.broadcast(stats)).select("path", F.round(F.round(F.when(F.col("s") == 0, 0.0).otherwise((F.col("avg_blur") - F.col("m")) / F.col("s")), 9), 6).alias("avg_blur"))


# --- texts



def _rates(pairs: str) -> str:
    """CTE ``cer`` (id, h, r, cer) of pairs (id, h, r): the edit distance row by row, over code points of whole texts."""
    return f"""RECURSIVE pair AS ({pairs}),
  hc AS (SELECT id, 0 AS j, '' AS c FROM pair UNION ALL SELECT id, unnest(range(1, length(h) + 1)), unnest(regexp_extract_all(h, '(?s).')) FROM pair),
  rc AS (SELECT id, unnest(range(1, length(r) + 1)) AS i, unnest(regexp_extract_all(r, '(?s).')) AS c FROM pair),
  d AS (SELECT CAST(0 AS BIGINT) AS i, id, CAST(j AS BIGINT) AS j, CAST(j AS BIGINT) AS v FROM hc UNION ALL
    SELECT i + 1, id, j, j + min(t - j) OVER (PARTITION BY id ORDER BY j) FROM (
      SELECT d.i, d.id, d.j, least(d.v + 1, coalesce(lag(d.v) OVER (PARTITION BY d.id ORDER BY d.j) + CASE WHEN hc.c = rc.c THEN 0 ELSE 1 END, d.v + 1)) AS t
      FROM d JOIN hc ON hc.id = d.id AND hc.j = d.j JOIN rc ON rc.id = d.id AND rc.i = d.i + 1)),
  cer AS (SELECT pair.*, round(d.v / length(r), 6) AS cer FROM pair JOIN d ON d.id = pair.id AND d.i = length(r) AND d.j = length(h))"""


def _texts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Whole texts as they are."""
    hyp = t("documents").select(F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), "text")
    ref = t("benchmark").select(F.concat(F.lit("f"), F.col("item_id").cast("string"), F.lit(".txt")).alias("filename"), "text")
    return hyp, ref


_CER = _rates("SELECT doc_id AS id, documents.text AS h, benchmark.text AS r FROM documents JOIN benchmark ON doc_id = item_id")


@query(f"WITH {_CER} SELECT 'f' || id || '.txt' AS filename, CAST(length(h) AS INTEGER) AS hyp_len, CAST(length(r) AS INTEGER) AS ref_len, cer FROM cer")
def cer_per_file(t):
    return compare.cer_by_file(*_texts(t), half_even=False)


@query(f"WITH {_CER} SELECT round(sum(cer * length(r)) / sum(length(r)), 6) AS cer, count(*) AS files FROM cer")
def cer_corpus(t):
    return compare.corpus_cer(compare.cer_by_file(*_texts(t), half_even=False), half_even=False)


@query("""WITH ref AS (SELECT item_id, item_id % 3 AS kind, text FROM benchmark)
  SELECT 'f' || doc_id || '.pdf' AS filename, CASE WHEN kind < 2 THEN ref.text ELSE 'ref: ' || ref.text END AS ref FROM documents LEFT JOIN ref ON doc_id = item_id""")
def ocr_ref_candidates(t):
    """Items of rest 0 have a plain reference only, of rest 1 both, of rest 2 a marked one only."""
    b = t("benchmark")
    name = lambda end: F.concat(F.lit("f"), F.col("item_id").cast("string"), F.lit(end)).alias("filename")
    refs = b.where("item_id % 3 < 2").select(name(".txt"), "text").unionByName(b.where("item_id % 3 > 0").select(name(".ref.txt"), F.concat(F.lit("ref: "), "text").alias("text")))
    runs = t("documents").select(F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"))
    return compare.with_reference(runs, refs).select("filename", "ref")


@query("SELECT p_partkey AS path FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
def failed_anti(t):
    """Inputs without an output."""
    done = t("lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("path"))
    return t("part").select(F.col("p_partkey").alias("path")).join(done, "path", "left_anti")


@query("""WITH w AS (SELECT l_suppkey AS k, l_partkey % 90 AS a, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2),
  r AS (SELECT k, a, sum(w) OVER (PARTITION BY k ORDER BY a) AS run, sum(w) OVER (PARTITION BY k) AS total FROM w) SELECT k, min(a) AS weighted_median FROM r WHERE run >= total / 2 GROUP BY k""")
def weighted_median(t):
    own = t("lineitem").groupBy(F.col("l_suppkey").alias("k"), (F.col("l_partkey") % 90).alias("a")).agg(F.sum("l_quantity").alias("w"))
    return reports.weighted_median(own, "a", "w", "k")


@query(f"""WITH {_BRIGHT}, q AS (SELECT path, quantile_cont(px, 0.02) AS lo, quantile_cont(px, 0.99) AS hi FROM px GROUP BY path)
  SELECT page_no, count(*) AS n, round(sum(round(CASE WHEN hi <= lo THEN px ELSE least(greatest((px - lo) * 255 / (hi - lo), 0.0), 255.0) END, 9)), 4) AS total FROM px JOIN q ON px.path = q.path GROUP BY page_no""")
def percentile_stretch(t):
    px = _pixels(t)
    ends = px.groupBy("path").agg(F.percentile("px", 0.02).alias("lo"), F.percentile("px", 0.99).alias("hi"))
    lo, hi, own = F.col("lo"), F.col("hi"), F.col("px")
    stretched = F.when(hi <= lo, own).otherwise(F.least(F.greatest((own - lo) * 255 / F.nullif(hi - lo, F.lit(0.0)), F.lit(0.0)), F.lit(255.0)))
    return px.join(ends, "path").groupBy("page_no").agg(F.count("*").alias("n"), F.round(F.sum(F.round(stretched, 9)), 4).alias("total"))


@query("SELECT conv_id, md5(string_agg(text, chr(12) ORDER BY turn, text)) AS digest, CAST(count(*) AS BIGINT) AS pages FROM conversations GROUP BY conv_id")
def join_pages_ff(t):
    return t("conversations").groupBy("conv_id").agg(F.md5(T.pages_joined(F.col("turn"), F.col("text"))).alias("digest"), F.count("*").alias("pages"))


@query("SELECT conv_id, min(turn) AS turn, md5(min(text) FILTER (turn = 0)) AS digest FROM conversations WHERE turn = 0 GROUP BY conv_id")
def first_page(t):
    return t("conversations").where("turn = 0").groupBy("conv_id").agg(F.min("turn").alias("turn"), F.md5(F.min("text")).alias("digest"))


@query("SELECT doc_id || '_page_' || n || '.pdf' AS page, CAST(n AS INTEGER) AS page_no, md5(part[n]) AS digest FROM (SELECT doc_id, string_split(text, chr(10)) AS part, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n FROM documents)")
def page_split(t):
    parts = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "part"))
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".pdf"))
    return parts.select(T.page_name(name, F.col("k") + 1).alias("page"), (F.col("k") + 1).alias("page_no"), F.md5("part").alias("digest"))


_FILE = "'d/f' || page_id || ['.pdf', '.PNG', '.tif', '.txt', '.jpeg'][page_id % 5 + 1]"


def _files(t: Tables) -> DataFrame:
    ends = F.array(*(F.lit(x) for x in (".pdf", ".PNG", ".tif", ".txt", ".jpeg")))
    return t("pages").select(F.concat(F.lit("d/f"), F.col("page_id").cast("string"), F.element_at(ends, (F.col("page_id") % 5 + 1).cast("int"))).alias("path"))


@query(f"""SELECT path, split_part(path, '/', 2) AS name, CASE WHEN path LIKE '%.pdf' THEN 'split' WHEN lower(path) LIKE '%.png' OR path LIKE '%.jpeg' THEN 'copy' ELSE 'skip' END AS action, NOT path LIKE '%.txt' AS is_input,
  regexp_replace(split_part(path, '/', 2), '\\.[^.]*$', '') AS stem, lower('.' || split_part(path, '.', 2)) AS extension FROM (SELECT {_FILE} AS path FROM pages)""")
def ext_dispatch(t):
    p = F.col("path")
    return _files(t).select("path", T.basename(p).alias("name"), T.dispatch(p).alias("action"), T.is_ocr_input(p).alias("is_input"), T.stem(p).alias("stem"), T.extension(p).alias("extension"))


@query(f"SELECT split_part(path, '/', 2) AS name, row_number() OVER (ORDER BY split_part(path, '/', 2)) AS i, count(*) OVER () AS n, count(*) OVER () - row_number() OVER (ORDER BY split_part(path, '/', 2)) AS remaining FROM (SELECT {_FILE} AS path FROM pages) WHERE path LIKE '%.pdf'")
def sorted_listing(t):
    own = _files(t).where(F.lower("path").endswith(".pdf")).select(T.basename(F.col("path")).alias("name"))
    return reports.numbered(own).select("name", F.col("i").cast("long").alias("i"), "n", F.col("remaining").cast("long").alias("remaining"))


@query("SELECT doc_id, 'bad' AS true_label FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, 'good' FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1")
def label_union(t):
    own = lambda where, name: t("labels").where(where).select("doc_id", F.lit(name).alias("true_label"))
    return own("quality = 0", "bad").unionByName(own("quality = 1", "good")).unionByName(own("toxic = 1", "toxic"))


@query("""SELECT lang, CASE WHEN s = '' THEN ['eng'] ELSE string_split(replace(s, ',', '+'), '+') END AS languages, list_concat(CASE WHEN contains(s, 'rus') THEN ['ru'] ELSE [] END, CASE WHEN contains(s, 'en') OR NOT contains(s, 'rus') THEN ['en'] ELSE [] END) AS reader
  FROM (SELECT DISTINCT lang, CASE lang WHEN 'en' THEN 'rus+eng' WHEN 'de' THEN 'deu,rus' WHEN 'fr' THEN 'fra' ELSE '' END AS s FROM documents)""")
def lang_parse(t):
    said = F.when(F.col("lang") == "en", "rus+eng").when(F.col("lang") == "de", "deu,rus").when(F.col("lang") == "fr", "fra").otherwise("")
    return t("documents").select("lang").distinct().select("lang", T.languages(said).alias("languages"), T.reader_languages(said).alias("reader"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN props ELSE coalesce(props ->> '$.k', '') END AS text FROM events")
def json_text(t):
    kind = F.when(F.col("event_type") == "error", "text/plain").otherwise("application/json")
    body = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.concat(F.lit('{"text": "'), F.get_json_object("props", "$.k"), F.lit('"}')))
    return t("events").select("event_id", T.response_text(body, kind).alias("text"))


_UPPER = "upper(replace(documents.text, 'ß', 'SS'))"
_BACKEND = _rates(f"SELECT doc_id * 2 AS id, documents.text AS h, benchmark.text AS r FROM documents JOIN benchmark ON doc_id = item_id UNION ALL SELECT doc_id * 2 + 1, {_UPPER}, benchmark.text FROM documents JOIN benchmark ON doc_id = item_id")


@query(f"""WITH {_BACKEND} SELECT 'f' || doc_id || '.txt' AS filename, CAST(length(documents.text) AS INTEGER) AS plain_len, p.cer AS plain_cer, CAST(length({_UPPER}) AS INTEGER) AS upper_len, u.cer AS upper_cer
  FROM documents LEFT JOIN cer p ON p.id = doc_id * 2 LEFT JOIN cer u ON u.id = doc_id * 2 + 1""")
def backend_compare(t):
    hyp, ref = _texts(t)
    texts = hyp.withColumn("backend", F.lit("plain")).unionByName(hyp.select("filename", F.upper("text").alias("text"), F.lit("upper").alias("backend")))
    return compare.compare_backends(texts, ref, ["plain", "upper"])


_SWEPT = _rates("SELECT doc_id * 1000 + k AS id, substr(documents.text, 1, k) AS h, benchmark.text AS r FROM documents JOIN benchmark ON doc_id = item_id, (SELECT unnest([40, 80, 120]) AS k)")


@query(f"WITH {_SWEPT} SELECT CAST(id % 1000 AS INTEGER) AS k, count(*) AS files, round(sum(cer * length(r)) / sum(length(r)), 6) AS cer FROM cer GROUP BY 1")
def sweep_cer(t):
    hyp, ref = _texts(t)
    grid_ = hyp.select("filename", "text", F.explode(F.array(F.lit(40), F.lit(80), F.lit(120))).alias("k")).withColumn("text", F.expr("substring(text, 1, k)"))
    return compare.sweep(grid_, ref, "k")


@query("SELECT count(*) AS total_images, CAST(sum(n) AS BIGINT) AS total_stamps FROM (SELECT len(list_filter(embedding, lambda e: e >= 0.2)) AS n FROM embeddings)")
def stamps_summary(t):
    from quireline.operators.stamps import folder_summary

    boxes = F.transform("embedding", lambda e: F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(1).alias("w"), F.lit(1).alias("h"), e.cast("double").alias("conf")))
    return folder_summary(t("embeddings").select(F.col("vec_id").alias("path"), boxes.alias("stamps")), conf_threshold=0.2)


@query("SELECT o_orderkey AS page_no, CAST(CASE WHEN conf > 0.5 THEN [0, 270, 180, 90][cls + 1] ELSE 0 END AS INTEGER) AS angle FROM (SELECT o_orderkey, o_orderkey % 4 AS cls, CAST(o_custkey % 100 AS DOUBLE) / 100 AS conf FROM orders)")
def orientation_map(t):
    from quireline.operators.orientation import correction

    return t("orders").select(F.col("o_orderkey").alias("page_no"), correction((F.col("o_orderkey") % 4).cast("int"), (F.col("o_custkey") % 100) / 100).alias("angle"))


@query("SELECT path, any_value(has_line) AS has_line, CAST(sum(p) AS BIGINT) AS pages_with_lines, CAST(max(n) AS BIGINT) AS total_pages FROM (SELECT o_custkey AS path, bool_or(o_orderkey % 11 = 0) OVER (PARTITION BY o_custkey) AS has_line, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS p, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) GROUP BY path")
def line_gate(t):
    from quireline.operators.routing import line_gate as gate

    return gate(t("orders").select(F.col("o_custkey").alias("path"), (F.col("o_orderkey") % 11 == 0).alias("has_line")))
